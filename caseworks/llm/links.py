"""Connected components of a graph whose nodes have few links each.

Label propagation with pointer jumping: each round every node takes the smallest
label among its neighbours and itself, then the label of the node it is labelled
with. Rounds are written to the shared folder, so lineage stays short and a lost
executor repeats one round at most. The driver sees one number per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.llm.common import by_shuffle, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b: long); root is the smallest node reachable.

    Either direction of a link will do, repeated links and loops are harmless, a
    null end is left out. No edges give no rows.
    """
    edges = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(by_shuffle(labels), both["b"] == labels["node"]).select(F.col("a").alias("node"), "root")
        lower = near.union(labels).groupBy("node").agg(F.min("root").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = lower.join(by_shuffle(jump), "root").select("node", F.least("root", "next").alias("root"))
        after = stored(after, "labels")
        changed = after.join(by_shuffle(labels.withColumnRenamed("root", "was")), "node").filter(F.col("root") != F.col("was")).limit(1)
        labels = after
        if not changed.count():
            return labels
