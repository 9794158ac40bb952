"""Top-k for large k.

``orderBy().limit(k)`` sends up to k rows of every partition to one task. That is fine for
a report of twenty rows and not for a vocabulary of twenty thousand from ten thousand
partitions. A histogram of the measure first discards what cannot be among the k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

STEPS_PER_DOUBLING = 16


def contenders(df: DataFrame, measure: str, k: int) -> DataFrame:
    """Rows that can be among the ``k`` largest values of a positive ``measure``, ties included.

    Keeps whole steps of a logarithmic scale from the top down until they hold k rows. The
    histogram has at most about a thousand rows and sits in a scalar subquery over the same
    plan, so a shuffle below ``df`` is done once.
    """
    step: Column = F.floor(F.log2(F.col(measure).cast("double")) * STEPS_PER_DOUBLING)
    sizes = df.groupBy(step.alias("_step")).agg(F.count(F.lit(1)).alias("_n"))
    running = F.sum("_n").over(W.orderBy(F.desc("_step")))
    enough = sizes.withColumn("_upto", running).agg(F.max(F.when(F.col("_upto") >= k, F.col("_step"))).alias("_from"))
    floor = enough.select("_from").scalar()
    return df.filter(step >= F.coalesce(floor, F.lit(-(10**6)).cast("bigint")))
