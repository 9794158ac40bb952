"""Exact per-group selection by hash order without sorting the groups.

"Take the k rows of each class with the smallest hash" is a row_number() window,
but that sorts a whole class in one task, and one class may hold a third of the
table. The same rows are found with counts only:

1. histogram of a hash prefix per group (map-side combined);
2. the prefix bucket in which the k-th smallest hash falls, from running totals;
3. the k-th hash itself, by ranking only the rows of that one bucket;
4. a map-side comparison of every row with its group's threshold.

No step shuffles the rows themselves. A bucket of step 3 holds 1/65536 of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from caseworks.plans.bounded import lookup_join

PREFIX_CHARS = 4


def hash_key(id_col: str, seed: int) -> Column:
    """Reproducible pseudo-random order of rows, independent of partitioning."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def mark_smallest(
    df: DataFrame,
    groups: Sequence[str],
    id_col: str,
    seed: int,
    take: Callable[[Column], Column] | DataFrame,
    flag: str = "picked",
) -> DataFrame:
    """Add boolean ``flag``: is the row among the first ``take`` of its group in hash order?

    ``take`` is either a function of the group size or a table ``groups + [take]``.
    Group columns must not be NULL.
    """
    groups = list(groups)
    keyed = df.withColumn("_h", hash_key(id_col, seed))
    hist = keyed.groupBy(*groups, F.substring("_h", 1, PREFIX_CHARS).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    whole = W.partitionBy(*groups)
    running = whole.orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    hist = hist.withColumn("_upto", F.sum("_n").over(running))
    if isinstance(take, DataFrame):
        hist = lookup_join(hist, take.withColumnRenamed("take", "_take"), groups, ["_b"], "inner")
    else:
        hist = hist.withColumn("_take", take(F.sum("_n").over(whole)))
    edge = hist.filter(
        (F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_n") < F.col("_take"))
    ).select(*groups, "_b", (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_left"))

    slim = keyed.select(*groups, "_h", F.substring("_h", 1, PREFIX_CHARS).alias("_b"), F.col(id_col).alias("_id"))
    within = whole.orderBy("_h", "_id")
    cuts = (
        lookup_join(slim, edge, [*groups, "_b"], ["_id"], "inner")
        .withColumn("_rn", F.row_number().over(within))
        .filter(F.col("_rn") == F.col("_left"))
        .select(*groups, F.col("_h").alias("_cut"), F.col("_id").alias("_cut_id"))
    )
    below = (F.col("_h") < F.col("_cut")) | (
        (F.col("_h") == F.col("_cut")) & (F.col(id_col) <= F.col("_cut_id"))
    )
    if groups:
        joined = lookup_join(keyed, cuts, groups, [id_col], "left")
    else:
        edge_row = cuts.first()
        cut, cut_id = (edge_row["_cut"], edge_row["_cut_id"]) if edge_row else (None, None)
        joined = keyed.withColumn("_cut", F.lit(cut).cast("string")).withColumn(
            "_cut_id", F.lit(cut_id).cast(df.schema[id_col].dataType)
        )
    return joined.withColumn(flag, F.coalesce(below, F.lit(False))).drop("_h", "_cut", "_cut_id")
