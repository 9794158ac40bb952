"""Dense 0-based codes for the sorted distinct values of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from caseworks.plans.bounded import MAX_LOCAL_ROWS, local_table
from caseworks.session import checkpoint_folder


def sorted_codes(
    df: DataFrame, value: str, code: str = "code", max_rows: int = MAX_LOCAL_ROWS, parts: int = 256
) -> DataFrame:
    """Table ``(value, code)`` where code is the rank of the value among all distinct values.

    A small dictionary is ranked in one window. A large one is range-partitioned,
    ranked inside each range, and shifted by the sizes of the ranges before it, so
    no task sees the whole dictionary. NULLs get no code.
    """
    distinct = df.select(value).filter(F.col(value).isNotNull()).distinct()
    small = local_table(distinct, max_rows)
    if small is not None:
        ranked = small.withColumn(code, F.row_number().over(W.orderBy(value)) - 1)
        return ranked.withColumn(code, F.col(code).cast("long"))
    checkpoint_folder(df.sparkSession)
    # Range bounds come from sampling; the checkpoint fixes them before they are used twice.
    ranged = (
        distinct.repartitionByRange(parts, value)
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = W.partitionBy("_part").orderBy(value)
    return (
        ranged.withColumn("_rn", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_part")
        .select(value, (F.col("_rn") + F.col("_off")).cast("long").alias(code))
    )
