"""Repeat contact: did the same contact come back within a number of days?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from caseworks.functions.clean import hours_between, wall_micros
from caseworks.plans.bounded import hot_keys

HOT_ROWS = 5_000_000
SLICES = 512


def repeat_contacts(
    df: DataFrame, key: str, ts: str, id_col: str, days: float = 7, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``prev_ts``, ``hours_since_prev`` and ``is_repeat`` (first contacts are False).

    Rows without key or time are dropped. Contacts are ordered by time, then id. A
    contact with very many rows (a shared mailbox) is not sorted in one task: its
    history is cut into time slices that are ordered separately and stitched together.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    hot = hot_keys(rows, key, hot_rows)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    history = W.partitionBy(key).orderBy(ts, id_col)
    plain = (rows.filter(~is_hot) if hot else rows).withColumn("prev_ts", F.lag(ts).over(history))
    with_prev = plain.unionByName(_sliced(rows.filter(is_hot), key, ts, id_col)) if hot else plain
    hours = hours_between("prev_ts", ts)
    return with_prev.withColumn("hours_since_prev", hours).withColumn("is_repeat", _within(days))


def _within(days: float) -> Column:
    return F.coalesce(F.col("hours_since_prev") <= F.lit(float(days) * 24), F.lit(False))


def _sliced(rows: DataFrame, key: str, ts: str, id_col: str) -> DataFrame:
    """Previous contact time for hot keys.

    Simultaneous rows of a key collapse into one moment first: the row with the
    smallest id looks back to the moment before, the others look back to the first.
    """
    moments = rows.groupBy(key, ts).agg(F.min(id_col).alias("_first"))
    micros = wall_micros(ts)
    edges = moments.groupBy(key).agg(
        F.percentile_approx(micros, F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)]), 10 * SLICES).alias("_e")
    )
    # One row per hot key, one in HOT_ROWS rows at most.
    placed = moments.join(F.broadcast(edges), key).withColumn(
        "_slice", F.size(F.filter("_e", lambda e: e < micros))
    ).drop("_e")
    inside = W.partitionBy(key, "_slice").orderBy(ts)
    last = placed.groupBy(key, "_slice").agg(F.max(ts).alias("_last"))
    before = last.select(
        key, "_slice", F.lag("_last").over(W.partitionBy(key).orderBy("_slice")).alias("_before")
    )
    # At most SLICES rows per hot key.
    linked = (
        placed.withColumn("_lag", F.lag(ts).over(inside))
        .join(F.broadcast(before), [key, "_slice"])
        .select(
            key, ts, F.col("_first").alias(id_col), F.lit(True).alias("_head"),
            F.coalesce("_lag", "_before").alias("_prev"),
        )
    )
    joined = rows.join(linked, [key, ts, id_col], "left")
    prev = F.when(F.col("_head"), F.col("_prev")).otherwise(F.col(ts))
    return joined.withColumn("prev_ts", prev).drop("_head", "_prev").select(*rows.columns, "prev_ts")


def repeat_rate(contacts: DataFrame) -> DataFrame:
    """Share of repeat contacts among all contacts, first contacts included."""
    return contacts.agg(F.avg(F.col("is_repeat").cast("double")).alias("repeat_rate"))


def repeat_by_theme(contacts: DataFrame, theme: str, top: int | None = None) -> DataFrame:
    ordered = (
        contacts.filter(F.col(theme).isNotNull())
        .groupBy(F.col(theme).alias("theme"))
        .agg(F.count(F.lit(1)).alias("tickets"), F.avg(F.col("is_repeat").cast("double")).alias("repeat_rate"))
        .orderBy(F.desc("repeat_rate"), F.desc("tickets"), "theme")
    )
    return ordered.limit(top) if top else ordered
