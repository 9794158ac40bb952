"""Volume per day and theme, spikes, and incident attribution.

Rows are touched once by a map-side combined count; everything after works on the
(day, theme) table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from caseworks.plans.bounded import bounded_rows, lookup_join
from caseworks.plans.stages import write_stage

MAX_THEMES = 10_000


def daily_volume(df: DataFrame, ts: str) -> DataFrame:
    """Rows per observed day; NULL times are left out and gaps are not filled."""
    return df.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("count"))


def daily_theme_counts(df: DataFrame, ts: str, theme: str) -> DataFrame:
    dated = df.filter(F.col(ts).isNotNull() & F.col(theme).isNotNull())
    keys = [F.to_date(ts).alias("day"), F.col(theme).alias("theme")]
    return dated.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def themes_of(df: DataFrame, theme: str) -> list:
    found = df.select(theme).filter(F.col(theme).isNotNull()).distinct()
    return sorted(r[0] for r in bounded_rows(found, MAX_THEMES, "theme list"))


def daily_theme_matrix(df: DataFrame, ts: str, theme: str, values: Sequence | None = None) -> DataFrame:
    """One row per day observed for any theme, one column per theme, absent cells 0."""
    values = list(values) if values is not None else themes_of(df, theme)
    counts = daily_theme_counts(df, ts, theme)
    return counts.groupBy("day").pivot("theme", values).agg(F.first("count")).na.fill(0)


def daily_theme_dense(df: DataFrame, ts: str, theme: str, values: Sequence | None = None) -> DataFrame:
    """Long form of the matrix: every observed day for every theme, of any number of themes.

    Observed days are numbered once. A theme's present days know the next one, and the absent days between them (before the
    first and after the last too) are generated from the numbers, so nothing is pivoted and no list of themes is needed.
    """
    counts, _ = write_stage(daily_theme_counts(df, ts, theme), "daily")
    days = counts.select("day").distinct().withColumn("at", F.row_number().over(W.orderBy("day")) - 1)
    days, _ = write_stage(days, "days")
    last = days.agg(F.max("at")).first()[0]
    if last is None:
        return counts.select("day", "theme", "count")
    if values is not None:
        wanted = df.sparkSession.createDataFrame([(v,) for v in values], f"theme {counts.schema['theme'].dataType.simpleString()}")
        counts = counts.join(F.broadcast(wanted), "theme", "right")
    numbered = lookup_join(counts, days, ["day"], ["theme"], "left")
    in_order = W.partitionBy("theme").orderBy("at")
    begin = F.when(F.row_number().over(in_order) == 1, 0).otherwise(F.col("at"))
    runs = numbered.withColumn("begin", begin).withColumn("end", F.coalesce(F.lead("at").over(in_order) - 1, F.lit(last)))
    cells = runs.select("theme", F.col("at").alias("own"), "count", F.explode(F.sequence("begin", "end")).alias("at"))
    filled = cells.select("theme", "at", F.when(F.col("at") == F.col("own"), F.col("count")).otherwise(0).alias("count"))
    return lookup_join(filled, days, ["at"], ["theme"], "inner").select("day", "theme", "count")


def theme_spikes(df: DataFrame, ts: str, theme: str, z: float = 3.0, top: int | None = None) -> DataFrame:
    """Days on which a theme's count is at least ``z`` sample deviations above its own mean.

    The series of a theme covers every day observed for any theme, with 0 where the
    theme is absent. Those zeros enter mean and deviation arithmetically, so the dense
    grid is never built; ``z`` must be positive because only present cells can exceed it.
    Themes without variation have no spikes.
    """
    if z <= 0:
        raise ValueError("z must be positive")
    counts = daily_theme_counts(df, ts, theme)
    # Naming the count keeps this subquery on the same shuffled table as the main query: one scan.
    days = counts.select(F.countDistinct(F.when(F.col("count") > 0, F.col("day")))).scalar()
    per_theme = W.partitionBy("theme")
    deviation = F.col("count") - F.col("_mean")
    absent = F.col("_days") - F.count(F.lit(1)).over(per_theme)
    scored = (
        counts.withColumn("_days", days)
        .withColumn("_mean", F.sum("count").over(per_theme) / F.col("_days"))
        .withColumn("_sq", F.sum(deviation * deviation).over(per_theme) + absent * F.col("_mean") * F.col("_mean"))
        .withColumn("_std", F.sqrt(F.col("_sq") / F.nullif(F.col("_days") - 1, F.lit(0))))
        .filter(F.col("_std") > 0)
        .withColumn("zscore", deviation / F.col("_std"))
        .filter(F.col("zscore") >= z)
        .select("theme", "day", "count", F.round("zscore", 2).alias("zscore"))
    )
    ordered = scored.orderBy(F.desc("zscore"), F.desc("count"), "theme", "day")
    return ordered.limit(top) if top else ordered


def _midnight(day: str | date) -> datetime:
    if isinstance(day, datetime):
        return day
    return datetime.combine(day, datetime.min.time()) if isinstance(day, date) else datetime.fromisoformat(day)


def incident_attribution(
    df: DataFrame, ts: str, theme: str, start: str | date, end: str | date,
    top: int | None = None, whole_days: bool = False,
) -> DataFrame:
    """Theme counts inside an incident window against the equally long window before it.

    Bounds are compared as midnights, so the last day counts only up to 00:00;
    ``whole_days=True`` includes it fully. Themes seen in neither window are absent.
    """
    first, last = _midnight(start), _midnight(end)
    days = (last - first).days + 1
    base_first, base_last = first - timedelta(days=days), first - timedelta(days=1)
    t = F.col(ts).cast("timestamp_ntz")

    def moment(when: datetime):
        return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")

    def within(lo: datetime, hi: datetime):
        if whole_days:
            return (t >= moment(lo)) & (t < moment(hi + timedelta(days=1)))
        return (t >= moment(lo)) & (t <= moment(hi))

    incident, baseline = within(first, last), within(base_first, base_last)
    if df.filter(incident).select(F.lit(1)).isEmpty():
        raise ValueError("no rows in the incident window")
    counts = (
        df.filter((incident | baseline) & F.col(theme).isNotNull())
        .groupBy(F.col(theme).alias("theme"))
        .agg(F.count_if(incident).alias("incident"), F.count_if(baseline).alias("baseline"))
    )
    # Naming both counts keeps this subquery on the same shuffled table as the main query: one scan.
    total = counts.select(F.sum(F.when(F.col("baseline") >= 0, F.col("incident")))).scalar()
    ordered = counts.select(
        "theme",
        "incident",
        "baseline",
        (F.col("incident") - F.col("baseline")).alias("delta"),
        (F.col("incident") / total).alias("incident_share"),
    ).orderBy(F.desc("incident_share"), F.desc("delta"), "theme")
    return ordered.limit(top) if top else ordered
