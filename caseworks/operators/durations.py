"""Time to resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.plans.quantiles import exact_quantiles


def theme_column(columns: Sequence[str]) -> str:
    """``theme_top`` if present, else the first ``theme_cluster*`` column."""
    if "theme_top" in columns:
        return "theme_top"
    clusters = [c for c in columns if c.startswith("theme_cluster")]
    if not clusters:
        raise ValueError("no theme column found; run clustering first")
    return clusters[0]


def valid_durations(df: DataFrame, hours: str = "open_hours") -> DataFrame:
    return df.filter(F.col(hours) >= 0)


def duration_gaps(df: DataFrame, opened: str, closed: str, hours: str = "open_hours") -> DataFrame:
    """What to look at when no duration is valid: valid rows and missing shares of both dates."""
    return df.agg(
        F.count_if(F.coalesce(F.col(hours) >= 0, F.lit(False))).alias("valid_rows"),
        F.avg(F.col(opened).isNull().cast("double")).alias("opened_missing"),
        F.avg(F.col(closed).isNull().cast("double")).alias("closed_missing"),
    )


def ttr_by_theme(
    df: DataFrame, theme: str, hours: str = "open_hours", top: int | None = None, exact: bool = True
) -> DataFrame:
    """Tickets, mean, median, P90 and P95 of valid durations per theme, largest theme first."""
    valid = valid_durations(df, hours).filter(F.col(theme).isNotNull()).select(
        F.col(theme).alias("theme"), F.col(hours).cast("double").alias("h")
    )
    wanted = {"p50": 0.5, "p90": 0.9, "p95": 0.95}
    base = [F.count(F.lit(1)).alias("tickets"), F.avg("h").alias("mean")]
    if exact:
        stats = exact_quantiles(valid, ["theme"], "h", wanted, extra=base)
    else:
        stats = valid.groupBy("theme").agg(
            *base, *[F.percentile_approx("h", p, 10_000).alias(n) for n, p in wanted.items()]
        )
    ordered = stats.orderBy(F.desc("tickets"), "theme")
    return ordered.limit(top) if top else ordered


def ttr_top_p90(df: DataFrame, theme: str, hours: str = "open_hours", top: int = 10) -> DataFrame:
    return ttr_by_theme(df, theme, hours, top=top).select("theme", "p90")
