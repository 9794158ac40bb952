"""Descriptive aggregation: missingness, summaries, frequency tables, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.functions.clean import blank_label
from caseworks.plans.quantiles import exact_quantiles


def missingness(df: DataFrame, cols: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """Share of NULLs (and NaNs) per column, highest first, from one pass over the table."""
    cols = list(cols or df.columns)
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def absent(c: str):
        test = F.col(f"`{c}`").isNull()
        return test | F.isnan(F.col(f"`{c}`")) if c in floats else test

    shares = df.agg(*[F.avg(absent(c).cast("double")).alias(f"_{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("missing")) for i, c in enumerate(cols)])
    ordered = shares.select(F.inline(pairs)).orderBy(F.desc("missing"), "column")
    return ordered.limit(top) if top else ordered


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, NULLs skipped, quartiles exact.

    All columns share the passes: each row turns into one (column, value) pair per column,
    combined before the shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])
    return exact_quantiles(
        df.select(F.inline(pairs)),
        ["column"],
        "v",
        {"p25": 0.25, "p50": 0.5, "p75": 0.75},
        extra=[
            F.count("v").alias("count"),
            F.avg("v").alias("mean"),
            F.stddev_samp("v").alias("std"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        ],
    ).select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def share_equal(df: DataFrame, col: str, value, null_as=None) -> DataFrame:
    """Share of rows equal to ``value`` where NULL reads as ``null_as``."""
    c = F.col(col) if null_as is None else F.coalesce(F.col(col), F.lit(null_as))
    hit = F.coalesce(c == F.lit(value), F.lit(False))
    return df.agg(F.avg(hit.cast("double")).alias("share"))


def value_counts(df: DataFrame, col: str, top: int | None = None, blank: bool = True) -> DataFrame:
    """Frequency table, most frequent first. NULL shows as "(blank)", or is left out."""
    if blank:
        keyed = df.select(blank_label(col).alias("value"))
    else:
        keyed = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull())
    ordered = (
        keyed.groupBy("value").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc("value"))
    )
    return ordered.limit(top) if top else ordered


def target_profile(df: DataFrame, target: str, samples: int = 10) -> DataFrame:
    """One row: classes, missing rows, all classes with their counts, and the ``samples`` most frequent values."""
    counts = df.groupBy(F.col(target).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    # The aggregate skips the NULL class: a filter would be pushed below the count and cost a second scan.
    entry = F.when(F.col("value").isNotNull(), F.struct((-F.col("count")).alias("n"), "value"))
    head = counts.agg(F.sort_array(F.collect_list(entry)).alias("h"))
    summary = counts.agg(
        F.count("value").alias("classes"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
    )
    top = head.select(
        F.to_json(F.map_from_entries(F.transform("h", lambda e: F.struct(e["value"], -e["n"])))).alias("j")
    ).scalar()
    names = head.select(F.concat_ws(",", F.transform(F.slice("h", 1, samples), lambda e: e["value"]))).scalar()
    return summary.select(
        F.lit(target).alias("target"), "rows", "classes", "missing",
        top.alias("class_counts"), names.alias("sample_values"),
    )


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max, last bin closed, empty bins kept.

    When all values are equal the range is widened by a half to each side.
    """
    v = F.col(col).cast("double")
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    bin_no = F.least(F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)).cast("int")
    counts = (
        df.filter(v.isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return (
        frame.join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("low"),
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("high"),
            F.coalesce("n", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


def split_report(split: DataFrame, target: str = "target", label: str = "label", side: str = "split") -> DataFrame:
    """Rows, train and validation rows, classes and singleton classes per target."""
    per_class = split.groupBy(target, label).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(side) == "train").alias("t"),
        F.count_if(F.col(side) == "validation").alias("v"),
    )
    return per_class.groupBy(target).agg(
        F.sum("n").alias("rows"),
        F.sum("t").alias("train"),
        F.sum("v").alias("validation"),
        F.count(F.lit(1)).alias("classes"),
        F.count_if(F.col("n") == 1).alias("singletons"),
    )
