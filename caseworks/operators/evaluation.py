"""Accuracy, baseline, metrics documents and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from caseworks.functions.clean import norm_str, valid_target
from caseworks.plans.selection import mark_smallest


def accuracy(df: DataFrame, truth: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose trimmed prediction equals the trimmed truth; no rows, no result row per group."""
    hit = norm_str(truth).eqNullSafe(norm_str(prediction))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.avg(hit.cast("double")).alias("accuracy"))


def evaluate_vs_baseline(
    pred: DataFrame, id_col: str, n_samples: int | None = None, seed: int = 42,
    target: str = "target", truth: str = "label", prediction: str = "prediction",
) -> DataFrame:
    """Per target: rows, classes, accuracy, and the share of the most frequent truth on the same rows.

    Rows with a missing or zero truth are left out first; ``n_samples=None`` uses all rows.
    """
    valid = pred.filter(valid_target(truth, zero_is_missing=True))
    if n_samples is not None:
        valid = mark_smallest(valid, [target], id_col, seed, lambda n: F.least(n, F.lit(n_samples))).filter("picked")
    hit = norm_str(truth).eqNullSafe(norm_str(prediction))
    per_class = valid.groupBy(target, norm_str(truth).alias("_truth")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("h")
    )
    return per_class.groupBy(target).agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("classes"),
        (F.sum("h") / F.sum("n")).alias("accuracy"),
        (F.max("n") / F.sum("n")).alias("baseline"),
    )


def metrics_json(metrics: DataFrame, layout: str = "nested") -> DataFrame:
    """One JSON document per (target, accuracy[, candidate_name]) row.

    ``nested``: {"multiclass_classification_metrics": {"accuracy": {"value": x}}};
    ``by_target``: {target: {"accuracy": x}}; ``candidate``: {"metrics": {…}, "candidate_name": …}.
    """
    value = F.struct(F.struct(F.col("accuracy").alias("value")).alias("accuracy"))
    if layout == "nested":
        body = F.struct(value.alias("multiclass_classification_metrics"))
    elif layout == "by_target":
        body = F.create_map(F.col("target"), F.struct("accuracy"))
    else:
        body = F.struct(value.alias("metrics"), F.col("candidate_name"))
    return metrics.select("target", F.to_json(body).alias("document"))


def candidate_metrics(df: DataFrame, candidate: str, name: str, value: str) -> DataFrame:
    """Metrics of each candidate as a map, and its accuracy (0.0 when it has none)."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(name), F.col(value))))
    return (
        df.groupBy(F.col(candidate).alias("candidate"))
        .agg(F.map_from_entries(ordered).alias("metrics"))
        .select("candidate", "metrics", F.coalesce(F.try_element_at("metrics", F.lit("Accuracy")), F.lit(0.0)).alias("accuracy"))
    )


def best_candidate(candidates: DataFrame, by: Sequence[str], score: str = "accuracy", name: str = "candidate") -> DataFrame:
    """Highest score per group, ties to the smallest name."""
    order = W.partitionBy(*by).orderBy(F.desc(score), name)
    return candidates.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def run_summary(results: DataFrame) -> DataFrame:
    """(target, job, status, metric, candidate, error) rows to one line per target; failures stay visible."""
    failed = F.col("error").isNotNull()
    return results.select(
        "target",
        "job",
        F.when(failed, "Error").otherwise(F.coalesce("status", F.lit("Completed"))).alias("status"),
        F.when(~failed, F.col("metric")).alias("best_metric"),
        F.when(~failed, F.col("candidate")).alias("candidate"),
        "error",
    )
