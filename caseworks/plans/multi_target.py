"""Train, evaluate, gate and register one model per target, in one application."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.ml.base import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.operators.evaluation import run_summary
from caseworks.operators.features import route_features
from caseworks.operators.registry import QUALITY_GATE, gate, register_all
from caseworks.operators.splits import split_support_aware
from caseworks.operators.training import Classifier, train_all_targets, train_linear
from caseworks.sources.checks import require_classes, require_columns

RESULT_SCHEMA = "target string, job string, status string, metric double, candidate string, error string"


def train_evaluate_register(
    df: DataFrame, id_col: str, features: Sequence[str], targets: Sequence[str], client: str, out: str,
    trainer: Callable[[DataFrame, DataFrame], Model] | None = None, threshold: float = QUALITY_GATE,
    variant: str = "values", rule: str = "A",
) -> tuple[dict[str, Classifier], DataFrame]:
    """Split all targets in one job, train them concurrently, save and register what passes the gate.

    Models go to ``out/models/<target>/<time>``, versions are appended to ``out/registry``.
    Returns the classifiers and the run summary; a target that fails is a row with its error.
    """
    require_columns(df, features, targets)
    for target in targets:
        require_classes(df, target)
    routing = route_features(df.schema, features, rule)
    if variant == "encoded":  # encoders are learned from the train part, so features come after the split
        split = split_support_aware(df.select(id_col, *features, *targets), id_col, list(features), targets)
    else:  # features once per row, before the row is repeated per target
        rows = Classifier("", None, [], routing, variant).features(df).select(id_col, "features", *targets)
        split = split_support_aware(rows, id_col, ["features"], targets)
    trainer = trainer or (lambda train, val: train_linear(train, one_vs_rest=False))
    models, report = train_all_targets(split, id_col, targets, routing, trainer, variant)
    spark, now = df.sparkSession, datetime.now(timezone.utc).replace(tzinfo=None)
    stamp = now.strftime("%Y%m%dT%H%M%S%f")
    rows = [(t, f"{client}-{t}-{stamp}", status, score, "linear", error) for t, status, score, error in report]
    results = spark.createDataFrame(rows, RESULT_SCHEMA)
    passed = [r["target"] for r in gate(results.filter("error IS NULL"), threshold, "metric").collect()]
    paths = {t: f"{out}/models/{t}/{stamp}" for t in passed}
    for target, path in paths.items():
        models[target].save(spark, path)
    if paths:
        versions = spark.createDataFrame(
            [(client, t, p, float(models[t].facts["accuracy"]), "Approved", now) for t, p in paths.items()],
            "client string, target string, path string, accuracy double, status string, created_at timestamp_ntz",
        )
        register_all(versions.coalesce(1), f"{out}/registry")
    summary = run_summary(results)
    return models, summary.withColumn("registered", F.col("target").isin(passed) if passed else F.lit(False))
