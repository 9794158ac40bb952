"""Append-only model registry: versions, quality gate, latest lookup, completeness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = (
    "client string, target string, group_name string, path string, accuracy double, "
    "status string, created_at timestamp_ntz"
)
REQUIRED_FILES = ("model", "features", "labels")
QUALITY_GATE = 0.7


def group_name(client, target):
    return F.concat(client, F.lit("-"), target, F.lit("-models"))


def register(
    spark: SparkSession, registry: str, client: str, target: str, path: str, accuracy: float,
    status: str = "Approved", created_at: datetime | None = None,
) -> None:
    """Append one version; every call adds a file, nothing is rewritten."""
    when = created_at or datetime.now(timezone.utc).replace(tzinfo=None)
    row = (client, target, f"{client}-{target}-models", path, float(accuracy), status, when)
    spark.createDataFrame([row], REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(registry)


def register_all(versions: DataFrame, registry: str) -> None:
    """Append a table of versions (client, target, path, accuracy, status, created_at) in one write."""
    named = versions.withColumn("group_name", group_name(F.col("client"), F.col("target")))
    columns = [c.split()[0] for c in REGISTRY_SCHEMA.split(", ")]
    named.select(*columns).write.mode("append").parquet(registry)


def gate(metrics: DataFrame, threshold: float = QUALITY_GATE, metric: str = "accuracy") -> DataFrame:
    return metrics.filter(F.col(metric) >= threshold)


def latest_models(versions: DataFrame, approved_only: bool = True, by: Sequence[str] = ("client", "target")) -> DataFrame:
    """Newest version per (client, target); a single aggregate, no sort of the versions."""
    rows = versions.filter(F.col("status") == "Approved") if approved_only else versions
    rest = [c for c in versions.columns if c not in by and c != "created_at"]
    newest = F.max(F.struct("created_at", *rest))
    return rows.groupBy(*by).agg(newest.alias("_v")).select(*by, "_v.*")


def check_bundles(files: DataFrame, required: Sequence[str] = REQUIRED_FILES) -> DataFrame:
    """(target, missing, complete) from a (target, kind) listing."""
    present = files.filter(F.col("kind").isin(*required)).groupBy("target").agg(F.collect_set("kind").alias("_k"))
    everyone = files.select("target").distinct().join(present, "target", "left")
    absent = F.array_except(F.array(*[F.lit(k) for k in sorted(required)]), F.coalesce("_k", F.array().cast("array<string>")))
    return everyone.select("target", F.concat_ws(",", absent).alias("missing"), (F.size(absent) == 0).alias("complete"))


def require_bundles(files: DataFrame, targets: Sequence[str], artifacts: Sequence[str], required=REQUIRED_FILES) -> None:
    """Building needs one artifact per target, all complete, all with the same runtime image."""
    if len(targets) != len(artifacts):
        raise ValueError(f"{len(targets)} targets but {len(artifacts)} artifacts")
    state = {r["target"]: r["missing"] for r in check_bundles(files.filter(F.col("target").isin(list(targets))), required).collect()}
    bad = {t: state.get(t, ",".join(required)) for t in targets if state.get(t, "all")}
    if bad:
        raise ValueError(f"incomplete bundles: {bad}")
    if "image" in files.columns and files.select("image").filter(F.col("image").isNotNull()).distinct().limit(2).count() > 1:
        raise ValueError("artifacts use more than one runtime image")
