"""Sinks: per-target splits, label-first matrices, libsvm, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.operators.splits import prep_manifest_json


def write_cases(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_splits(df: DataFrame, out: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """One folder per (target, split) from a single pass; a large target is written by many tasks."""
    writer = df.write.mode(mode).partitionBy("target", "split")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(out)
    else:
        writer.format(fmt).save(out)


def label_matrix(df: DataFrame, label: str, features: Sequence[str] | str, size: int | None = None,
                 label_last: bool = False) -> DataFrame:
    """Label and numeric features as plain columns; a vector column of ``size`` entries is expanded."""
    if isinstance(features, str):
        staged = df.select(F.col(label), vector_to_array(features).alias("_a"))
        values = [F.col("_a")[i].alias(f"f{i}") for i in range(size)]
    else:
        staged, values = df, [F.col(c).cast("double") for c in features]
    named = F.col(label).alias("target")
    return staged.select(*values, named) if label_last else staged.select(named, *values)


def write_label_first_csv(df: DataFrame, label: str, features: Sequence[str] | str, path: str,
                          size: int | None = None, mode: str = "errorifexists") -> None:
    """Headerless CSV, label first."""
    label_matrix(df, label, features, size).write.mode(mode).option("header", False).csv(path)


def write_label_last_csv(df: DataFrame, label: str, features: Sequence[str] | str, path: str,
                         size: int | None = None, mode: str = "errorifexists") -> None:
    """CSV with header and a trailing ``target`` column."""
    label_matrix(df, label, features, size, label_last=True).write.mode(mode).option("header", True).csv(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features",
                 mode: str = "errorifexists") -> None:
    data = df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
    data.write.mode(mode).format("libsvm").save(path)


def write_manifest(prepared: DataFrame, out: str, path: str, mode: str = "errorifexists") -> None:
    prep_manifest_json(prepared, out).write.mode(mode).text(path)
