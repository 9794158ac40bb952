"""Checks that fail early with a message naming what is wrong."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, features: Sequence[str] = (), targets: Sequence[str] = ()) -> DataFrame:
    """Schema check only, no job."""
    no_features = [c for c in features if c not in df.columns]
    no_targets = [c for c in targets if c not in df.columns]
    if no_features or no_targets:
        raise ValueError(
            f"missing feature columns {no_features}, missing target columns {no_targets}; found {df.columns}"
        )
    return df


def require_classes(df: DataFrame, target: str, min_classes: int = 2) -> DataFrame:
    found = df.select(target).filter(F.col(target).isNotNull()).distinct().limit(min_classes).count()
    if found < min_classes:
        raise ValueError(f"target {target} needs at least {min_classes} classes, found {found}")
    return df


def classes_outside_train(split: DataFrame, target: str = "target", label: str = "label", side: str = "split") -> DataFrame:
    """(target, label) pairs that never occur in train; empty for a sound split."""
    seen = split.groupBy(target, label).agg(F.max((F.col(side) == "train").cast("int")).alias("_t"))
    return seen.filter(F.col("_t") == 0).drop("_t")


def require_same_keys(a: DataFrame, b: DataFrame, id_col: str) -> None:
    """Both tables must hold the same ids the same number of times."""
    left = a.groupBy(id_col).agg(F.count(F.lit(1)).alias("_a"))
    right = b.groupBy(id_col).agg(F.count(F.lit(1)).alias("_b"))
    odd = left.join(right, id_col, "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).count()
    if odd:
        raise ValueError(f"{odd} values of {id_col} do not match between the two tables")
