"""Per-target datasets, samples and stratified splits.

All targets are handled in one job on the long table ``(id, features…, target, label)``.
Which rows of a class go to validation is decided by hash order, so a split does not
depend on partitioning; how many is the rule of each splitter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from caseworks.functions.clean import valid_target
from caseworks.plans.bounded import bounded_rows, local_table
from caseworks.plans.selection import hash_key, mark_smallest

MAX_DIRECT_SAMPLE = 100
GROUPS = ["target", "label"]


def select_for_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Exactly the features and one target, so other targets cannot leak into the model."""
    return df.select(*features, target)


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def melt_targets(df: DataFrame, id_col: str, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """One row per (row, target) with the label as text; one scan serves every target."""
    pairs = F.array(
        *[F.struct(F.lit(t).alias("target"), F.col(t).cast("string").alias("label")) for t in targets]
    )
    return df.select(id_col, *features, F.inline(pairs))


def prepare_per_target(
    df: DataFrame, id_col: str, features: Sequence[str], targets: Sequence[str], spelled_out: bool = False
) -> DataFrame:
    """Long table without rows whose label is missing (optionally also spelled-out missing)."""
    long = melt_targets(df, id_col, features, targets)
    return long.filter(valid_target("label") if spelled_out else F.col("label").isNotNull())


def prep_manifest(prepared: DataFrame, out: str = "") -> DataFrame:
    """Per target: rows, distinct labels, output path."""
    return prepared.groupBy("target").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("label").alias("unique_labels"),
    ).withColumn("output_path", F.concat(F.lit(out), F.lit("/target="), "target"))


def target_metadata(split: DataFrame, num_features: int) -> DataFrame:
    """Per target: rows, features, classes, and rows on either side of the split."""
    return split.groupBy(F.col("target").alias("target_column")).agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.lit(num_features).alias("num_features"),
        F.countDistinct("label").alias("unique_classes"),
        F.count_if(F.col("split") == "train").alias("train_samples"),
        F.count_if(F.col("split") == "validation").alias("val_samples"),
    )


def prep_manifest_json(prepared: DataFrame, out: str = "") -> DataFrame:
    """The manifest as one JSON document: total rows and an entry per target."""
    entries = prep_manifest(prepared, out)
    body = F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("target", F.struct("rows", "unique_labels", "output_path"))))
    )
    return entries.agg(
        F.to_json(F.struct(F.sum("rows").alias("total_rows"), body.alias("targets"))).alias("manifest")
    )


def sample_exact(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Uniform sample of ``min(n, rows)`` rows without replacement.

    A sort with limit would gather n rows of every partition in one task, so only very small
    samples use it.
    """
    if n <= MAX_DIRECT_SAMPLE:
        return df.orderBy(hash_key(id_col, seed), id_col).limit(n)
    marked = mark_smallest(df, [], id_col, seed, lambda rows: F.least(rows, F.lit(n)))
    return marked.filter("picked").drop("picked")


def _split(long: DataFrame, id_col: str, seed: int, take, groups=GROUPS) -> DataFrame:
    marked = mark_smallest(long, groups, id_col, seed, take, "_val")
    return marked.withColumn("split", F.when(F.col("_val"), "validation").otherwise("train")).drop("_val")


def quota_support_aware(n: Column, val_frac: float, min_support: int, rare_train_only: bool) -> Column:
    share = F.bround(n * F.lit(float(val_frac)), 0).cast("long")
    quota = F.when(n > 1, F.least(share, n - 1)).otherwise(F.lit(0))
    return F.when(n < min_support, F.lit(0)).otherwise(quota) if rare_train_only else quota


def quota_at_least_one(n: Column, val_frac: float, rounding: str) -> Column:
    exact = n * F.lit(float(val_frac))
    share = {"floor": F.floor(exact), "half_even": F.bround(exact, 0)}[rounding].cast("long")
    return F.least(F.greatest(share, F.lit(1)), n - 1)


def split_support_aware(
    df: DataFrame, id_col: str, features: Sequence[str], targets: Sequence[str],
    val_frac: float = 0.2, seed: int = 42, min_support: int = 5, rare_train_only: bool = True,
) -> DataFrame:
    """Classes below ``min_support`` stay in train; others give round-half-even(n*frac) rows, at most n-1."""
    long = prepare_per_target(df, id_col, features, targets)
    return _split(long, id_col, seed, lambda n: quota_support_aware(n, val_frac, min_support, rare_train_only))


def split_at_least_one(
    df: DataFrame, id_col: str, features: Sequence[str], targets: Sequence[str],
    val_frac: float = 0.2, seed: int = 42, rounding: str = "floor",
) -> DataFrame:
    """Every class with two or more rows gives at least one row to each side; singletons stay in train."""
    long = prepare_per_target(df, id_col, features, targets)
    return _split(long, id_col, seed, lambda n: quota_at_least_one(n, val_frac, rounding))


def global_quotas(counts: DataFrame, test_size: float) -> DataFrame:
    """Validation rows per class so that the target's total is exactly ceil(test_size * N).

    Train quotas are proportional, rounded by largest remainder (ties: label order);
    validation takes the rest.
    """
    per_target = W.partitionBy("target")
    total = F.sum("n").over(per_target)
    n_val = F.ceil(total * F.lit(test_size))
    share = F.col("n") * F.col("_train") / F.col("_total")
    ranked = (
        counts.withColumn("_total", total)
        .withColumn("_train", total - n_val)
        .withColumn("_floor", F.floor(share))
        .withColumn("_rest", share - F.floor(share))
    )
    missing = F.col("_train") - F.sum("_floor").over(per_target)
    order = per_target.orderBy(F.desc(F.round("_rest", 9)), "label")
    up = (F.row_number().over(order) <= missing).cast("long")
    return ranked.select("target", "label", (F.col("n") - F.col("_floor") - up).cast("long").alias("take"))


def split_global(
    df: DataFrame, id_col: str, features: Sequence[str], targets: Sequence[str],
    test_size: float = 0.2, seed: int = 42, stratify: str = "auto", spelled_out: bool = True,
) -> DataFrame:
    """Validation is ceil(test_size * N) rows of the target, stratified when possible.

    ``auto``: stratify if every class has two rows, else draw at random; ``try``: fall back
    to random whenever stratification is impossible; ``require``: impossible is an error.
    """
    long = prepare_per_target(df, id_col, features, targets, spelled_out)
    counts = long.groupBy(*GROUPS).agg(F.count(F.lit(1)).alias("n"))
    counts = local_table(counts) or counts
    n = F.sum("n")
    facts = counts.groupBy("target").agg(
        n.alias("n"), F.min("n").alias("smallest"), F.count(F.lit(1)).alias("classes")
    )
    stratified, drawn = [], {}
    for row in bounded_rows(facts, what="target list"):
        n_val = -int(-row["n"] * test_size // 1)
        rare = row["smallest"] < 2
        crowded = n_val < row["classes"] or row["n"] - n_val < row["classes"]
        if (stratify == "require" and (rare or crowded)) or (stratify == "auto" and not rare and crowded):
            raise ValueError(f"target {row['target']} cannot be stratified")
        if rare or crowded:
            drawn[row["target"]] = n_val
        else:
            stratified.append(row["target"])
    parts = []
    if stratified:
        quotas = global_quotas(counts.filter(F.col("target").isin(stratified)), test_size)
        parts.append(_split(long.filter(F.col("target").isin(stratified)), id_col, seed, quotas))
    if drawn:
        spark = df.sparkSession
        takes = spark.createDataFrame(list(drawn.items()), "target string, take long")
        parts.append(_split(long.filter(F.col("target").isin(list(drawn))), id_col, seed, takes, ["target"]))
    if not parts:
        return long.withColumn("split", F.lit("train"))
    return reduce(DataFrame.unionByName, parts)
