"""Classifiers per target: linear, boosted trees, candidate search, per-target fan-out."""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.base import Model
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    OneVsRestModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from caseworks.operators.boosting import SoftmaxTreesModel, fit_softmax_trees
from caseworks.operators.linear import LinearModel, fit_one_vs_rest, vector_size
from caseworks.operators.features import (
    FeatureRouting,
    featurize,
    featurize_encoded,
    featurize_words,
    fit_encoders,
    label_map,
)
from caseworks.plans.bounded import bounded_rows, lookup_join

MAX_CLASSES = 100_000
#: Models with a format of their own.
OWN_MODELS = {m.__name__: m for m in (SoftmaxTreesModel, LinearModel)}
LOADERS = {
    "OneVsRestModel": OneVsRestModel,
    "LogisticRegressionModel": LogisticRegressionModel,
    "RandomForestClassificationModel": RandomForestClassificationModel,
}


@dataclass
class Classifier:
    """A fitted model with what scoring needs: target, feature routing and class names."""

    target: str
    model: Model | SoftmaxTreesModel | LinearModel
    labels: list[str]
    routing: FeatureRouting
    variant: str = "values"
    facts: dict = field(default_factory=dict)
    encoders: dict[str, DataFrame] = field(default_factory=dict)

    def features(self, df: DataFrame) -> DataFrame:
        """Feature vector by variant: whole values hashed, words hashed, or categories encoded."""
        if self.variant == "words":
            return featurize_words(df, self.routing)
        if self.variant == "encoded":
            return featurize_encoded(df, self.routing, self.encoders, df.columns[:1])
        return featurize(df, self.routing)

    def save(self, spark: SparkSession, path: str) -> None:
        """Folder with ``model``, ``features`` and ``labels``."""
        if type(self.model).__name__ in OWN_MODELS:
            self.model.save(spark, f"{path}/model")
        else:
            self.model.write().overwrite().save(f"{path}/model")
        meta = json.dumps(
            {
                "target": self.target,
                "class": type(self.model).__name__,
                "variant": self.variant,
                "routing": json.loads(self.routing.to_json()),
                "facts": self.facts,
            }
        )
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/features")
        for column, codes in self.encoders.items():
            codes.write.mode("overwrite").parquet(f"{path}/encoders/{column}")
        rows = list(enumerate(self.labels))
        spark.createDataFrame(rows, "index int, label string").coalesce(1).write.mode("overwrite").parquet(f"{path}/labels")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Classifier:
        meta = json.loads(spark.read.text(f"{path}/features").first()[0])
        labels = [r["label"] for r in bounded_rows(spark.read.parquet(f"{path}/labels").orderBy("index"), MAX_CLASSES)]
        if meta["class"] in OWN_MODELS:
            model = OWN_MODELS[meta["class"]].load(spark, f"{path}/model")
        else:
            model = LOADERS[meta["class"]].load(f"{path}/model")
        routing = FeatureRouting(**meta["routing"])
        encoded = routing.categorical if meta["variant"] == "encoded" else []
        encoders = {c: spark.read.parquet(f"{path}/encoders/{c}") for c in encoded}
        return Classifier(meta["target"], model, labels, routing, meta["variant"], meta["facts"], encoders)


def train_linear(train: DataFrame, reg: float = 1e-4, max_iter: int = 20, one_vs_rest: bool = True) -> Model | LinearModel:
    """Logistic loss with L2 penalty on (label, features); one-vs-rest, all classes in each pass, or one multinomial fit."""
    if not one_vs_rest:
        return LogisticRegression(regParam=reg, maxIter=max_iter).fit(train)
    facts = train.agg(F.max("label").alias("last"), F.max(vector_size(F.col("features"))).alias("width")).first()
    if facts["last"] is None:
        raise ValueError("no training rows")
    return fit_one_vs_rest(train, int(facts["last"]) + 1, facts["width"], reg, max_iter)


def train_trees(
    train: DataFrame, val: DataFrame | None = None, rounds: int = 200, depth: int = 6, eta: float = 0.2,
    subsample: float = 1.0, columns: float = 1.0, early_stop: int | None = None, tolerance: float = 0.0,
    seed: int = 42,
) -> SoftmaxTreesModel:
    """Boosted trees under the softmax loss, whatever the number of classes.

    With ``early_stop`` the fit ends once the log loss of ``val`` has not fallen by a
    share ``tolerance`` for that many rounds, and the best round is kept.
    """
    if early_stop and val is None:
        raise ValueError("early_stop needs validation rows")
    counts = bounded_rows(train.groupBy("label").agg(F.count(F.lit(1)).alias("n")), MAX_CLASSES, "class list")
    held = {int(r["label"]): r["n"] for r in counts}
    if not held:
        raise ValueError("no training rows")
    total = sum(held.values()) + max(held) + 1
    priors = [math.log((held.get(k, 0) + 1) / total) for k in range(max(held) + 1)]
    return fit_softmax_trees(train, priors, val, rounds, depth, eta, subsample, columns, early_stop, tolerance, seed)


def train_forest(train: DataFrame, trees: int = 200, depth: int = 6, subsample: float = 1.0, seed: int = 42) -> Model:
    """Random forest on (label, features)."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, subsamplingRate=subsample, seed=seed).fit(train)


def holdout_accuracy(model: Model, val: DataFrame) -> float | None:
    """Accuracy on (label, features); None for an empty validation set."""
    return model.transform(val).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def within(spark: SparkSession, run: Callable[[], object], seconds: float) -> object:
    """``run()``; its Spark jobs are cancelled and TimeoutError raised once ``seconds`` have passed.

    The jobs carry a tag of their own, so others go on. Jobs that ``run`` starts after the limit are cancelled too.
    """
    context, tag = spark.sparkContext, f"within-{uuid.uuid4().hex}"

    def tagged() -> object:
        context.addJobTag(tag)
        return run()

    with ThreadPoolExecutor(1) as pool:
        future = pool.submit(inheritable_thread_target(spark)(tagged))
        late = False
        left = seconds
        while True:
            done, _ = wait([future], timeout=max(left, 0.0))
            if done:
                break
            late, left = True, 0.2
            context.cancelJobsWithTag(tag)
    if late:
        raise TimeoutError(f"ended after {seconds:g} seconds")
    return future.result()


def search_best(
    train: DataFrame, val: DataFrame, candidates: Sequence[tuple[str, Callable[[DataFrame], Model]]],
    max_candidates: int = 10, max_seconds: float = 3600.0, max_seconds_each: float = 600.0,
) -> tuple[Model, list[tuple[str, str, float | None, float, str | None]]]:
    """Fit candidates in order until a budget ends and keep the one most accurate on ``val``.

    A fit that reaches its own limit, or the end of the whole budget, is ended there (its jobs are cancelled) and reported as
    ``OverBudget``. Returns the model and one (candidate, status, accuracy, seconds, error) row per candidate; those the budgets leave
    out are reported as ``NotTried``.
    """
    best, best_score, report = None, -1.0, []
    spark, start = train.sparkSession, time.monotonic()
    train, val = (d.persist(StorageLevel.MEMORY_AND_DISK) for d in (train, val))

    def tried(fit: Callable[[DataFrame], Model]) -> tuple[Model, float | None]:
        model = fit(train)
        return model, holdout_accuracy(model, val)

    try:
        for number, (name, fit) in enumerate(candidates):
            began = time.monotonic()
            left = max_seconds - (began - start)
            if number >= max_candidates or left <= 0:
                report.append((name, "NotTried", None, 0.0, None))
                continue
            try:
                model, score = within(spark, lambda: tried(fit), min(left, max_seconds_each))
                report.append((name, "Completed", score, time.monotonic() - began, None))
                if (score or 0.0) > best_score:
                    best, best_score = model, score or 0.0
            except TimeoutError as exc:
                report.append((name, "OverBudget", None, time.monotonic() - began, str(exc)))
            except Exception as exc:
                report.append((name, "Failed", None, time.monotonic() - began, f"{type(exc).__name__}: {exc}"[:2000]))
    finally:
        train.unpersist()
        val.unpersist()
    if best is None:
        raise RuntimeError(f"no candidate could be used: {report}")
    return best, report


def labelled(df: DataFrame, labels: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """(label index as double, features) from (label string, features); unknown labels leave."""
    indexed = lookup_join(df, labels, ["label"], spread_by, "inner")
    return indexed.select(F.col("index").cast("double").alias("label"), "features")


def fit_target(
    split: DataFrame, id_col: str, target: str, routing: FeatureRouting, trainer: Callable[[DataFrame, DataFrame], Model],
    variant: str = "values", fit_labels_on: str = "train", encoders: dict[str, DataFrame] | None = None,
) -> Classifier:
    """One target of a featurized split table: label map, fit, validation accuracy.

    ``fit_labels_on="all"`` takes classes that occur only in validation into the map too.
    """
    rows = split.filter(F.col("target") == target)
    train, val = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "validation")
    codes = label_map(train if fit_labels_on == "train" else rows)
    names = [r["label"] for r in bounded_rows(codes.orderBy("index"), MAX_CLASSES, "class list")]
    coded = df_from_labels(split.sparkSession, names)
    train_xy, val_xy = labelled(train, coded, [id_col]), labelled(val, coded, [id_col])
    model = trainer(train_xy, val_xy)
    facts = {"accuracy": holdout_accuracy(model, val_xy), "num_class": len(names)}
    return Classifier(target, model, names, routing, variant, facts, encoders or {})


def df_from_labels(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(zip(names, range(len(names)))), "label string, index long")


def train_all_targets(
    split: DataFrame, id_col: str, targets: Sequence[str], routing: FeatureRouting,
    trainer: Callable[[DataFrame, DataFrame], Model], variant: str = "values", parallel: int = 4,
    fit_labels_on: str = "train", encoders: dict[str, DataFrame] | None = None,
) -> tuple[dict[str, Classifier], list[tuple[str, str, float | None, str | None]]]:
    """One classifier per target, trained concurrently on one cached feature table.

    ``split`` is (id, features…, target, label, split), or holds the ``features`` vector
    already, computed once per row before the targets were spread out. A failing target is
    reported and does not stop the others; returns the classifiers and (target, status,
    accuracy, error) rows.
    """
    spark = split.sparkSession
    own = variant == "encoded" and encoders is None and "features" not in split.columns
    plain = Classifier("", None, [], routing, variant, encoders=encoders or {})
    if own:
        # A row may train one target and validate another: each target has encoders of its own.
        table = split
    else:
        ready = split if "features" in split.columns else plain.features(split)
        table = ready.select(id_col, "target", "label", "split", "features")
    table = table.persist(StorageLevel.MEMORY_AND_DISK)

    def one(target: str):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"target-{target}")
        try:
            if not own:
                return fit_target(table, id_col, target, routing, trainer, variant, fit_labels_on, encoders), None
            rows = table.filter(F.col("target") == target)
            fitted = fit_encoders(rows.filter(F.col("split") == "train"), routing)
            coded = Classifier("", None, [], routing, variant, encoders=fitted).features(rows)
            coded = coded.select(id_col, "target", "label", "split", "features")
            return fit_target(coded, id_col, target, routing, trainer, variant, fit_labels_on, fitted), None
        except Exception as exc:
            return None, f"{type(exc).__name__}: {exc}"[:2000]

    try:
        with ThreadPoolExecutor(parallel) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(one), targets))
    finally:
        table.unpersist()
    models = {t: c for t, (c, _) in zip(targets, results) if c is not None}
    report = [
        (t, "Completed" if c else "Error", c.facts["accuracy"] if c else None, error)
        for t, (c, error) in zip(targets, results)
    ]
    return models, report
