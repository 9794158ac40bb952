"""Batch scoring with one, many or dispatched models, and prediction capture."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.clean import as_column
from caseworks.operators.boosting import SoftmaxTreesModel
from caseworks.operators.features import md5_bucket
from caseworks.operators.linear import LinearModel, margins_of
from caseworks.operators.training import Classifier
from caseworks.plans.stages import VectorBatch


def _label_array(labels: Sequence[str]) -> Column:
    return F.from_json(F.lit(json.dumps(list(labels))), "array<string>")


def _probabilities(model) -> Column:
    if isinstance(model, OneVsRestModel):
        # One independent logistic output per class, scaled to sum to one.
        # A boosted tree's margin is half the log-odds, other members give the log-odds.
        scale = F.array(*[F.lit(2.0 if isinstance(m, GBTClassificationModel) else 1.0) for m in model.models])
        each = F.zip_with(vector_to_array("rawPrediction"), scale, lambda r, k: F.lit(1.0) / (F.lit(1.0) + F.exp(-k * r)))
        total = F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
        return F.transform(each, lambda p: F.when(total > 0, p / total).otherwise(0.0))
    return vector_to_array("probability")


def score(df: DataFrame, clf: Classifier) -> DataFrame:
    """Input columns plus ``prediction`` and ``probabilities`` (in class order); no shuffle.

    A column named like the target is dropped first. A class index without a name shows as its number.
    """
    return _scored(df.drop(clf.target) if clf.target in df.columns and clf.target not in _inputs(clf) else df, clf)


def _scored(df: DataFrame, clf: Classifier) -> DataFrame:
    scored = clf.model.transform(clf.features(df))
    index = F.col("prediction").cast("int")
    name = F.coalesce(F.try_element_at(_label_array(clf.labels), index + 1), index.cast("string"))
    return scored.select(*df.columns, name.alias("prediction"), _probabilities(clf.model).alias("probabilities"))


def _inputs(clf: Classifier) -> list[str]:
    return [*clf.routing.numeric, *clf.routing.categorical, *clf.routing.text]


def score_all_targets(df: DataFrame, models: Mapping[str, Classifier], id_col: str, top: int = 3) -> DataFrame:
    """(id, target, prediction, confidence, top): every row scored by every model.

    ``top`` holds the most probable classes with their probabilities, most probable first.
    The rows are read once: each model adds its answer to the row, then the answers become rows.
    """
    inputs = dict.fromkeys(c for clf in models.values() for c in _inputs(clf) if c != id_col)
    rows, answers = df.select(id_col, *inputs), []
    for number, (target, clf) in enumerate(sorted(models.items())):
        pairs = F.zip_with("probabilities", _label_array(clf.labels), lambda p, l: F.struct(p.alias("p"), l.alias("l")))
        best = F.slice(F.sort_array(pairs, asc=False), 1, top)
        answer = F.struct(
            F.lit(target).alias("target"), "prediction", F.array_max("probabilities").alias("confidence"),
            F.transform(best, lambda e: F.struct(e["l"].alias("label"), e["p"].alias("probability"))).alias("top"),
        )
        rows = _scored(rows, clf).select(*rows.columns, answer.alias(f"_answer{number}"))
        answers.append(f"_answer{number}")
    return rows.select(id_col, F.inline(F.array(*answers)))


def batch_scorer(model) -> Callable[[VectorBatch], np.ndarray] | None:
    """Function from vectors to probabilities (rows x classes) of models that are tables of numbers; None for others."""
    if isinstance(model, LinearModel):
        weights, intercepts = model.coefficients, model.intercepts

        def linear(batch: VectorBatch) -> np.ndarray:
            p = 1 / (1 + np.exp(-np.clip(margins_of(batch.row, batch.index, batch.value, batch.rows, weights, intercepts), -700, 700)))
            total = p.sum(1, keepdims=True)
            return np.divide(p, total, out=np.zeros_like(p), where=total > 0)

        return linear
    if isinstance(model, SoftmaxTreesModel):
        trees, priors, used = model.trees, np.array(model.priors), model.trees.used()

        def boosted(batch: VectorBatch) -> np.ndarray:
            columns = batch.columns(used)
            margins = np.tile(priors, (batch.rows, 1))
            trees.add(margins, columns, used)
            return _softmax(margins)

        return boosted
    if isinstance(model, LogisticRegressionModel) and model.numClasses >= 2:
        weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        if len(intercepts) == 1:
            weights, intercepts = np.concatenate([np.zeros_like(weights), weights]), np.concatenate([[0.0], intercepts])
        return lambda batch: _softmax(margins_of(batch.row, batch.index, batch.value, batch.rows, weights, intercepts))
    return None


def _softmax(margins: np.ndarray) -> np.ndarray:
    powers = np.exp(margins - margins.max(1, keepdims=True))
    return powers / powers.sum(1, keepdims=True)


def _answers(models: Mapping[str, Classifier]) -> Callable[[Column, Column], Column]:
    """Function of (target, vector) that gives the probabilities of the row's own target's model; NULL without one."""
    scorers = {target: batch_scorer(clf.model) for target, clf in models.items()}

    @F.arrow_udf("array<double>")
    def answers(targets: pa.Array, vectors: pa.Array) -> pa.Array:
        found = [None] * len(targets)
        codes = pc.dictionary_encode(targets)
        place = codes.indices.to_numpy(zero_copy_only=False)
        for code, target in enumerate(codes.dictionary.to_pylist()):
            rows = np.flatnonzero(place == code)
            if target is None or not len(rows):
                continue
            own = scorers[target](VectorBatch(vectors.take(pa.array(rows))))
            for row, probabilities in zip(rows.tolist(), own.tolist(), strict=True):
                found[row] = probabilities
        return pa.array(found, pa.list_(pa.float64()))

    return answers


def score_dispatch(
    requests: DataFrame, models: Mapping[str, Classifier], schema: str, request_id: str = "request_id",
    target: str = "target", instances: str = "instances",
) -> DataFrame:
    """Score request rows that name their target.

    ``instances`` is a JSON array of records with the fields of ``schema``. Result:
    (request_id, position, target, prediction, probabilities, error); a malformed request or
    an unknown target gives one row with the error text. If all models take the same features and are tables of numbers (linear or
    boosted), requests are read and parsed once, and each row goes to its own target's model only; otherwise once per target.
    """
    known = sorted(models)
    parsed = requests.withColumn(
        "_rows", F.when(F.ltrim(instances).startswith("["), F.from_json(instances, f"array<struct<{schema}>>"))
    )
    bad = F.col(target).isNull() | (F.col(target) == "") | F.col("_rows").isNull()
    error = F.when(bad, F.lit("expected a target and a list of instances")).when(
        ~F.col(target).isin(known),
        F.concat(F.lit("unknown target '"), F.col(target), F.lit(f"'; available: {', '.join(known)}")),
    )
    checked = parsed.withColumn("error", error)
    routings = {(clf.variant, clf.routing.to_json()) for clf in models.values()}
    if len(routings) == 1 and all(clf.variant != "encoded" and batch_scorer(clf.model) for clf in models.values()):
        return _dispatched(checked, models, request_id, target)
    rejects = checked.filter(F.col("error").isNotNull()).select(
        request_id, F.lit(None).cast("int").alias("position"), F.col(target).alias("target"),
        F.lit(None).cast("string").alias("prediction"),
        F.lit(None).cast("array<double>").alias("probabilities"), "error",
    )
    rows = checked.filter(F.col("error").isNull()).select(
        request_id, F.col(target).alias("_target"), F.posexplode("_rows").alias("position", "_row")
    )

    def one(name: str) -> DataFrame:
        mine = rows.filter(F.col("_target") == name).select(request_id, "position", "_row.*")
        return score(mine, models[name]).select(
            request_id, "position", F.lit(name).alias("target"), "prediction", "probabilities",
            F.lit(None).cast("string").alias("error"),
        )

    return reduce(DataFrame.unionByName, [one(t) for t in known], rejects)


def _dispatched(checked: DataFrame, models: Mapping[str, Classifier], request_id: str, target: str) -> DataFrame:
    """``score_dispatch`` in one scan of requests with their ``error`` and ``_rows``."""
    sound = F.col("error").isNull()
    rows = checked.select(
        request_id, F.col(target).alias("_asked"), F.when(sound, F.col(target)).alias("_target"), F.col("error").alias("_error"),
        F.posexplode_outer(F.when(sound, F.col("_rows"))).alias("_position", "_row"),
    ).filter(F.col("_error").isNotNull() | F.col("_position").isNotNull())
    first = next(iter(models.values()))
    featured = first.features(rows.select(F.col(request_id).alias("_request"), "_asked", "_target", "_error", "_position", "_row.*"))
    made = featured.select("_request", "_asked", "_target", "_error", "_position", _answers(models)(F.col("_target"), F.col("features")).alias("_p"))
    index = (F.array_position("_p", F.array_max("_p")) - 1).cast("int")
    names = F.element_at(F.from_json(F.lit(json.dumps({t: list(c.labels) for t, c in models.items()})), "map<string,array<string>>"), F.col("_target"))
    name = F.when(F.col("_p").isNotNull(), F.coalesce(F.try_element_at(names, index + 1), index.cast("string")))
    return made.select(
        F.col("_request").alias(request_id), F.col("_position").alias("position"), F.col("_asked").alias("target"), name.alias("prediction"),
        F.col("_p").alias("probabilities"), F.col("_error").alias("error"),
    )


def format_predictions(
    df: DataFrame, request: str, position: str, how: str | Sequence[str] = "json", prediction: str = "prediction"
) -> DataFrame:
    """(request, body): the answers of one request in order, as JSON list, comma text or {"prediction": […]}.

    Several forms asked for together come from one grouping, each in a column of its name.
    One request is one document and came in as one; requests are never merged.
    """
    listed = F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), F.col(prediction).alias("v"))))
    values = F.transform(F.col("_l"), lambda e: e["v"])
    body = {
        "json": F.to_json(values),
        "csv": F.concat_ws(",", values),
        "object": F.to_json(F.struct(values.alias("prediction"))),
    }
    forms = [body[how].alias("body")] if isinstance(how, str) else [body[h].alias(h) for h in how]
    return df.groupBy(request).agg(listed.alias("_l")).select(request, *forms)


def to_csv_line(cols: Sequence[Column | str]) -> Column:
    """One CSV line; fields with comma, quote or line break are quoted, NULL is empty."""

    def quoted(c: Column | str) -> Column:
        text = F.coalesce(as_column(c).cast("string"), F.lit(""))
        escaped = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.rlike('[,"\\n\\r]'), escaped).otherwise(text)

    return F.concat_ws(",", *[quoted(c) for c in cols])


def captured(scored: DataFrame, id_col: str, percent: float) -> DataFrame:
    """The share of rows a capture keeps, chosen by id so that re-runs keep the same rows."""
    return scored.filter(md5_bucket(F.col(id_col).cast("string"), 10_000) < int(round(percent * 100)))


def capture(scored: DataFrame, id_col: str, percent: float, path: str) -> None:
    """Append inputs and outputs of ``percent`` percent of the scored rows as JSON."""
    captured(scored, id_col, percent).write.mode("append").json(path)
