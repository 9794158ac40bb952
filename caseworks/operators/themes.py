"""Themes: clustering, centres, representatives, keywords, labels."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from caseworks.functions.clean import LABEL_CHARS, truncate_chars
from caseworks.functions.text import STOP_WORDS
from caseworks.functions.vectors import cosine_distance
from caseworks.operators.tfidf import TfidfModel, tfidf_per_group
from caseworks.plans.bounded import lookup_join
from caseworks.plans.selection import mark_smallest
from caseworks.plans.stages import VectorBatch, blocks_of, collected, drop_stage, summed, write_stage
from caseworks.session import checkpoint_folder

#: Bytes of centres in one block, blocks a row passes in one job, and cells of a matrix of distances.
BLOCK_BYTES, CHAIN, CELLS = 16 << 20, 8, 1 << 22
#: Centres a join holds in every task; more are joined by a shuffle.
LOCAL_CENTRES = 10_000
#: Rows looked at for each first centre of a theme, and bytes of sums a task holds.
START_ROWS, HELD_SUMS = 16, 256 << 20

LABEL_TASK = (
    "Name the common theme of the support tickets below in three to seven plain business words, "
    "without punctuation, and reply with the name only."
)


def _as_vector(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, VectorUDT):
        return F.col(col)
    return array_to_vector(F.col(col).cast("array<double>"))


def _as_array(df: DataFrame, col: str) -> Column:
    return vector_to_array(col) if isinstance(df.schema[col].dataType, VectorUDT) else F.col(col)


def kmeans_with_centres(
    df: DataFrame, id_col: str, features: str, k: int = 12, seed: int = 42, max_iter: int = 20, out: str = "theme",
) -> tuple[DataFrame, DataFrame]:
    """Hard k-means: (id, theme) of every row, and (theme, centre) of the fitted model.

    Features may be costly (an embedding call), so they are computed once: the fit and the
    assignment share a cache, and the narrow result is checkpointed before it is dropped.
    The centres can be stored, serve ``assign_nearest`` for new cases and ``centre_keywords``.
    """
    checkpoint_folder(df.sparkSession)
    points = df.select(id_col, _as_vector(df, features).alias("_v")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_v", predictionCol=out).fit(points)
        assigned = model.transform(points).select(id_col, out).checkpoint()
    finally:
        points.unpersist()
    centres = [(theme, centre.tolist()) for theme, centre in enumerate(model.clusterCenters())]
    return assigned, df.sparkSession.createDataFrame(centres, "theme int, centre array<double>")


def kmeans_themes(
    df: DataFrame, id_col: str, features: str, k: int = 12, seed: int = 42, max_iter: int = 20, out: str = "theme",
) -> DataFrame:
    """Hard k-means assignment of every row; (id, theme)."""
    return kmeans_with_centres(df, id_col, features, k, seed, max_iter, out)[0]


def _starts(points: DataFrame, parts: Callable[[Column], Column], seed: int) -> DataFrame:
    """(theme_top, part, _v): first centres of each theme, picked far from one another among its rows of least hash.

    A theme of n rows has ``parts(n)`` of them; ``START_ROWS`` times as many rows are looked at.
    """
    looked = mark_smallest(points, ["theme_top"], "_id", seed, lambda n: F.least(n, parts(n) * START_ROWS)).filter("picked")
    sized = points.groupBy("theme_top").agg(parts(F.count(F.lit(1))).cast("int").alias("k"))
    rows = lookup_join(looked.select("theme_top", "_id", vector_to_array("_v").alias("x")), sized, ["theme_top"], ["_id"], "inner")

    def spread(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_id", key=lambda ids: [hashlib.md5(f"{i}-{seed}".encode()).hexdigest() for i in ids])
        x = np.stack(group["x"].to_numpy())
        chosen, apart = [0], ((x - x[0]) ** 2).sum(1)
        while len(chosen) < min(int(group["k"].iloc[0]), len(x)):
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, ((x - x[chosen[-1]]) ** 2).sum(1))
        return pd.DataFrame({"theme_top": group["theme_top"].iloc[0], "part": range(len(chosen)), "x": [x[i].tolist() for i in chosen]})

    return rows.groupBy("theme_top").applyInPandas(spread, "theme_top int, part int, x array<double>")


class _Centres:
    """Centres of all themes; those of theme t stand at ``first[t]`` to ``first[t] + count[t] - 1``."""

    def __init__(self, themes: np.ndarray, count: np.ndarray, values: np.ndarray):
        self.themes, self.count, self.values = themes, count, values
        self.first = np.cumsum(count) - count
        self.square = (values**2).sum(1)

    def nearest(self, theme: np.ndarray, batch: VectorBatch) -> np.ndarray:
        """Place of each row's nearest centre among those of its own theme (ties to the first); -1 for unknown themes."""
        at = np.minimum(np.searchsorted(self.themes, theme), max(len(self.themes) - 1, 0))
        known = self.themes[at] == theme
        best, found = np.full(batch.rows, np.inf), np.full(batch.rows, -1)
        inside = batch.index < self.values.shape[1]
        row, index, value = batch.row[inside], batch.index[inside], batch.value[inside]
        for part in range(int(self.count.max(initial=0))):
            own = known & (part < self.count[at])
            place = np.where(own, self.first[at] + part, 0)
            product = np.bincount(row, value * self.values[place[row], index], batch.rows)
            distance = np.where(own, self.square[place] - 2 * product, np.inf)
            closer = distance < best
            best, found = np.where(closer, distance, best), np.where(closer, place, found)
        return found


def grouped_kmeans(points: DataFrame, starts: _Centres, max_iter: int = 20, tolerance: float = 1e-4) -> _Centres:
    """Lloyd steps of all themes of ``points`` (theme_top, _v) at once, each row against its own theme's centres only.

    An iteration is one job: tasks add up rows by centre, the sums meet by centre and block. It ends when no centre
    moves further than ``tolerance``. Centres without rows stay.
    """
    centres, context = starts, points.sparkSession.sparkContext
    for _ in range(max_iter):
        held = context.broadcast(centres)

        def run(batches: Iterator[pa.RecordBatch], held: Broadcast = held) -> Iterator[pa.RecordBatch]:
            own = held.value
            width = own.values.shape[1]
            sums: dict[int, np.ndarray] = {}
            for rows in batches:
                batch = VectorBatch(rows.column(1))
                place = own.nearest(rows.column(0).to_numpy(), batch)
                at = place[batch.row]
                order = np.argsort(at, kind="stable")
                edges = np.searchsorted(at[order], np.arange(len(own.values) + 1))
                counts = np.bincount(place[place >= 0], minlength=len(own.values))
                for c in np.flatnonzero(counts).tolist():
                    part = order[edges[c] : edges[c + 1]]
                    total = np.append(np.bincount(batch.index[part], batch.value[part], width), counts[c])
                    sums[c] = sums[c] + total if c in sums else total
                if 8 * len(sums) * width > HELD_SUMS:
                    for c, total in sums.items():
                        yield from blocks_of(c, total)
                    sums.clear()
            for c, total in sums.items():
                yield from blocks_of(c, total)

        found = collected(summed(points.select("theme_top", "_v").mapInArrow(run, "part int, block int, total binary")))
        after = centres.values.copy()
        for c, total in found.items():
            after[c] = total[:-1] / total[-1]
        shift = np.sqrt(((after - centres.values) ** 2).sum(1)).max(initial=0.0)
        held.destroy()
        centres = _Centres(centres.themes, centres.count, after)
        if shift <= tolerance:
            break
    return centres


def hierarchical_themes(
    df: DataFrame, id_col: str, features: str, top_k: int = 5, sub_k: int = 4, min_sub: int = 50, seed: int = 42,
    top: str | None = None,
) -> DataFrame:
    """Two levels: (id, theme_top, theme_sub_local, theme_sub_id).

    ``top`` names a column of whole numbers that gives the first level; without it ``top_k`` themes are fitted.
    A top theme of n rows is split into min(sub_k, max(1, n // min_sub)) parts. The second level
    of all themes is fitted together, one pass per iteration for any number of themes.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    given = [F.col(top).cast("int").alias("theme_top")] if top else []
    points = df.select(F.col(id_col).alias("_id"), _as_vector(df, features).alias("_v"), *given)
    if top:
        assigned = points.filter(F.col("theme_top").isNotNull())
    else:
        points = points.persist(StorageLevel.MEMORY_AND_DISK)
        assigned = KMeans(k=top_k, seed=seed, featuresCol="_v", predictionCol="theme_top").fit(points).transform(points)
    assigned, path = write_stage(assigned.select("_id", "theme_top", "_v"), "themed")
    points.unpersist()
    parts = lambda n: F.least(F.lit(sub_k), F.greatest(F.lit(1), F.floor(n / min_sub)))
    rows = sorted(_starts(assigned, parts, seed).toLocalIterator(), key=lambda r: (r["theme_top"], r["part"]))
    themes, count = np.unique(np.array([r["theme_top"] for r in rows], "int64"), return_counts=True)
    width = len(rows[0]["x"]) if rows else 0
    centres = grouped_kmeans(assigned, _Centres(themes, count, np.array([r["x"] for r in rows]).reshape(len(rows), width)))
    held = spark.sparkContext.broadcast(centres)

    @F.arrow_udf(T.IntegerType())
    def local(theme: pa.Array, vectors: pa.Array) -> pa.Array:
        own = held.value
        theme = theme.to_numpy(zero_copy_only=False)
        place = own.nearest(theme, VectorBatch(vectors))
        return pa.array((place - own.first[np.searchsorted(own.themes, theme)]).astype("int32"))

    themed = assigned.select(F.col("_id").alias(id_col), "theme_top", local("theme_top", "_v").alias("theme_sub_local"))
    sub_id = F.concat_ws(".", F.col("theme_top").cast("string"), F.col("theme_sub_local").cast("string"))
    found = themed.withColumn("theme_sub_id", sub_id).checkpoint()
    drop_stage(spark, path)
    return found


def sub_theme_counts(themes: DataFrame) -> DataFrame:
    return (
        themes.groupBy("theme_top", "theme_sub_local")
        .agg(F.count(F.lit(1)).alias("tickets"))
        .orderBy("theme_top", F.desc("tickets"), "theme_sub_local")
    )


def cluster_counts(df: DataFrame, cluster: str) -> DataFrame:
    counted = df.filter(F.col(cluster).isNotNull()).groupBy(F.col(cluster).alias("theme"))
    return counted.agg(F.count(F.lit(1)).alias("tickets")).orderBy("theme")


def centroids(df: DataFrame, cluster: str, vec: str) -> DataFrame:
    """(theme, centre): mean member vector, combined map-side into one running mean per theme."""
    return (
        df.filter(F.col(cluster).isNotNull())
        .groupBy(F.col(cluster).alias("theme"))
        .agg(Summarizer.mean(_as_vector(df, vec)).alias("_m"))
        .select("theme", vector_to_array("_m").alias("centre"))
    )


def assign_nearest(
    df: DataFrame, id_col: str, vec: str, centres: DataFrame, metric: str = "euclidean", out: str = "theme"
) -> DataFrame:
    """(id, theme, distance) of the closest centre, of any number of centres; ties go to the smaller theme.

    The centres come in blocks of ``BLOCK_BYTES`` in order of their length. A row keeps its best centre so far while it passes
    the blocks one after the other, each a matrix product per Arrow batch; by the triangle inequality rows whose own length is further from a block's
    lengths than their best distance skip it. Up to ``CHAIN`` blocks are passed in one job without a shuffle; then the narrow state is
    written. The driver holds one block at a time.
    """
    kind = centres.schema["theme"].dataType
    state = T.StructType([T.StructField("theme", kind), T.StructField("distance", T.DoubleType())])
    values = _as_array(centres, "centre")
    lengths = F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    ordered = centres.select("theme", values.alias("centre"), lengths.alias("_length")).orderBy("_length", "theme")
    staged = df.filter(F.col(vec).isNotNull()).select(F.col(id_col).alias("_id"), _as_array(df, vec).alias("_v"))
    staged = staged.withColumn("_best", F.lit(None).cast(state))
    passed, path = 0, None

    def through(names: np.ndarray, matrix: np.ndarray) -> Callable[[Column, Column], Column]:
        block = df.sparkSession.sparkContext.broadcast((names, matrix))

        @F.pandas_udf(state)
        def nearest(vectors: pd.Series, best: pd.DataFrame) -> pd.DataFrame:
            names, matrix = block.value
            return _closer(np.stack(vectors.to_numpy()).astype("float64"), best, names, matrix, metric)

        return nearest

    for rows in _blocks(ordered.toLocalIterator()):
        rows.sort(key=lambda r: r["theme"])
        if passed and passed % CHAIN == 0:
            (staged, written), previous = write_stage(staged, "nearest"), path
            if previous:
                drop_stage(df.sparkSession, previous)
            path = written
        use = through(np.array([r["theme"] for r in rows]), np.array([r["centre"] for r in rows], "float64"))
        staged = staged.withColumn("_best", use("_v", "_best"))
        passed += 1
    return staged.select(F.col("_id").alias(id_col), F.col("_best.theme").alias(out), F.col("_best.distance").alias("distance"))


def _blocks(rows: Iterator) -> Iterator[list]:
    """Lists of centres of at most ``BLOCK_BYTES`` (of one centre at least)."""
    block: list = []
    for r in rows:
        block.append(r)
        if 8 * len(block) * len(r["centre"]) >= BLOCK_BYTES:
            yield block
            block = []
    if block:
        yield block


def _closer(x: np.ndarray, best: pd.DataFrame, names: np.ndarray, matrix: np.ndarray, metric: str) -> pd.DataFrame:
    """The better of ``best`` and the nearest row of ``matrix`` for each row of ``x``; equal distances go to the smaller name."""
    theme, distance = best["theme"].to_numpy(dtype=object), best["distance"].to_numpy(dtype="float64")
    distance = np.where(np.isnan(distance), np.inf, distance)
    lengths, own = np.linalg.norm(matrix, axis=1), np.linalg.norm(x, axis=1)
    rows = np.arange(len(x))
    if metric != "cosine":
        gap = np.maximum(np.maximum(lengths.min() - own, own - lengths.max()), 0.0)
        rows = np.flatnonzero(gap <= distance * (1 + 1e-9) + 1e-9)
    for start in range(0, len(rows), max(1, CELLS // len(names))):
        at = rows[start : start + max(1, CELLS // len(names))]
        if metric == "cosine":
            norms = np.outer(own[at], lengths)
            found = 1.0 - np.divide(x[at] @ matrix.T, norms, out=np.zeros_like(norms), where=norms > 0)
        else:
            square = (own[at] ** 2)[:, None] - 2.0 * (x[at] @ matrix.T) + (lengths**2)[None, :]
            found = np.sqrt(np.maximum(square, 0.0))
        place = found.argmin(axis=1)
        least = found[np.arange(len(at)), place]
        tied = least == distance[at]
        better = (least < distance[at]) | (tied & np.array([t is None or n < t for n, t in zip(names[place], theme[at], strict=True)], bool))
        theme[at[better]], distance[at[better]] = names[place[better]], least[better]
    return pd.DataFrame({"theme": theme, "distance": distance})


def representatives(
    df: DataFrame, id_col: str, cluster: str, vec: str, n: int, keep: Sequence[str] = (),
    centres: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` rows of each theme closest to its centre by cosine distance, with their rank.

    ``row_number() <= n`` is pruned inside every map task before the shuffle, so a theme
    holding most rows sends only n rows per task. Wide columns join the winners afterwards.
    """
    centres = centroids(df, cluster, vec) if centres is None else centres
    base = df.filter(F.col(cluster).isNotNull() & F.col(vec).isNotNull())
    points = base.select(id_col, F.col(cluster).alias("theme"), _as_array(df, vec).alias("_v"))
    measured = lookup_join(points, centres.select("theme", "centre"), ["theme"], [id_col], "inner", LOCAL_CENTRES)
    scored = measured.select(id_col, "theme", cosine_distance("_v", "centre").alias("distance"))
    order = W.partitionBy("theme").orderBy("distance", id_col)
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    if not keep:
        return best
    return lookup_join(df.select(id_col, *keep), best, [id_col], [id_col], "inner")


def theme_keywords(vectors: DataFrame, cluster: str, model: TfidfModel, features: str = "features",
                   top_n: int = 10) -> DataFrame:
    """(theme, keywords): terms with the highest mean weight in each theme, joined by ", "."""
    means = (
        vectors.filter(F.col(cluster).isNotNull())
        .groupBy(F.col(cluster).alias("theme"))
        .agg(Summarizer.mean(F.col(features)).alias("_m"))
        .select("theme", F.posexplode(vector_to_array("_m")).alias("idx", "weight"))
        .filter(F.col("weight") > 0)
    )
    named = means.join(F.broadcast(model.terms_table(vectors)), "idx")
    return keywords_from_weights(named, "theme", top_n)


def centre_keywords(centres: DataFrame, model: TfidfModel, top_n: int = 10) -> DataFrame:
    """(theme, keywords) from the centres of TF-IDF themes, which are the mean weights of their members; no text is read."""
    entries = centres.select("theme", F.posexplode("centre").alias("idx", "weight")).filter(F.col("weight") > 0)
    return keywords_from_weights(entries.join(F.broadcast(model.terms_table(centres)), "idx"), "theme", top_n)


def keywords_from_weights(weights: DataFrame, theme: str, top_n: int) -> DataFrame:
    """Top terms per theme from (theme, term, weight); ties in term order."""
    order = W.partitionBy(theme).orderBy(F.desc(F.round("weight", 9)), "term")
    best = weights.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top_n)
    listed = best.groupBy(theme).agg(F.sort_array(F.collect_list(F.struct("_rank", "term"))).alias("_l"))
    return listed.select(theme, F.concat_ws(", ", F.transform("_l", lambda e: e["term"])).alias("keywords"))


def theme_labels(
    df: DataFrame, id_col: str, cluster: str, vec: str, text: str, reps: int = 25, top_k: int = 5,
    min_df: int = 2, max_features: int = 2_000, stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """(theme, label, tickets): keywords of the representatives of each theme, largest theme first."""
    checkpoint_folder(df.sparkSession)
    # A few rows per theme, read several times below.
    best = representatives(df, id_col, cluster, vec, reps, keep=[text]).checkpoint()
    weights = tfidf_per_group(best, "theme", id_col, text, (1, 2), min_df, max_features, stop_words)
    per_theme = best.groupBy("theme").agg(F.count(F.lit(1)).alias("_docs"))
    means = (
        weights.groupBy("theme", "term").agg(F.sum("weight").alias("_s"))
        .join(per_theme, "theme")
        .select("theme", "term", (F.col("_s") / F.col("_docs")).alias("weight"))
    )
    words = keywords_from_weights(means, "theme", top_k).withColumnRenamed("keywords", "label")
    return (
        cluster_counts(df, cluster)
        .join(words, "theme", "left")
        .select("theme", F.coalesce("label", F.lit("")).alias("label"), "tickets")
        .orderBy(F.desc("tickets"), "theme")
    )


def label_requests(
    df: DataFrame, id_col: str, cluster: str, vec: str, text: str, subject: str | None = None, n: int = 12,
    max_chars: int = LABEL_CHARS, parents: DataFrame | None = None, task: str = LABEL_TASK,
) -> DataFrame:
    """(theme, tickets, request): what a labelling step is asked for each theme.

    ``parents`` is an optional (theme, parent_label) table for second-level themes.
    """
    keep = [text] if subject in (None, text) else [subject, text]
    best = representatives(df, id_col, cluster, vec, n, keep=keep)
    head = F.coalesce(F.col(subject).cast("string"), F.lit("")) if subject else F.lit("")
    example = truncate_chars(
        F.concat(F.lit("Subject: "), head, F.lit("\nTicket: "), F.coalesce(F.col(text), F.lit(""))), max_chars
    )
    gathered = (
        best.groupBy("theme")
        .agg(F.sort_array(F.collect_list(F.struct("rank", example.alias("example")))).alias("_l"))
        .select("theme", F.concat_ws("\n", F.transform("_l", lambda e: e["example"])).alias("_examples"))
    )
    sized = cluster_counts(df, cluster).join(gathered, "theme", "left")
    if parents is not None:
        sized = sized.join(parents.select("theme", "parent_label"), "theme", "left")
        parent = F.concat(F.lit("Parent theme: "), F.col("parent_label"))
    else:
        parent = F.lit(None).cast("string")
    request = F.concat_ws("\n", F.lit(task), parent, F.lit("Ticket examples:"), F.col("_examples"))
    return sized.select("theme", "tickets", request.alias("request"))


def label_outcome(label: Column | str, error: Column | str) -> Column:
    """Label returned by a labelling step, or "(error: …)" when it failed."""
    label, error = (F.col(c) if isinstance(c, str) else c for c in (label, error))
    return F.when(error.isNotNull(), F.concat(F.lit("(error: "), error, F.lit(")"))).otherwise(label)


def attach_labels(
    df: DataFrame, labels: DataFrame, key: str | Sequence[str], spread_by: Sequence[str], out: str = "label"
) -> DataFrame:
    """Left join of theme labels; a theme without one shows as "Theme {id}"."""
    keys = [key] if isinstance(key, str) else list(key)
    joined = lookup_join(df, labels.select(*keys, F.col("label").alias("_label")), keys, spread_by, "left")
    shown = F.concat(F.lit("Theme "), F.concat_ws(".", *[F.col(k).cast("string") for k in keys]))
    return joined.withColumn(out, F.coalesce("_label", shown)).drop("_label")
