"""TF-IDF with unigrams and bigrams, a minimum document frequency and a capped vocabulary.

Two passes, and the texts are never shuffled: the first counts terms (map-side
combined, one row per distinct term leaves a task) and keeps the ``max_features``
most frequent ones; the second turns each text into a sparse vector in place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from caseworks.functions.text import STOP_WORDS, with_terms
from caseworks.plans.bounded import lookup_join
from caseworks.plans.stages import write_stage
from caseworks.plans.topk import contenders

MAX_VOCABULARY = 262_144
#: Terms counted at a time.
SLICE_TERMS = 1 << 21
#: Rows and bytes of text of a vocabulary that tasks hold whole, and characters of text that a task counts terms of.
HELD_TERMS, HELD_BYTES, TASK_CHARS = 4_000_000, 64 << 20, 4_000_000


@dataclass(frozen=True)
class TfidfModel:
    """Vocabulary in term order with its idf weights; at most ``MAX_VOCABULARY`` entries."""

    vocabulary: tuple[str, ...]
    idf: tuple[float, ...]
    ngram_range: tuple[int, int]
    stop_words: tuple[str, ...]

    def transform(self, df: DataFrame, text: str, out: str = "features") -> DataFrame:
        """Add the L2-normalised TF-IDF vector; no shuffle."""
        if not self.vocabulary:
            raise ValueError("empty vocabulary: no term reaches the minimum document frequency")
        counted = with_terms(df, text, "_terms", self.ngram_range, self.stop_words)
        counts = CountVectorizerModel.from_vocabulary(list(self.vocabulary), inputCol="_terms", outputCol="_tf")
        weight = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_w")
        unit = Normalizer(p=2.0, inputCol="_w", outputCol=out)
        return unit.transform(weight.transform(counts.transform(counted))).drop("_terms", "_tf", "_w")

    def terms_table(self, df: DataFrame) -> DataFrame:
        """(idx, term) for joining vector positions back to words."""
        rows = pd.DataFrame({"idx": np.arange(len(self.vocabulary), dtype=np.int32), "term": self.vocabulary})
        return df.sparkSession.createDataFrame(rows, "idx int, term string")


def term_counts(terms: pa.ListArray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(term, occurrences, texts) of the different terms of texts, for so many texts at a time as have ``SLICE_TERMS`` terms (of one text at least)."""
    ends = np.cumsum(terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("int64"))
    start = 0
    while start < len(terms):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_TERMS, side="right")))
        own = terms.slice(start, stop - start)
        coded = own.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype("int64")
        size = len(coded.dictionary)
        text = np.repeat(np.arange(stop - start), np.diff(ends[start:stop], prepend=before))
        both = np.sort(text * size + code)
        once = both[np.flatnonzero(np.diff(both, prepend=-1))] % max(size, 1)
        yield coded.dictionary, np.bincount(code, minlength=size), np.bincount(once, minlength=size)
        start = stop


def term_statistics(df: DataFrame, text: str, ngram_range=(1, 2), stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(term, tf, df) over the corpus in a single shuffle keyed by term.

    Terms are counted by Arrow batches in the task that reads the texts, so a row is a different term of a batch
    and no (document, term) pairs are made to count document frequencies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for term, tf, texts in term_counts(batch.column(0)):
                yield pa.RecordBatch.from_arrays([term, pa.array(tf, pa.int64()), pa.array(texts, pa.int64())], names=["term", "tf", "df"])

    counted = with_terms(df.select(text), text, "_t", ngram_range, stop_words).select("_t").mapInArrow(run, "term string, tf long, df long")
    return counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def fit_tfidf(
    df: DataFrame, text: str, ngram_range: tuple[int, int] = (1, 2), min_df: int = 3,
    max_features: int = 20_000, stop_words: Sequence[str] = STOP_WORDS,
) -> TfidfModel:
    """Vocabulary: terms in at least ``min_df`` texts, the most frequent first, ties in term order.

    idf = ln((1+N)/(1+df)) + 1.
    """
    if max_features > MAX_VOCABULARY:
        raise ValueError(f"max_features may be at most {MAX_VOCABULARY}")
    stats = term_statistics(df, text, ngram_range, stop_words)
    kept = contenders(stats.filter(F.col("df") >= min_df), "tf", max_features)
    kept = kept.orderBy(F.desc("tf"), "term").limit(max_features)
    n = df.count()
    idf = F.log((1.0 + F.lit(n)) / (1.0 + F.col("df"))) + 1.0
    rows = sorted(kept.select("term", idf.alias("idf")).collect())
    return TfidfModel(
        tuple(r["term"] for r in rows), tuple(r["idf"] for r in rows), tuple(ngram_range), tuple(stop_words)
    )


def vector_entries(vec: Column | str) -> Column:
    """Array of (idx, w) for the non-zero entries of a sparse or dense vector column."""
    parts = F.unwrap_udt(vec)
    sparse = F.arrays_zip(parts["indices"].alias("idx"), parts["values"].alias("w"))
    dense = F.transform(parts["values"], lambda w, i: F.struct(i.alias("idx"), w.alias("w")))
    return F.when(parts["type"] == 0, sparse).otherwise(dense)


def tfidf(
    df: DataFrame, id_col: str, text: str, ngram_range: tuple[int, int] = (1, 2), min_df: int = 3,
    max_features: int = 20_000, stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Long form: (id, term, weight) for the non-zero weights."""
    model = fit_tfidf(df, text, ngram_range, min_df, max_features, stop_words)
    vectors = model.transform(df.select(id_col, text), text)
    entries = vectors.select(id_col, F.inline(vector_entries("features")))
    # The vocabulary is capped, hence the broadcast.
    return entries.join(F.broadcast(model.terms_table(df)), "idx").select(id_col, "term", F.col("w").alias("weight"))


def tfidf_vocabulary(
    df: DataFrame, text: str, ngram_range: tuple[int, int] = (1, 2), min_df: int = 3,
    max_features: int = 20_000, stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """(term, idf): the terms of ``fit_tfidf`` as a table, of any number of them; only counts by frequency reach the driver.

    The frequency at which ``max_features`` terms are reached is found from the number of terms of each frequency; only the ties there are sorted.
    """
    stats, _ = write_stage(term_statistics(df, text, ngram_range, stop_words).filter(F.col("df") >= min_df), "terms")
    sizes = stats.groupBy("tf").agg(F.count(F.lit(1)).alias("terms"))
    upto = sizes.withColumn("upto", F.sum("terms").over(W.orderBy(F.desc("tf"))))
    edge = upto.filter(F.col("upto") >= max_features).orderBy(F.desc("tf")).select("tf", F.col("upto") - F.col("terms")).first()
    kept = stats
    if edge:
        ties = stats.filter(F.col("tf") == edge[0]).orderBy("term").limit(max_features - edge[1])
        kept = stats.filter(F.col("tf") > edge[0]).union(ties)
    idf = F.log((1.0 + F.lit(df.count())) / (1.0 + F.col("df"))) + 1.0
    return kept.select("term", idf.alias("idf"))


def tfidf_by_table(
    df: DataFrame, id_col: str, text: str, vocabulary: DataFrame, ngram_range: tuple[int, int] = (1, 2), stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Long form (id, term, weight) by a table (term, idf) of any size.

    The texts are dealt out by id once, and (id, term) counts and lengths are made where they are. A vocabulary of at most ``HELD_TERMS``
    rows and ``HELD_BYTES`` is broadcast; with a larger one the counts meet it by term, frequent terms salted, and go back by id.
    """
    chars = df.agg(F.sum(F.length(text))).first()[0] or 0
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-chars // TASK_CHARS))
    dealt = df.select(id_col, text).repartition(parts, id_col)
    counts = with_terms(dealt, text, "_t", ngram_range, stop_words).select(id_col, F.explode("_t").alias("term"))
    counts = counts.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    size = vocabulary.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes")).first()
    if size["rows"] <= HELD_TERMS and size["bytes"] <= HELD_BYTES:
        met = counts.join(F.broadcast(vocabulary), "term")
    else:
        met = lookup_join(counts, vocabulary, ["term"], [id_col], "inner")
    weighted = met.withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_col)))
    return weighted.select(id_col, "term", (F.col("_w") / norm).alias("weight"))


def tfidf_per_group(
    df: DataFrame, group: str, id_col: str, text: str, ngram_range: tuple[int, int] = (1, 2), min_df: int = 2,
    max_features: int = 2_000, stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """TF-IDF fitted separately inside every group, all groups in one job: (group, id, term, weight).

    Meant for groups of few rows, such as the representatives of each theme.
    """
    counts = (
        with_terms(df.select(group, id_col, text), text, "_t", ngram_range, stop_words)
        .select(group, id_col, F.explode("_t").alias("term"))
        .groupBy(group, id_col, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_docs"))
    best = W.partitionBy(group).orderBy(F.desc("_tf"), "term")
    vocabulary = (
        counts.groupBy(group, "term")
        .agg(F.sum("tf").alias("_tf"), F.count(F.lit(1)).alias("_df"))
        .filter(F.col("_df") >= min_df)
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= max_features)
        .join(sizes, group)
        .select(group, "term", (F.log((1.0 + F.col("_docs")) / (1.0 + F.col("_df"))) + 1.0).alias("_idf"))
    )
    weighted = counts.join(vocabulary, [group, "term"]).withColumn("_w", F.col("tf") * F.col("_idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(group, id_col)))
    return weighted.select(group, id_col, "term", (F.col("_w") / norm).alias("weight"))
