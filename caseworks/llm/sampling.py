"""Bounded samples of labelled documents, for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.llm.common import named


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents outside the held-out fold, chosen by a hash of the id.

    A document labelled several times has its largest label; null ids and labels
    are left out. Only ``rows`` ids and labels are broadcast.
    """
    known = (
        labels.select(named(id_col).alias("doc_id"), named(label).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & (fold_of(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(named(id_col).alias("doc_id"), named(text).alias("text"))
    return texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "y")
