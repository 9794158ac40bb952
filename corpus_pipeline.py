"""From raw documents to token ids: five stages, each working on all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes to the shared folder and reads again for the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.llm import byte_bpe, decontamination, line_dedup, near_copies, quality_gam
from caseworks.llm.common import named, stored
from caseworks.sources.readers import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on their labels outside the held-out fold, doesn't reject."""
    return quality_gam.reject(docs, quality_gam.train(docs, table(spark, sf_dir, "labels")))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; n_chars follows the text."""
    shorter = line_dedup.remove_repeats(docs)
    return shorter.withColumn("n_chars", F.char_length("text").cast("long")).select(*map(named, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles have a Jaccard similarity of 0.8 or more."""
    return near_copies.keep_one(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and whether the ids decode to the text's very bytes."""
    encoded = byte_bpe.encode(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_overlap),
    ("byte_level_bpe", token_ids),
]

#: Fingerprints and BPE are beyond SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
