"""Embeddings: a pluggable batch encoder, an offline encoder, and payload normalisation."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.clean import as_column, truncate_chars
from caseworks.functions.text import tokens
from caseworks.functions.vectors import l2_normalize

#: No text is longer: the most characters a string holds.
WHOLE = (1 << 31) - 1

# The keys an embedding payload may use, in order of preference.
PAYLOAD_KEYS = ("float", "embedding", "embeddings", "int8", "uint8", "binary", "ubinary")


def retried(call: Callable[[], Sequence], pauses: Sequence[float]) -> Sequence:
    """``call()``, tried anew after each of ``pauses`` (seconds) until it succeeds; the last failure is the cause of the error."""
    try:
        return call()
    except Exception as error:
        if not pauses:
            raise RuntimeError("no usable answer") from error
    time.sleep(pauses[0])
    return retried(call, pauses[1:])


def encode_with_retry(
    encode: Callable[[list[str]], Sequence], texts: list[str], retries: int, backoff: float
) -> Sequence:
    """One item per text from ``encode``, asked up to ``retries`` times with pauses that grow by the factor ``backoff``."""

    def answer() -> Sequence:
        found = encode(texts)
        if len(found) == len(texts):
            return found
        raise ValueError(f"{len(texts)} texts, {len(found)} embeddings")

    return retried(answer, [backoff**k for k in range(1, retries)])


def embed(
    df: DataFrame, id_col: str, text: str, encode: Callable[[list[str]], Sequence], batch_size: int = 48,
    max_chars: int | None = None, retries: int = 5, backoff: float = 2.0,
) -> DataFrame:
    """(id, embedding) from a caller-supplied batch encoder.

    Texts are flattened, cut to ``max_chars`` if given (``clean.EMBED_CHARS`` suits hosted encoders), and encoded ``batch_size`` at a time. A vector
    that is not numeric is asked for once more alone; if that fails too, the job fails.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def vector(item) -> np.ndarray:
        return np.asarray(item, dtype=np.float32)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["_text"].tolist()
            vectors = []
            for start in range(0, len(texts), batch_size):
                chunk = texts[start : start + batch_size]
                for one, item in zip(chunk, encode_with_retry(encode, chunk, retries, backoff)):
                    try:
                        vectors.append(vector(item))
                    except (TypeError, ValueError):
                        vectors.append(vector(encode_with_retry(encode, [one], retries, backoff)[0]))
            yield pd.DataFrame({id_col: frame[id_col], "embedding": [v.tolist() for v in vectors]})

    ready = df.select(id_col, truncate_chars(text, max_chars or WHOLE).alias("_text"))
    return ready.mapInPandas(run, f"{id_col} {kind}, embedding array<float>")


def embed_hashed(df: DataFrame, id_col: str, text: str, dim: int = 64) -> DataFrame:
    """(id, embedding) without a model: signed word hashing to ``dim`` numbers, unit length, no shuffle.

    Words are counted in twice as many buckets; the second half is subtracted from the
    first, so a word adds +1 or -1 to one of ``dim`` places.
    """
    words = df.select(id_col, tokens(text).alias("_words"))
    counts = HashingTF(numFeatures=2 * dim, inputCol="_words", outputCol="_v").transform(words)
    both = counts.select(id_col, vector_to_array("_v").alias("_a"))
    signed = both.select(
        id_col,
        F.zip_with(F.slice("_a", 1, dim), F.slice("_a", dim + 1, dim), lambda x, y: x - y).alias("_s"),
    )
    return signed.select(id_col, l2_normalize("_s").cast("array<float>").alias("embedding"))


def parse_embeddings(payload: Column | str) -> Column:
    """Array of vectors from an ``embeddings`` payload in any of its three shapes; NULL if unusable.

    Shapes: [[…], …], {"float": [[…], …]} (first known key), [{"embedding": […]}, …].
    Elements given as text make the payload unusable.
    """
    raw = as_column(payload)
    matrix = "array<array<double>>"

    def numbers(json: Column) -> Column:
        # The parser turns quoted numbers into doubles too, so text elements are refused by type.
        shape = F.schema_of_variant(F.try_parse_json(json))
        return F.when(shape.rlike(r"^ARRAY<ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))>>$"), F.from_json(json, matrix))

    def at(path: str) -> Column:
        return F.get_json_object(raw, path)

    body = at("$.embeddings")
    by_type = F.coalesce(*[F.get_json_object(body, f"$.{k}") for k in PAYLOAD_KEYS])
    listed = F.to_json(F.transform(F.from_json(body, "array<struct<embedding:string>>"), lambda e: e["embedding"]))
    unquoted = F.regexp_replace(F.regexp_replace(listed, r'"\[', "["), r'\]"', "]")
    return F.coalesce(numbers(body), numbers(by_type), numbers(unquoted))


def split_payloads(df: DataFrame, payload: str) -> tuple[DataFrame, DataFrame]:
    """(rows with ``vectors``, rejected rows)."""
    parsed = df.withColumn("vectors", parse_embeddings(payload))
    return parsed.filter(F.col("vectors").isNotNull()), parsed.filter(F.col("vectors").isNull()).drop("vectors")
