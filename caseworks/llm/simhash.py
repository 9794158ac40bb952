"""SimHash near-duplicates through deletion-variant signatures.

A text's fingerprint has a bit set where over half of its shingles' XXH64 hashes
have it set. Two fingerprints link if they differ in at most ``max_bits`` (0 to 2)
bits.

**Index.** The 64 bits are cut into two segments of 32. If two fingerprints differ
in at most two bits, one segment differs in at most one. Each different
fingerprint is therefore filed, for either segment, under the segment itself and
under its 32 variants with one bit wiped out. Two fingerprints whose segment is
equal share the first, two whose segment differs in one bit share the variant
without that bit, holding different values of it. Equality joins on these keys give
the candidates, which are verified on all 64 bits.

**Full buckets.** A bucket with more than ``bucket`` fingerprints is not paired.
Its fingerprints are filed under the 65 values that differ from them in at most
one bit. Two fingerprints share such a value exactly if they differ in at most two
bits, and as fingerprints are different, at most 65 share one. So no link is lost
and no bucket gives pairs in the square of its size.

Copies never meet in pairs: everything works on different fingerprints, and rows
are joined to the class of their fingerprint at the end, a hot fingerprint spread
over many tasks.

Null and empty texts, and texts without a word, have fingerprint zero and link
like any other. Rows with a null id take part in links; the smallest id passes
over null, and a component of null ids only has component_id null. Rows repeated
with the same id give repeated rows. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import by_shuffle, map_batches, named, private, row_key, same_key, spread_lookup, stored, with_field
from caseworks.llm.links import components

SEED = 42
SEGMENT = 32
BUCKET = 64
#: Filed signatures of one task.
FILED = 1 << 20
#: Hashes counted at a time; a longer text is counted in several parts.
PART = 1 << 15


def shingle_hashes(text: str, shingle: int = 3):
    """Hashes of the shingles of one text in their order, as an array of unsigned integers; a shorter text is one shingle."""
    import numpy as np
    import xxhash

    parts = text.encode("utf-8").lower().split()  # bytes: only A-Z change, only the six ASCII gaps split
    if not parts:
        return np.empty(0, "uint64")
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), "int64", len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(parts))
    n = len(parts) - k + 1
    spans = zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)
    hash_of = xxhash.xxh64_intdigest
    return np.fromiter((hash_of(line[a:b], SEED) for a, b in spans), "uint64", n)


def text_fingerprint(text: str, shingle: int = 3) -> int:
    """Fingerprint of one text as an unsigned integer."""
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprint_of(hashes) -> int:
    """Fingerprint of a text with these shingle hashes; zero without any."""
    import numpy as np

    n = len(hashes)
    ones = np.zeros(64, "int64")
    for at in range(0, n, PART):
        block = hashes[at : at + PART].view("uint8").reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype="int32")
    return int(np.packbits(2 * ones > n, bitorder="little").view("uint64")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """``docs`` without its text and with its fingerprint as a (signed) long in ``out``."""
    kept = [f.name for f in docs.schema.fields if f.name not in (text, out)]
    schema = with_field(docs.select(*map(named, kept)).schema, out, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index(text))
            values = np.fromiter(
                (text_fingerprint(texts[i].as_py() or "", shingle) for i in range(batch.num_rows)), "uint64", batch.num_rows
            )
            columns = [batch.column(names.index(n)) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values.view("int64"))], names=schema.names)

    return map_batches(docs, run, schema)


def bits_apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _signatures(different: DataFrame) -> DataFrame:
    """(key, bit, fp): each fingerprint under its two segments (bit null) and their one-wildcard variants (bit 0 or 1)."""
    fp = F.col("fp")
    entries = []
    for place in (0, 1):
        segment = F.shiftrightunsigned(fp, place * SEGMENT).bitwiseAND(F.lit((1 << SEGMENT) - 1))
        tag = place << 40
        entries.append(F.struct(segment.bitwiseOR(F.lit(tag)).alias("key"), F.lit(None).cast("tinyint").alias("bit")))
        for p in range(SEGMENT):
            masked = segment.bitwiseAND(F.lit(((1 << SEGMENT) - 1) ^ (1 << p)))
            bit = F.shiftright(segment, p).bitwiseAND(F.lit(1)).cast("tinyint")
            entries.append(F.struct(masked.bitwiseOR(F.lit(tag | (p + 1) << 33)).alias("key"), bit.alias("bit")))
    return different.select(F.inline(F.array(*entries)), "fp")


def fingerprint_links(different: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between the different fingerprints ``fp``, enough to connect all that are within ``max_bits`` bits.

    Fingerprints of buckets up to ``bucket`` are linked pair by pair, those of
    fuller buckets through the smallest one of each value one bit around them.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    if max_bits == 0:
        return different.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    # A few bytes a row in the file, but 66 rows each once filed: dealt out by what they become.
    tasks = -(-66 * different.count() // FILED)
    filed = _signatures(different.repartition(tasks, "fp") if tasks > 1 else different)
    sizes = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    met = stored(spread_lookup(filed, sizes, "key", "fp").filter(F.col("n").isNotNull()), "buckets")
    pairs = met.filter(F.col("n") <= bucket).select("key", "bit", "fp")
    left, right = pairs.alias("l"), by_shuffle(pairs.alias("r"))
    near = left.join(
        right,
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.fp") < F.col("r.fp"))
        & (F.col("l.bit").isNull() | (F.col("l.bit") != F.col("r.bit")))
        & (bits_apart(F.col("l.fp"), F.col("r.fp")) <= max_bits),
    ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    full = met.filter(F.col("n") > bucket).select("fp").distinct()
    around = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << p if p < 63 else -(1 << 63))) for p in range(64)]]
    values = full.select("fp", F.explode(F.array(*around)).alias("value"))
    if max_bits == 1:  # two that differ in one bit: one of them is the value itself
        own = full.select(F.col("fp").alias("value"), F.col("fp").alias("a"))
        ring = values.join(by_shuffle(own), "value").select("a", F.col("fp").alias("b"))
    else:
        first = values.groupBy("value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        ring = values.join(by_shuffle(first), "value").select("a", F.col("fp").alias("b"))
    return near.union(ring).filter(F.col("a") != F.col("b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2, bucket: int = BUCKET
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    rows = stored(
        fingerprints(docs.select(named(id_col).alias("doc_id"), named(text).alias("text")), "text", "fp", shingle),
        "fingerprints",
    )
    smallest = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "different")
    roots = components(fingerprint_links(smallest.select("fp"), max_bits, bucket))
    of = smallest.join(by_shuffle(roots), smallest["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = spread_lookup(of.select("fp", "root"), least, "root", "fp").select("fp", "component_id")
    return spread_lookup(rows, classes, "fp", "doc_id").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null last; then a hash of the text).

    Of rows equal in id and text one stays.
    """
    key_id, key_text = private(docs, "id", "hash")
    keyed = docs.select(*row_key(id_col, text, [key_id, key_text]), named(text).alias("text"))
    rows = stored(fingerprints(keyed, "text", "fp", how.get("shingle", 3)), "fingerprints")
    key = F.struct(F.col(key_id).isNull().alias("none"), F.col(key_id).alias("id"), F.col(key_text).alias("hash"))
    first = stored(rows.groupBy("fp").agg(F.min(key).alias("first")), "different")
    links = fingerprint_links(first.select("fp"), how.get("max_bits", 2), how.get("bucket", BUCKET))
    return keep_first(docs, first, links, id_col, text)


def keep_first(docs: DataFrame, first: DataFrame, links: DataFrame, id_col: str, text: str) -> DataFrame:
    """``docs`` with the first row of each component of ``links``; ``first`` has the first row (none, id, hash) of each node ``fp``."""
    names = key_id, key_text = private(docs, "id", "hash")
    roots = components(links)
    of = first.join(by_shuffle(roots), first["fp"] == roots["node"], "left").select("first", F.coalesce("root", "fp").alias("root"))
    winners = of.groupBy("root").agg(F.min("first").alias("first"))
    chosen = winners.select(F.col("first.id").alias(key_id), F.col("first.hash").alias(key_text))
    full = docs.withColumns(dict(zip(names, row_key(id_col, text, names), strict=True)))
    kept = full.join(by_shuffle(chosen), same_key(full, chosen, names), "left_semi")
    return kept.dropDuplicates(names).drop(*names)
