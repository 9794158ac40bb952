"""Line dedup over overlapping windows of three lines.

Lines are separated by line feeds; a line counts if it holds a word, and is
compared without the white space around it. Each run of three such lines is a
window; a document with one or two has one window of all of them. Windows are
hashed (MD5 of the lines' MD5s), and a window found several times over all
documents keeps its first occurrence, by id (null first), text hash and place.
Every later occurrence covers its lines; covered places of a document are merged
and removed, the other lines stay as they are, blank ones too.

Two narrow shuffles find the occurrences: windows by hash, with a partial minimum
before the shuffle, and back to the rows by hash and salt, so that a window in a third of
all documents is spread over many tasks. Texts are shuffled once, to meet the
covered places of their document, and always in the same way: that table grows with the
input, so the join does not wait for it to outgrow a broadcast.

Null texts stay null and empty ones empty; a text whose lines all go becomes
empty. Rows equal in id and text are one document: they are treated alike, and a
row is not a repeat of its copy (exact copies under other ids are). Columns pass
through whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.llm.common import let, named, private, row_key, same_key, spread_lookup, stored

SIZE = 3
EDGES = " \t\n\v\f\r"


def _counted(lines: Column) -> Column:
    """Places of the lines that hold a word."""
    indexed = F.transform(lines, lambda line, i: F.when(F.btrim(line, F.lit(EDGES)) != "", i))
    return F.array_compact(indexed)


def windows(text: Column, size: int = SIZE) -> Column:
    """Hashes of a text's windows, in order."""

    def of(digests: Column) -> Column:
        n = F.size(digests)
        last = F.greatest(n - F.lit(size), F.lit(0))
        joined = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.unhex(F.md5(F.array_join(F.slice(digests, i + 1, F.lit(size)), "").cast("binary")))
        )
        return F.when(n > 0, joined).otherwise(F.array().cast("array<binary>"))

    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.btrim(line, F.lit(EDGES)))
    digests = F.transform(F.array_remove(trimmed, ""), lambda line: F.md5(line.cast("binary")))
    return let(digests, of)


def without_lines(text: Column, covered: Column, size: int = SIZE) -> Column:
    """The text without the lines in the windows at ``covered`` (places among the counted lines)."""

    def rest(lines: Column) -> Column:
        def kept(places: Column) -> Column:
            reach = F.flatten(F.transform(covered, lambda w: F.sequence(w, F.least(w + F.lit(size - 1), F.size(places) - 1))))
            gone = F.transform(F.array_distinct(reach), lambda j: F.get(places, j))
            every = F.sequence(F.lit(0), F.size(lines) - 1)
            return F.transform(F.array_except(every, gone), lambda i: F.get(lines, i))

        return F.array_join(let(_counted(lines), kept), "\n")

    return let(F.split(text, "\n"), rest)


def later_windows(docs: DataFrame, id_col: str, text: str, size: int = SIZE) -> DataFrame:
    """(id, hash, covered): of each document with repeats, the places of windows seen before."""
    names = ["id", "hash"]
    rows = docs.select(*row_key(id_col, text, names), windows(named(text), size).alias("w"))
    filed = rows.select(*names, F.posexplode("w").alias("at", "w"))
    place = F.struct("id", "hash", "at")
    repeated = (
        filed.groupBy("w").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).filter(F.col("times") > 1)
    )
    met = spread_lookup(filed.withColumn("spot", F.xxhash64("id", "hash")), repeated, "w", "spot", salts=32)
    later = met.filter(F.col("first").isNotNull() & ~place.eqNullSafe(F.struct("first.id", "first.hash", "first.at")))
    return later.groupBy(*names).agg(F.collect_set("at").alias("covered"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE, removed: str | None = None) -> DataFrame:
    """``docs`` with the lines of later occurrences removed from ``text``.

    ``removed`` names a column that gets the number of lines taken away.
    """
    names = private(docs, "id", "hash")
    (cover,) = private(docs, "covered")
    found = stored(later_windows(docs, id_col, text, size), "covered")
    found = found.select(F.col("id").alias(names[0]), F.col("hash").alias(names[1]), F.col("covered").alias(cover)).hint("merge")
    full = docs.withColumns(dict(zip(names, row_key(id_col, text, names), strict=True)))
    joined = full.join(found, same_key(full, found, names), "left").select(*[full[f"`{c}`"] for c in full.columns], found[cover])
    shorter = F.when(F.col(cover).isNull(), named(text)).otherwise(without_lines(named(text), F.col(cover), size))
    if removed is None:
        return joined.withColumn(text, shorter).drop(*names, cover)
    total = F.size(_counted(F.split(named(text), "\n")))
    gone = F.when(F.col(cover).isNull(), F.lit(0)).otherwise(total - F.size(_counted(F.split(shorter, "\n"))))
    return joined.withColumns({removed: gone.cast("long"), text: shorter}).drop(*names, cover)
