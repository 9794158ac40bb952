"""Token ids in Parquet, written in document order and read selectively.

A file holds one row per document: the document's place in the file (delta
encoded), its number of ids, and the ids as a list column whose values go
through a dictionary, with delta encoding where a dictionary grows too large.
Row groups and pages are small, and the column and offset indexes that the writer
adds let a reader fetch the ids of a few documents, or the metadata alone. A
second small table, ``index``, has for each file the number of ids before it.

``write`` ranges the texts by id, so that files follow one another in ascending
order of id (null first; rows with the same id by a hash of their text, equal rows
one after the other), and encodes them after that shuffle: texts are narrower
than ids. No task sees more than its range; offsets are counted within a file and
added up over files.

Null and empty texts hold only the end id. An empty table gives an empty store.
Other columns of the input are not stored, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import named

#: Different words whose ids a worker remembers.
MEMORY = 500_000
#: Signs that end a part: of one kind for the tokenizer, and not the apostrophe, which may begin a piece with letters.
SIGNS = ".,;:!?#$%&*|()[]"
#: What the tokenizer writes at the end of a piece's last token, and the words of one call to it.
WORD_END, LINE = "</w>", 2048
#: Letters before this one are composed, and lower-cased one by one.
LATIN_END = "\u0250"
#: Such letters but for the dotted capital I, whose small form has two signs: Arrow and Python lower them alike.
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
#: Bytes of text encoded together.
GROUP_BYTES = 4 << 20
#: Settings of the files: row groups of 32 MB, pages of 256 KB or 2000 rows.
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#place": "false",
    "parquet.enable.dictionary#offset": "false",
}


class WordMemory:
    """Ids of words as packed bytes; asks the tokenizer only for words it hasn't met lately.

    A text's ids are those of its parts between spaces and line feeds, one after
    the other: the tokenizer's pieces never hold white space, and neither lower
    casing nor composing of characters reaches across it. A part of letters followed
    by signs is in turn the letters, then the signs, and letters of the Latin blocks
    may be lower-cased beforehand, so that one word serves all its spellings. Arrow
    splits texts and parts; Python sees each different word of a group once.
    """

    def __init__(self, tokenizer, limit: int = MEMORY):
        self.tokenizer, self.limit = tokenizer, limit
        self.last = np.zeros(tokenizer.get_vocab_size(), bool)
        self.last[[i for token, i in tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True
        self.units: dict[str, bytes] = {"": b""}

    def split(self, part: str) -> tuple[str, str]:
        """The part's letters in lower case and its trailing signs, or the part as it is."""
        if part.isalpha() and part.isascii():
            return part.lower(), ""
        core = part.rstrip(SIGNS)
        plain = core.lower()
        if plain.isalpha() and max(core) < LATIN_END:
            return plain, part[len(core) :]
        return part, ""

    def encoded(self, units: list[str]) -> list[bytes]:
        """Packed ids of units. Units of letters only, or signs only, are one piece each and go to the tokenizer in one line.

        A piece's last token, and no other, ends in the mark of a word's end, which tells
        the pieces of the line apart.
        """
        ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(units)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) == len(units):
            packed, at = ids.tobytes(), (4 * ends).tolist()
            return [packed[a:b] for a, b in zip([0, *at[:-1]], at, strict=True)]
        each = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in each]

    def learned(self, units: list[str]) -> list[bytes]:
        """Packed ids of ``units``, those not met lately from the tokenizer."""
        new = [u for u in dict.fromkeys(units) if u not in self.units]
        if len(self.units) + len(new) > self.limit:
            self.units = {"": b""}
            new = [u for u in dict.fromkeys(units) if u]
        single = [u for u in new if u.isalpha() or not u.strip(SIGNS)]
        others = [u for u in new if not (u.isalpha() or not u.strip(SIGNS))]
        for start in range(0, len(single), LINE):
            some = single[start : start + LINE]
            self.units.update(zip(some, self.encoded(some), strict=True))
        each = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        self.units.update((u, array("I", e.ids).tobytes()) for u, e in zip(others, each, strict=True))
        return list(map(self.units.__getitem__, units))

    def packed(self, texts: list[str]) -> list[bytes]:
        """Packed ids of some texts, whose new words are learned together."""
        words = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        parts = coded.dictionary
        cores = pc.utf8_rtrim(parts, characters=SIGNS)
        plain = pc.match_substring_regex(cores, LETTERS + "$")
        split = [self.split(p) for p in parts.filter(pc.invert(plain)).to_pylist()]
        core, signs = (
            pa.concat_arrays([easy, pa.array(hard, pa.string())]).dictionary_encode()
            for easy, hard in (
                (pc.utf8_lower(cores.filter(plain)), [c for c, _ in split]),
                (pc.replace_substring_regex(parts.filter(plain), LETTERS, ""), [s for _, s in split]),
            )
        )
        found = self.learned([*core.dictionary.to_pylist(), *signs.dictionary.to_pylist()])
        lengths = np.fromiter(map(len, found), "int64", len(found)) // 4
        ids = pa.array(np.frombuffer(b"".join(found), "<u4"))
        ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype("int32"), ids)
        both = np.stack([core.indices.to_numpy(), signs.indices.to_numpy() + len(core.dictionary)], 1)
        easy = plain.to_numpy(zero_copy_only=False)
        place = np.concatenate([np.flatnonzero(easy), np.flatnonzero(~easy)])
        units = np.empty_like(both)
        units[place] = both
        units = units[coded.indices.to_numpy()].ravel()
        ends = np.concatenate([[0], 4 * np.cumsum(lengths[units])])[2 * words.offsets.to_numpy().astype("int64")].tolist()
        raw = ids.take(pa.array(units)).flatten().to_numpy().tobytes()
        return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@lru_cache(maxsize=1)
def _memory(file: str) -> WordMemory:
    """One memory for all tasks of a worker."""
    from tokenizers import Tokenizer

    return WordMemory(Tokenizer.from_file(file))


def groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Start and end of runs of texts of about ``most`` bytes, one text at least."""
    sizes = pc.cumulative_sum(pc.binary_length(texts)).to_numpy() // most
    cuts = (np.flatnonzero(np.diff(sizes)) + 1).tolist()
    yield from zip([0, *cuts], [*cuts, len(texts)], strict=True)


def write(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text: str = "text"
) -> None:
    """Encode ``docs`` and write them as token files and their index under ``path``."""
    spark = docs.sparkSession
    ordered = (
        docs.select(named(id_col).alias("doc_id"), F.coalesce(named(text), F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .select(F.spark_partition_id().alias("file"), "doc_id", "text")
    )
    schema = T.StructType(
        [
            T.StructField("file", T.IntegerType()),
            T.StructField("place", T.LongType()),
            ordered.schema["doc_id"],
            T.StructField("offset", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(tokenizer_file)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        place = offset = 0
        for batch in batches:
            column = batch.column(2)
            for start, stop in groups(column):
                found = [ids + end for ids in memory.packed(column.slice(start, stop - start).to_pylist())]
                n = np.asarray([len(x) // 4 for x in found], dtype="int64")
                ends = np.cumsum(n)
                values = pa.array(np.frombuffer(b"".join(found), "<u4").view("int32"))
                columns = [
                    batch.column(0).slice(start, len(n)),
                    pa.array(np.arange(place, place + len(n), dtype="int64")),
                    batch.column(1).slice(start, len(n)),
                    pa.array(offset + ends - n),
                    pa.array(n),
                    pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype("int32"), values),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                place, offset = place + len(n), offset + int(ends[-1])

    ordered.mapInArrow(run, schema).write.options(**LAYOUT).parquet(f"{path}/tokens")
    files = (
        spark.read.schema(schema)
        .parquet(f"{path}/tokens")
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/index")


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Documents of a store: doc_id, start (ids of all documents before it), n_tokens and, if asked for, ids."""
    columns = ["doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", *["ids"] * ids]
    index = spark.read.parquet(f"{path}/index").select("file", "base")
    return spark.read.parquet(f"{path}/tokens").join(index, "file").select(*columns)


def checksums(store: DataFrame) -> DataFrame:
    """``store`` with n_tokens and ids_crc32 counted from the ids themselves, in place of the ids."""
    others = [f for f in store.schema.fields if f.name not in ("ids", "n_tokens")]
    schema = T.StructType(
        [*others, T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            lists = batch.column(batch.schema.names.index("ids"))
            values = memoryview(lists.values.to_numpy(zero_copy_only=True).astype("<u4", copy=False)).cast("B")
            at = lists.offsets.to_numpy().astype("int64")
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            kept = [batch.column(batch.schema.names.index(f.name)) for f in others]
            counts = pa.array(np.diff(at))
            yield pa.RecordBatch.from_arrays([*kept, counts, pa.array(sums, pa.int64())], names=schema.names)

    return store.mapInArrow(run, schema)
