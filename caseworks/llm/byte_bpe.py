"""Byte-level BPE: texts to token ids and back to bytes.

The ranks come from a local file that every worker loads once. Texts beyond
``LONG`` characters are cut where no match of the pattern can reach across: in
front of a blank or line feed that follows a character which is no white space.
Every match of the pattern is either white space only or at most one space
followed by other characters, and looks ahead by one character only after white
space, so pieces cut there have the same matches as the whole. White space of
``GAP_LIMIT`` characters and more would exhaust the regex engine's stack; such a
run is one match without its last character (all of it at the end of a text) and
is encoded as one piece.

Null and empty texts have no ids and decode to no bytes. Rows are independent:
order, ties and repeated rows play no part. A column with the name of an output
is replaced; all others pass through.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from caseworks.llm.common import map_batches, with_field

LONG = 1 << 16
GAP_LIMIT = 4096
#: Characters that the pattern's \s matches: those with the Unicode property White_Space.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = re.compile(r"(?<=\S)(?=[ \n])")
WIDE_GAP = re.compile(f"[{SPACES}]{{{GAP_LIMIT},}}")
#: Bytes of ids after which a batch is handed on.
BATCH_BYTES = 16 << 20


@lru_cache(maxsize=2)
def _encodings(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    own = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return own, Whole(ranks)


class Whole:
    """An encoding whose only piece is the whole text; few texts need it, so a worker builds it at the first of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.made = ranks, None

    def encode_ordinary(self, text: str) -> list[int]:
        import tiktoken

        if self.made is None:
            self.made = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})
        return self.made.encode_ordinary(text)


def pieces(text: str, limit: int = LONG) -> Iterator[str]:
    """The text in pieces of at least ``limit`` characters, cut at safe boundaries only."""
    start = 0
    while len(text) - start > limit:
        cut = CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def text_ids(text: str, own, whole) -> list[int]:
    """Ids of one text."""
    if len(text) < GAP_LIMIT:
        return own.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text):
        done = 0
        for gap in WIDE_GAP.finditer(piece):
            end = gap.end() if gap.end() == len(piece) else gap.end() - 1
            ids += own.encode_ordinary(piece[done : gap.start()])
            ids += whole.encode_ordinary(piece[gap.start() : end])
            done = end
        ids += own.encode_ordinary(piece[done:])
    return ids


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array, start: int, stop: int) -> pa.RecordBatch:
    kept = [f for f in batch.schema.names if f.lower() != name.lower()]
    columns = [batch.column(batch.schema.names.index(n)).slice(start, stop - start) for n in kept]
    return pa.RecordBatch.from_arrays([*columns, values], names=[*kept, name])


def encode(
    docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids", packed: bool = False
) -> DataFrame:
    """``docs`` with the ids of each text: an array of int, or if ``packed`` little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        own, whole = _encodings(rank_file, pattern)
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            start, size, found = 0, 0, []
            for row in range(batch.num_rows):
                found.append(np.asarray(text_ids(column[row].as_py() or "", own, whole), dtype="<u4"))
                size += found[-1].nbytes
                if size >= BATCH_BYTES or row + 1 == batch.num_rows:
                    if packed:
                        values = pa.array([x.tobytes() for x in found], pa.binary())
                    else:
                        offsets = np.cumsum([0, *map(len, found)]).astype("int32")
                        values = pa.ListArray.from_arrays(offsets, np.concatenate(found).astype("int32"))
                    yield _replaced(batch, ids, values, start, row + 1)
                    start, size, found = row + 1, 0, []

    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    return map_batches(docs, run, with_field(docs.schema, ids, kind))


def decode(docs: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the raw bytes of each row's ids (array of int, or packed binary); no ids or null give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        own, _ = _encodings(rank_file, pattern)
        for batch in batches:
            column = batch.column(batch.schema.names.index(ids))
            start, size, found = 0, 0, []
            for row in range(batch.num_rows):
                value = column[row].as_py() or []
                value = np.frombuffer(value, "<u4").tolist() if isinstance(value, bytes) else value
                found.append(own.decode_bytes(value))
                size += len(found[-1])
                if size >= BATCH_BYTES or row + 1 == batch.num_rows:
                    yield _replaced(batch, out, pa.array(found, pa.binary()), start, row + 1)
                    start, size, found = row + 1, 0, []

    return map_batches(docs, run, with_field(docs.schema, out, T.BinaryType()))
