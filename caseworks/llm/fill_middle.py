"""Fill-in-the-middle: a text's lines are cut into prefix, middle and suffix, and written with the middle last.

Each text is cut into chunks where a rolling hash of the last ``WINDOW`` bytes says so, so equal passages
fall into equal chunks wherever they stand. A worker remembers, for the chunks it saw last, what a chunk
adds to its text: line ends, code points, whether it holds a mark, and the bytes at either end that a mark may
straddle. A chunk found by its hash is compared byte by byte before its summary is used. Adding up the summaries
gives a text's number of lines, and the running sums lead to the chunk, and the place in it, of either cut.

Cuts and form follow from ``sha256(seed:id)`` alone: with h1 to h4 its first four 32-bit words and n the number of lines
(``[^\\n]*\\n|[^\\n]+``), the prefix ends after the smaller of h1 % (n+1) and h2 % (n+1) lines, the middle after the larger; h3 % 100
picks the rate of transformed texts, h4 % 100 the share of ``spm``. Texts that are empty or contain a mark stay ``plain``.

A null text is the empty text; a null id is written as nothing behind the seed. Rows are independent, so repeated
rows give repeated results and an empty table gives none. Columns with the name of an output are replaced, all others
but the text pass through. The memory of a worker is bounded by ``MEMORY`` bytes of chunks whatever the texts;
a text of any length is hashed in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import map_batches, named, with_field

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Bytes that the rolling hash sees, and the bits of it that are zero at a cut (one place in 2 ** CUT_BITS).
WINDOW, CUT_BITS = 32, 10
#: Least and largest size of a chunk; the last of a text may be smaller.
LEAST, MOST = 256, 8192
#: Bytes hashed at a time, bytes of chunks a worker remembers, and bytes of output handed on at a time.
BLOCK, MEMORY, BATCH_BYTES = 1 << 20, 32 << 20, 16 << 20
WEIGHTS = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, "uint32")
COLUMNS = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType())]


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes ending at each place: the byte j places back counts 2**j times its weight, modulo 2**32."""
    h = WEIGHTS[raw]
    reach = 1
    while reach < WINDOW:
        h[reach:] += h[:-reach] << np.uint32(reach)
        reach *= 2
    return h


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a text; none cuts a code point, and the empty text has none."""
    n = len(raw)
    data = np.frombuffer(raw, "uint8")
    starts = (data & 0xC0) != 0x80
    ends: list[int] = []
    last = 0

    def force(until: int) -> int:
        """Cuts of the largest size as long as ``until`` is further away."""
        at = last
        while until - at > MOST:
            cut = at + MOST
            while not starts[cut]:
                cut -= 1
            ends.append(cut)
            at = cut
        return at

    for begin in range(0, n, BLOCK):
        lead = min(begin, WINDOW - 1)
        h = rolling(data[begin - lead : begin + BLOCK])[lead:]
        for place in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + begin + 1).tolist():
            if place < n and place - last >= LEAST and starts[place]:
                last = force(place)
                if place - last >= LEAST:
                    ends.append(place)
                    last = place
    if n:
        force(n)
        ends.append(n)
    return ends


class Summary(NamedTuple):
    """What a chunk adds to its text. ``breaks`` and ``break_chars`` count the bytes and code points up to each line end."""

    content: bytes
    chars: int
    breaks: np.ndarray
    break_chars: np.ndarray
    marked: bool


def summarise(content: bytes) -> Summary:
    data = np.frombuffer(content, "uint8")
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.cumsum((data & 0xC0) != 0x80)
    return Summary(content, int(starts[-1]), breaks, starts[breaks - 1], any(m in content for m in MARKS))


class Memory:
    """Summaries of the chunks seen last: two generations, of which the older goes when the younger is full."""

    def __init__(self, limit: int = MEMORY):
        self.limit, self.held = limit, 0
        self.young: dict[int, Summary] = {}
        self.old: dict[int, Summary] = {}
        self.hits = self.misses = 0

    def summary(self, content: bytes) -> Summary:
        import xxhash

        key = xxhash.xxh3_64_intdigest(content)
        found = self.young.get(key)
        if found is not None and found.content == content:
            self.hits += 1
            return found
        found = self.old.get(key)
        if found is not None and found.content == content:
            self.hits += 1
        else:
            self.misses += 1
            found = summarise(content)
        if self.held >= self.limit // 2:
            self.young, self.old, self.held = {}, self.young, 0
        self.young[key] = found
        self.held += len(content) + 16 * len(found.breaks)
        return found


class Layout:
    """Lines, marks and the places of line ends of one text, from the summaries of its chunks."""

    def __init__(self, raw: bytes, memory: Memory):
        ends = chunk_ends(raw)
        self.parts = [memory.summary(raw[a:b]) for a, b in zip([0, *ends], ends)]
        self.lines_to = np.cumsum([0, *(len(p.breaks) for p in self.parts)])
        self.bytes_to = [0, *ends]
        self.chars_to = np.cumsum([0, *(p.chars for p in self.parts)])
        self.size = len(raw)
        self.chars = int(self.chars_to[-1])
        self.lines = int(self.lines_to[-1]) + (self.size > 0 and not raw.endswith(b"\n"))
        self.marked = any(p.marked for p in self.parts) or self._straddled()

    def _straddled(self) -> bool:
        tail = b""
        for part in self.parts:
            seam = tail + part.content[:2]
            if any(m in seam for m in MARKS):
                return True
            tail = (tail + part.content[-2:])[-2:]
        return False

    def after(self, count: int) -> tuple[int, int]:
        """Bytes and code points of the first ``count`` lines."""
        if count == 0:
            return 0, 0
        if count > self.lines_to[-1]:
            return self.size, self.chars
        at = int(np.searchsorted(self.lines_to, count)) - 1
        part, nth = self.parts[at], count - int(self.lines_to[at]) - 1
        return self.bytes_to[at] + int(part.breaks[nth]), int(self.chars_to[at]) + int(part.break_chars[nth])


def transformed(raw: bytes, doc_id: object, memory: Memory, seed: int, rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    words = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(words[k : k + 8], 16) for k in (0, 8, 16, 24))
    text = Layout(raw, memory)
    n = text.lines
    if not raw or text.marked or h3 % 100 >= rate:
        return n, "plain", None, None, raw
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = text.after(low), text.after(high)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if h4 % 100 < spm:
        form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return n, form, a_chars, b_chars - a_chars, b"".join(parts)


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output in place of its text.

    ``rate`` percent of the texts are transformed, ``spm`` percent of those with the suffix first.
    """
    outputs = {name for name, _ in COLUMNS}
    kept = [f.name for f in docs.schema.fields if f.name != text and f.name.lower() not in outputs]
    schema = docs.select(*map(named, kept)).schema
    for name, kind in COLUMNS:
        schema = with_field(schema, name, kind)
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in batches:
            names = batch.schema.names
            ids = batch.column(names.index(id_col))
            texts = batch.column(names.index(text)).cast(pa.binary())
            start, size, rows = 0, 0, []
            for row in range(batch.num_rows):
                rows.append(transformed(texts[row].as_py() or b"", ids[row].as_py(), memory, seed, rate, spm))
                size += len(rows[-1][-1])
                if size >= BATCH_BYTES or row + 1 == batch.num_rows:
                    *facts, output = zip(*rows, strict=True)
                    passed = [batch.column(names.index(c)).slice(start, row + 1 - start) for c in kept]
                    made = [pa.array(v, t) for v, t in zip(facts, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([*passed, *made, pa.array(output, pa.binary()).cast(pa.string())], names=schema.names)
                    start, size, rows = row + 1, 0, []

    return map_batches(docs, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text behind ``output``; marks stand in it only where the transformation put them, so each is found once."""
    p, s, m = (F.lit(mark.decode()) for mark in MARKS)
    body = F.substring(output, 4, 2**31 - 1)

    def part(value: Column, mark: Column, number: int) -> Column:
        return F.split_part(value, mark, F.lit(number))

    after_prefix, after_suffix = part(body, s, 2), part(body, p, 2)
    psm = F.concat(part(body, s, 1), part(after_prefix, m, 2), part(after_prefix, m, 1))
    spm = F.concat(part(after_suffix, m, 1), part(after_suffix, m, 2), part(body, p, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
