"""Secret scans: fixed shapes, and strings of high entropy found with a sliding window.

**Base.** Assignments to a password-like name, access keys, and long hexadecimal
runs; of each kind the leftmost matches that do not overlap, dropping those that
are too short.

**Entropy.** A candidate is a maximal run of ``[A-Za-z0-9+/_=-]`` of at least
``WINDOW`` characters. For each character class (hex digits, letters and digits,
base64 characters) a window of ``WINDOW`` characters moves over the parts of the
candidate that consist of the class. Its Shannon entropy is kept up to date from
the counts of the character that enters and the one that leaves. Windows
above the class's limit that hold a digit and a letter mark their characters; marks
that touch make one span of kind ``entropy``.

**Allow-list.** Candidates and spans that as a whole have a known harmless shape are suppressed. A word such as "example"
speaks for the letters and digits around it only: its run of them, up to ``REACH`` characters either side, is cut out of the candidate, and so
are base spans, before windows move over what is left. So base spans stay as they are, and a secret beside either is found.

Null and empty texts have no spans. Whole texts are scanned, whatever their
length. Rows are independent; ties, repeats and empty tables need no rule. Other
columns are not carried along unless named.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import named

# The kinds in their order, and their shapes.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20}

WINDOW = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
#: Of each class: its characters, and the bits of entropy a window must exceed.
CLASSES = {
    "hex": (re.compile(rf"[0-9A-Fa-f]{{{WINDOW},}}"), 3.0),
    "alnum": (re.compile(rf"[0-9A-Za-z]{{{WINDOW},}}"), 3.6),
    "base64": (re.compile(rf"[0-9A-Za-z+/_=-]{{{WINDOW},}}"), 3.9),
}
#: Harmless shapes: UUIDs, dates and versions, plain paths and identifiers.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}[0-9T_-]*",
    r"([A-Za-z]+[0-9]{0,4}[/_=-]+)+[A-Za-z]*[0-9]{0,4}",
)
#: Words of examples, and how far in a run of letters and digits they reach.
HARMLESS = "example|sample|placeholder|changeme|xxxx"
REACH = 40
PIECE = re.compile(r"[A-Za-z0-9]+")
SPAN = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans of a text, by start, then kind in the order of ``KINDS``."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def high_windows(run: str, limit: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Where windows of ``run`` exceed ``limit`` bits, merged; entropy is kept from counts, one step per character.

    With n = window, entropy is log2(n) - sum(c log2 c) / n over the counts c, so a
    character that enters or leaves changes one term of the sum.
    """
    share = [0.0, *[c * math.log2(c) for c in range(1, window + 1)]]
    top = (math.log2(window) - limit) * window
    counts: dict[str, int] = {}
    total, digits, letters = 0.0, 0, 0
    marks: list[tuple[int, int]] = []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += share[c + 1] - share[c]
        digits += ch.isdigit()
        letters += ch.isalpha()
        if i >= window:
            old = run[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += share[c - 1] - share[c]
            digits -= old.isdigit()
            letters -= old.isalpha()
        if i >= window - 1 and digits and letters and total < top - 1e-9:
            start = i - window + 1
            if marks and start <= marks[-1][1]:
                marks[-1] = (marks[-1][0], i + 1)
            else:
                marks.append((start, i + 1))
    return marks


def left_over(start: int, end: int, blocked: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of ``start`` to ``end`` outside ``blocked``."""
    parts = []
    for a, b in sorted(blocked):
        if start < a < end:
            parts.append((start, a))
        start = max(start, b)
    return [*parts, (start, end)] if start < end else parts


def harmless_parts(text: str, start: int, end: int, words: re.Pattern) -> list[tuple[int, int]]:
    """Letters and digits around harmless words between ``start`` and ``end``."""
    found = []
    for word in words.finditer(text, start, end):
        low, high = max(start, word.start() - REACH), min(end, word.end() + REACH)
        piece = next(p for p in PIECE.finditer(text, low, high) if p.end() > word.start())
        found.append(piece.span())
    return found


def entropy_spans(
    text: str, taken: Sequence[tuple[str, int, int]], allowed: Sequence[re.Pattern] = tuple(map(re.compile, ALLOWED)),
    harmless: re.Pattern = re.compile(HARMLESS, re.IGNORECASE),
) -> list[tuple[str, int, int]]:
    """Spans of high entropy outside ``taken``, of no allowed shape and away from harmless words."""
    marks: list[tuple[int, int]] = []
    for candidate in CANDIDATE.finditer(text):
        word = candidate[0]
        if word.isalpha() or word.isdigit() or any(shape.fullmatch(word) for shape in allowed):
            continue
        first, last = candidate.span()
        blocked = [(a, b) for _, a, b in taken if a < last and first < b] + harmless_parts(text, first, last, harmless)
        for low, high in left_over(first, last, blocked) if blocked else [(first, last)]:
            part = text[low:high]
            if len(part) < WINDOW or (blocked and any(shape.fullmatch(part) for shape in allowed)):
                continue
            for shape, limit in CLASSES.values():
                for run in shape.finditer(part):
                    base = low + run.start()
                    marks += [(base + a, base + b) for a, b in high_windows(run[0], limit)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(marks):
        # Parts on either side of a cut don't touch: something stands between them.
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    spans = []
    for a, b in merged:
        if not any(shape.fullmatch(text[a:b]) for shape in allowed):
            spans.append(("entropy", a, b))
    return spans


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """doc_id, and arrays ``base`` and ``entropy`` of (kind, start, end) in code points, end exclusive."""
    rows = docs.select(named(id_col).alias("doc_id"), named(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("base", SPAN), T.StructField("entropy", SPAN)])
    arrow_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = tuple(map(re.compile, allowed))

        def as_array(found: list[list[tuple[str, int, int]]]) -> pa.Array:
            return pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row] for row in found], arrow_span)

        for batch in batches:
            base, more = [], []
            for value in batch.column(1):
                whole = value.as_py() or ""
                base.append(base_spans(whole))
                more.append(entropy_spans(whole, base[-1], shapes))
            yield pa.RecordBatch.from_arrays([batch.column(0), as_array(base), as_array(more)], names=schema.names)

    return rows.mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    """Spans written as kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def in_order(spans: Column) -> Column:
    """Spans by start, then kind: those of ``KINDS`` as listed, then entropy."""
    place = F.array(*[F.lit(k) for k in (*KINDS, "entropy")])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(place, s["kind"]), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"]))
