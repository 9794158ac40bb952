"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a dozen numbers (lengths, shares of character classes,
repetition). Every number is cut into bins at quantiles of the training sample. The
model is an intercept plus one lookup table per feature plus small tables for the
pairs that explain most of what is left. Tables are learned by cyclic boosting:
round after round, feature by feature, a tree of at most three leaves is fitted to
the gradients collected in the bins and added with a small rate; pairs follow with
trees of one cut along either feature, both chosen together. Scoring looks up bins and adds.

The model is fitted on a bounded sample of labelled rows (``SAMPLE``, a few
thousand rows of numbers on the driver), chosen by a hash of the id; features and
scores are computed over all documents, in Arrow batches.

Null and empty texts have features of zero and get a score like any other. Rows are
scored one by one: ties and repeats score alike. Without labelled rows the score
is 0.5 throughout, and ``reject`` rejects nothing; with labels of one class only,
scores are that class's smoothed share. Empty tables give no rows. Other columns
are ignored by ``score`` and pass through ``reject`` whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import map_batches, named, private, with_field
from caseworks.llm.sampling import labelled_sample

SAMPLE = 10_000
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 48, 16, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
#: Least weight of a leaf, and its ridge.
LEAF, RIDGE = 4.0, 1.0
FEATURES = (
    "log_words", "word_length", "upper", "symbols", "exclamations", "digits", "bars", "distinct_words",
    "adjacent_repeats", "commonest_word", "repeated_lines", "line_words", "stops", "not_ascii",
)

_BYTE = np.zeros(256, "int64")
for _number, _set in enumerate((b"#*$%&<>", b"!", b"0123456789", b"|", b".,;:?", bytes(range(65, 91)), bytes(range(128, 256)), b" \t\n\v\f\r"), 1):
    _BYTE[list(_set)] = _number


def text_features(text: str) -> list[float]:
    """The numbers of one text, in the order of ``FEATURES``."""
    raw = text.encode("utf-8")
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, "uint8"), minlength=256)
    kinds = np.bincount(_BYTE, weights=counts, minlength=9)
    parts = raw.split()
    n = len(parts)
    if not n:
        return [0.0] * len(FEATURES)
    size = max(1.0, len(raw) - kinds[8])
    seen: dict[bytes, int] = {}
    for w in parts:
        seen[w] = seen.get(w, 0) + 1
    lines = [line for line in raw.split(b"\n") if line.strip()]
    again = sum(a == b for a, b in zip(parts, parts[1:], strict=False))
    return [
        math.log1p(n), size / n, kinds[6] / size, kinds[1] / size, kinds[2] / n, kinds[3] / size, kinds[4] / n,
        len(seen) / n, again / n, max(seen.values()) / n, 1 - len(set(lines)) / len(lines), n / len(lines),
        kinds[5] / n, kinds[7] / size,
    ]


def features(docs: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """``docs`` without the text and with its features as an array of double."""
    kept = [f.name for f in docs.schema.fields if f.name not in (text, out)]
    schema = with_field(docs.select(*map(named, kept)).schema, out, T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            values = [text_features(v.as_py() or "") for v in batch.column(names.index(text))]
            columns = [batch.column(names.index(n)) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.list_(pa.float64()))], names=schema.names)

    return map_batches(docs, run, schema)


@dataclass
class Model:
    """Edges of the bins, the tables over them, and the number of rows it was fitted on."""

    intercept: float = 0.0
    rows: int = 0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    coarse: list = field(default_factory=list)
    pairs: list = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of features."""
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for i, j, table in self.pairs:
            a = np.searchsorted(self.coarse[i], x[:, i], side="right")
            b = np.searchsorted(self.coarse[j], x[:, j], side="right")
            total += table[a, b]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin edges at quantiles, halfway between neighbouring values."""
    different = np.unique(values)
    if len(different) < 2:
        return np.empty(0)
    middle = (different[1:] + different[:-1]) / 2
    if len(middle) < bins:
        return middle
    at = np.searchsorted(different, np.quantile(values, np.arange(1, bins) / bins))
    return np.unique(middle[np.minimum(at, len(middle) - 1)])


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a range of bins; gain 0 if none is worth it."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl >= LEAF / 4) & (hr >= LEAF / 4), _gain(gl, hl) + _gain(gr, hr) - _gain(g.sum(), h.sum()), 0.0)
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step of a tree with at most three leaves over ordered bins."""
    ranges = [(0, len(g))]
    for _ in range(2):
        gain, cut, a, b = max(((*_best_cut(g[a:b], h[a:b]), a, b) for a, b in ranges), key=lambda found: found[0])
        if gain <= 0:
            break
        ranges.remove((a, b))
        ranges += [(a, a + cut), (a + cut, b)]
    step = np.zeros(len(g))
    for a, b in ranges:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step of a tree with one cut along the rows and one along the columns of a pair's bins, the two chosen together."""

    def quarters(x: np.ndarray) -> list[np.ndarray]:
        """Sums of the four parts for each place of the two cuts."""
        sums = np.cumsum(np.cumsum(x, 0), 1)
        low, rows, columns = sums[:-1, :-1], sums[:-1, -1:], sums[-1:, :-1]
        return [low, rows - low, columns - low, sums[-1, -1] - rows - columns + low]

    parts = list(zip(quarters(g), quarters(h), strict=True))
    gain = sum(_gain(gp, hp) for gp, hp in parts)
    r, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = np.empty_like(g)
    places = [(rows, columns) for rows in (slice(0, r + 1), slice(r + 1, None)) for columns in (slice(0, c + 1), slice(c + 1, None))]
    for place, (gp, hp) in zip(places, parts, strict=True):
        step[place] = gp[r, c] / (hp[r, c] + RIDGE)
    return step


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Model of labels ``y`` (0/1) given rows of features ``x``."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    model = Model(float(np.log(share / (1 - share))), n)
    if n == 0 or y.min() == y.max():
        return model
    width = x.shape[1]
    model.edges = [_cuts(x[:, j], BINS) for j in range(width)]
    model.coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(width)]
    bins = [np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(width)]
    few = [np.searchsorted(model.coarse[j], x[:, j], side="right") for j in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(n, model.intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            if len(model.edges[j]):
                g, h = gradients()
                size = len(model.tables[j])
                step = RATE * _tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size))
                model.tables[j] += step
                total += step[bins[j]]

    def cells(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = gradients()
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        at = few[i] * shape[1] + few[j]
        size = shape[0] * shape[1]
        return np.bincount(at, g, size).reshape(shape), np.bincount(at, h, size).reshape(shape)

    left = {(i, j): float(_gain(*cells(i, j)).sum()) for i, j in combinations(range(width), 2) if len(model.coarse[i]) and len(model.coarse[j])}
    chosen = sorted(left, key=lambda k: (-left[k], k))[:PAIRS]
    tables = {k: np.zeros((len(model.coarse[k[0]]) + 1, len(model.coarse[k[1]]) + 1)) for k in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            step = RATE * _pair_tree(*cells(i, j))
            tables[i, j] += step
            total += step[few[i], few[j]]
    model.pairs = [(i, j, tables[i, j]) for i, j in chosen]
    return model


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2,
    id_col: str = "doc_id", text: str = "text", rows: int = SAMPLE,
) -> Model:
    """Model of ``labels.label`` from at most ``rows`` labelled documents outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, folds, held_out, rows, id_col, text)
    found = features(sample).orderBy("doc_id").collect()
    x = np.asarray([r["features"] for r in found], dtype="float64").reshape(len(found), len(FEATURES))
    return fit(x, np.asarray([r["y"] for r in found], dtype="float64"))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the model's score of each text in ``out``; a column of that name gives way."""
    schema = with_field(docs.schema, out, T.DoubleType())
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            x = np.asarray([text_features(v.as_py() or "") for v in batch.column(names.index(text))])
            values = model.score(x.reshape(batch.num_rows, len(FEATURES)))
            columns = [batch.column(names.index(n)) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values)], names=schema.names)

    return map_batches(docs, run, schema)


def reject(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score below ``threshold``; all of them if the model saw no labelled row."""
    if model.rows == 0:
        return docs
    (out,) = private(docs, "score")
    return score(docs, model, text, out).filter(F.col(out) >= threshold).drop(out)
