"""Language identification by error-correcting output codes.

Every learned language has a codeword of +1 and -1; every place of it is a two-class question ("is the language one of these?")
that a classifier on character n-grams answers with a margin. All classifiers are trained from one table of n-gram
counts by language: the margin of a text is the mean over its n-grams
(and ``DOUBT`` more without an opinion) of the smoothed log-odds of the two sides, scaled so that margins
are log-odds on texts that did not take part in the counts. The codeword with the smallest weighted logistic loss wins, a place weighing the more the
fewer errors its classifier makes there. A text whose two best codewords are nearly as close is flagged.

Codes: all splits of up to ``EXHAUSTIVE`` languages; for more, ``PLACES`` x log2(languages) random places, of several draws the one whose
codewords differ most.

n-grams: lower-cased runs of letters (with their combining marks), a blank on either side, all stretches of 1 to ``LONGEST`` characters,
hashed to ``BUCKETS`` places.

The sample has ``ROWS`` texts of each language at most, chosen by a hash of the id without sorting a language, among rows outside the held-out fold whose language
is not null (of rows repeated with one id, the least text); a fifth of it sets scales and weights, the rest is counted. It is counted by Spark tasks; (languages x ``BUCKETS``) numbers reach the driver,
texts never do. Predictions read whole texts of all rows, in Arrow batches, each text on its own.

Texts that are null or have no letter are ``und`` with score 0, as is everything if no language was learned; with one language
learned every other text has it with score 1. Equal losses go to the alphabetically first language. Null ids teach nothing
and are predicted like others; repeated rows get repeated results; an empty table gives none. Columns named as an output are replaced, others pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import map_batches, named, with_field
from caseworks.llm.sampling import fold_of
from caseworks.plans.selection import mark_smallest

UNKNOWN = "und"
ROWS, LONGEST, BUCKETS = 1_000, 4, 1 << 15
#: Languages an exhaustive code is made for, random places per bit of information beyond, draws, and the largest number of languages.
EXHAUSTIVE, PLACES, DRAWS, MOST = 7, 15, 100, 256
SMOOTHING = 0.5
#: n-grams of no opinion added to every text, so that a few letters are no firm evidence.
DOUBT = 40
#: Characters hashed at a time.
PART = 1 << 18
#: A score below this is flagged as ambiguous.
SURE = 0.75
MIX = np.uint64(0x9E3779B97F4A7C15)


def letters_of(text: str) -> str:
    """The text's runs of letters in lower case, a blank around each; empty if it has none."""
    import regex

    found = regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower())
    return f" {' '.join(found)} " if found else ""


def grams(line: str) -> np.ndarray:
    """How often each bucket of n-grams occurs in ``line``."""
    codes = np.frombuffer(line.encode("utf-32-le"), "<u4").astype("uint64") + np.uint64(1)
    counts = np.zeros(BUCKETS, "int64")
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    for start in range(0, len(codes), PART):
        part = codes[start : start + PART + LONGEST - 1]
        h = np.zeros(len(part), "uint64")
        for n in range(1, LONGEST + 1):
            # Stretches of n characters that begin in this part; of a single one, blanks say nothing.
            h = (h[: len(part) - n + 1] ^ part[n - 1 :]) * MIX
            h ^= h >> np.uint64(29)
            own = h[:PART]
            if n == 1:
                own = own[part[:PART] != 33]
            counts += np.bincount(((own * MIX) >> shift).astype("int64"), minlength=BUCKETS)
    return counts


def codewords(languages: int, seed: int = 13) -> np.ndarray:
    """Matrix of +1 and -1, a row for each language, a column for each question; no column is constant."""
    if languages < 2:
        return np.empty((languages, 0), "int8")
    if languages <= EXHAUSTIVE:
        numbers = np.arange(1, 1 << (languages - 1))
        bits = numbers[None, :] >> np.arange(languages)[:, None] & 1
        return np.where(bits == 1, 1, -1).astype("int8")
    rng = np.random.Generator(np.random.PCG64(seed))
    places = math.ceil(PLACES * math.log2(languages))
    best, widest = None, -1
    for _ in range(DRAWS):
        drawn = rng.choice(np.array([-1, 1], "int8"), (languages, places))
        drawn = drawn[:, np.abs(drawn.sum(0, dtype="int64")) < languages]
        width = drawn.shape[1]
        apart = (width - drawn.astype("int64") @ drawn.T.astype("int64")) // 2 + np.eye(languages, dtype="int64") * width
        if apart.min() > widest:
            best, widest = drawn, apart.min()
    return best


@dataclass
class Model:
    """Languages in alphabetical order, their codewords, and for each place the weight of each bucket, scale, offset and weight."""

    languages: list[str]
    code: np.ndarray
    odds: np.ndarray
    scale: np.ndarray
    offset: np.ndarray
    weight: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """Margin of each place for the n-gram counts of one text."""
        held = np.flatnonzero(counts)
        mean = counts[held] @ self.odds[held] / (counts.sum() + DOUBT)
        return mean * self.scale + self.offset

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each language's codeword."""
        return np.logaddexp(0, -self.code * self.margins(counts)) @ self.weight

    def predict(self, text: str | None) -> tuple[str, float, str | None, bool]:
        """(language, score, runner-up, ambiguous) of a text."""
        line = letters_of(text or "")
        if not line or not self.languages:
            return UNKNOWN, 0.0, None, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, None, False
        losses = self.losses(grams(line))
        first, second = np.argsort(losses, kind="stable")[:2]
        chances = np.exp(losses.min() - losses)
        score = float(chances[first] / chances.sum())
        return self.languages[first], score, self.languages[second], score < SURE


def _sample(docs: DataFrame, folds: int, held_out: int, rows: int, id_col: str, text: str, lang: str) -> DataFrame:
    """(lang, checked, text) of the sample; ``checked`` marks the fifth that sets scales and weights."""
    key, name = named(id_col).alias("id"), named(lang).cast("string").alias("lang")
    known = docs.select(key, name).filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & (fold_of(F.col("id"), folds) != held_out))
    marked = mark_smallest(known.distinct(), ["lang"], "id", 13, lambda n: F.least(n, F.lit(rows)))
    texts = docs.select(key, name, named(text).alias("text")).join(F.broadcast(marked.filter("picked").select("id", "lang")), ["id", "lang"])
    checked = F.pmod(F.xxhash64("id"), F.lit(5)) == 0
    return texts.groupBy("lang", "id").agg(F.min("text").alias("text")).select("lang", checked.alias("checked"), "text")


def _counted(sample: DataFrame, languages: list[str]) -> np.ndarray:
    """n-gram counts by language of the counted part of the sample, added up by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                line = letters_of(text.as_py() or "")
                if line:
                    totals[lang] = totals.get(lang, 0) + grams(line)
        for lang, counts in totals.items():
            held = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(held)), pa.array(held), pa.array(counts[held])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    parts = sample.filter(~F.col("checked")).select("lang", "text").mapInArrow(run, "lang string, bucket long, n long")
    found = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), BUCKETS))
    rows = {lang: k for k, lang in enumerate(languages)}
    at = np.array([rows[v] for v in found.column("lang").to_pylist()], "int64")
    counts[at, found.column("bucket").to_numpy().astype("int64")] = found.column("n").to_numpy()
    return counts


def log_odds(counts: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Log-odds of each bucket for each place: the mean share in the languages of the one side over that of the other."""
    shares = (counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    odds = np.empty((BUCKETS, code.shape[1]))
    for place in range(code.shape[1]):
        side = code[:, place] == 1
        odds[:, place] = np.log(shares[side].mean(0)) - np.log(shares[~side].mean(0))
    return odds


def calibrated(margins: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scale, offset and weight of each place from raw margins and true sides (+1, -1) of checked texts: a logistic fit with a small ridge."""
    places = margins.shape[1]
    scale, offset, weight = np.ones(places), np.zeros(places), np.ones(places)
    for place in range(places):
        x, y = margins[:, place], sides[:, place]
        spread = float(np.abs(x).mean()) if len(x) else 0.0
        if spread == 0.0:
            continue
        design = np.stack([x / spread, np.ones(len(x))], 1)
        w = np.array([1.0, 0.0])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            slope = design.T @ (p - (y + 1) / 2) + 0.01 * w
            curve = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
            w = np.clip(w - np.linalg.solve(curve, slope), -50, 50)
        scale[place], offset[place] = max(w[0], 1e-3) / spread, w[1]
        wrong = (np.sum((x * scale[place] + offset[place]) * y <= 0) + 1) / (len(x) + 2)
        weight[place] = max(math.log((1 - wrong) / wrong), 0.05)
    return scale, offset, weight / weight.mean()


def train(
    docs: DataFrame, folds: int = 4, held_out: int = 2, rows: int = ROWS, id_col: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model:
    """Model from text and language of at most ``rows`` documents of each language outside the held-out fold."""
    sample = _sample(docs, folds, held_out, rows, id_col, text, lang)
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().limit(MOST + 1).collect())
    if len(languages) > MOST:
        raise ValueError(f"more than {MOST} languages")
    code = codewords(len(languages))
    none = np.ones(code.shape[1])
    if len(languages) < 2:
        return Model(languages, code, np.zeros((BUCKETS, 0)), none, none, none)
    model = Model(languages, code, log_odds(_counted(sample, languages), code), none, 0 * none, none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [letters_of(v.as_py() or "") for v in batch.column(1)]
            held = [k for k, line in enumerate(lines) if line]
            margins = [model.margins(grams(lines[k])).tolist() for k in held]
            columns = [batch.column(0).take(pa.array(held, pa.int64())), pa.array(margins, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "margins"])

    checked = sample.filter("checked").select("lang", "text").mapInArrow(run, "lang string, margins array<double>")
    found = checked.orderBy("lang", "margins").collect()
    margins = np.array([r["margins"] for r in found]).reshape(len(found), code.shape[1])
    places = {name: k for k, name in enumerate(languages)}
    sides = code[[places[r["lang"]] for r in found]].reshape(len(found), code.shape[1])
    return Model(languages, code, model.odds, *calibrated(margins, sides.astype("float64")))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (the share of the winner in the exponentials of the negative losses), runner_up and ambiguous."""
    outputs = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("runner_up", T.StringType()), ("ambiguous", T.BooleanType())]
    schema = docs.schema
    for name, kind in outputs:
        schema = with_field(schema, name, kind)
    kept = schema.names[: -len(outputs)]
    types = (pa.string(), pa.float64(), pa.string(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            found = [model.predict(v.as_py()) for v in batch.column(names.index(text))]
            made = [pa.array([row[k] for row in found], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in kept), *made], names=schema.names)

    return map_batches(docs, run, schema)
