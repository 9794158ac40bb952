"""Toxicity: misspelled terms caught by Levenshtein automata over a lexicon trie, weighed by their context.

**Lexicon.** A short list of abusive English words, and what the labelled sample
teaches: words and word stems whose presence goes with the label far beyond
chance, counting copies of a document once. Each term gets a probability from the sample, apart for exact, stem and
misspelled matches, with the first letter right or not, so a term that ordinary words resemble loses its tolerance. A
learned term whose misspellings the sample doesn't hold starts from its own
probability, at a discount.

**Matching.** Terms are the paths of a trie. A word is run through the
intersection of the trie with the Levenshtein automata of all terms (no
difference up to four letters, one up to seven, two beyond; a swap of neighbours is
one difference). Words that differ at the first letter are a kind of match of their
own, tried after those that don't. Its states, sets of trie nodes
with the differences spent, are made when a word first needs them and kept, so a
known letter costs one lookup and most words die after a few. Digits and signs
that stand for letters are read as letters first.

**Context.** Within a window of words, a term between quotation marks counts half,
and less if a verb of reporting is near; one next to a second-person pronoun or
another term counts more. The score is 1 minus the product of the terms' doubts and
of the share of labelled documents without any term that are toxic all the same. Of misspelled learned terms only the strongest counts,
and by itself ``NEAR_MOST`` at most: the ordinary words of a language resemble one another.

The sample is bounded (``SAMPLE`` labelled rows, by a hash of the id), and with it the
lexicon; two thirds of it choose words, the rest must not speak against them. Scoring covers all documents and whole texts.

Null and empty texts have no term and get the lowest score. Rows are scored one by
one; ties and repeats score alike. Without labelled rows the short list alone
decides. Empty tables give no rows. Other columns play no part and pass through; one
named like an output gives way.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import map_batches, stored, with_field
from caseworks.llm.sampling import labelled_sample

SAMPLE = 8_000
#: Factors of the orders in which documents are sketched.
SKETCHES = (1, 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1)
#: Abusive words to start with, and the documents each counts for until labels say more.
SEEDS = "idiot moron stupid imbecile scum loser trash worthless pathetic disgusting clown dumbass bastard asshole retard vermin".split()
SEED_WEIGHT = 6.0
#: A misspelling's share of the probability of the term itself, and the documents this counts for with learned terms.
NEAR_SHARE, NEAR_WEIGHT = 0.85, 2.0
#: Most that one misspelled learned term counts by itself: ordinary words of its language may resemble it.
NEAR_MOST = 0.65
#: Fewest toxic documents of a learned term, its least share of toxic ones, and the shortest and longest stems.
LEAST_DOCS, LEAST_SHARE, STEMS = 6, 0.6, range(3, 8)
#: Fewest documents of a learned term in the part of the sample that proves it, and their least share of toxic ones.
PROOF_DOCS, PROOF_SHARE = 3, 0.8
WINDOW, NEAR = 12, 3
#: Matches that are seldom right don't count, however many there are.
DOUBTFUL = 0.5
QUOTED, REPORTED, ADDRESSED, CROWDED = 0.5, 0.5, 1.3, 1.1
OPENING, CLOSING = "\"'“„«‘‹", "\"'”“»’›"
REPORTING = frozenset("said says say wrote writes called calls quote quoted tweeted claimed dit écrit appelé sagte schrieb nannte dijo escribió llamó".split())
ADDRESS = frozenset("you your you're yours u ur tu te toi vous votre du dich dir dein ihr euch tú usted ustedes vos".split())
#: Read as the letter they stand for.
LETTERS = str.maketrans("013457@$!", "oieastasi")
SIGNS = ".,;:!?()[]{}<>|#*%&\"'"
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
MEMORY, STATES = 400_000, 60_000


def fold(word: str) -> str:
    """A word in lower case, without signs around it, look-alike signs read as letters."""
    plain = word.lower().strip(SIGNS)
    if plain.isalpha():
        return plain
    plain = EDGE.sub("", plain)
    return plain if plain.isalpha() else EDGE.sub("", plain.translate(LETTERS))


def tolerance(term: str) -> int:
    return 0 if len(term) <= 4 else 1 if len(term) <= 7 else 2


class Automaton:
    """The intersection of a trie of terms with their Levenshtein automata, made as words need it.

    A state is a set of (node, differences spent, letter held back by a swap).
    Only with ``front`` may the first letter differ.
    """

    def __init__(self, terms: Iterable[str], front: bool = False):
        terms = set(terms)
        self.children: list[dict[str, int]] = [{}]
        self.budget = [max(map(tolerance, terms), default=0) if front else 0]
        self.ends: dict[int, str] = {}
        for term in sorted(set(terms)):
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.budget.append(0)
                node = self.children[node][letter]
                self.budget[node] = max(self.budget[node], tolerance(term))
            self.ends[node] = term
        self.reset()

    def reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.dead = self.state(frozenset())
        self.start = self.state(self.closed({(0, 0, "")}))

    def state(self, items: frozenset) -> int:
        if items not in self.number:
            self.number[items] = len(self.sets)
            self.sets.append(items)
            self.moves.append({})
        return self.number[items]

    def closed(self, items: set) -> frozenset:
        """With the nodes that leaving out letters of a term leads to; of equal places the cheapest stays."""
        least: dict[tuple[int, str], int] = {}
        todo = list(items)
        while todo:
            node, spent, held = todo.pop()
            if least.get((node, held), 99) <= spent:
                continue
            least[node, held] = spent
            if not held and spent < self.budget[node]:
                todo += [(child, spent + 1, "") for child in self.children[node].values() if spent < self.budget[child]]
        return frozenset((node, spent, held) for (node, held), spent in least.items())

    def step(self, state: int, letter: str) -> int:
        found = set()
        for node, spent, held in self.sets[state]:
            children = self.children[node]
            there = children.get(letter)
            if held:
                after = self.children[there].get(held) if there is not None else None
                if after is not None and spent <= self.budget[after]:
                    found.add((after, spent, ""))
                continue
            if there is not None and spent <= self.budget[there]:
                found.add((there, spent, ""))
            if spent < self.budget[node]:
                found.add((node, spent + 1, ""))
                found.add((node, spent + 1, letter))
                found.update((child, spent + 1, "") for child in children.values() if spent < self.budget[child])
        return self.state(self.closed(found))

    def match(self, word: str) -> tuple[str, int] | None:
        """The closest term within tolerance and its distance; of equals the first in the alphabet."""
        if len(self.sets) > STATES:
            self.reset()
        at = self.start
        for letter in word:
            moves = self.moves[at]
            if letter not in moves:
                moves[letter] = self.step(at, letter)
            at = moves[letter]
            if at == self.dead:
                return None
        hits = [
            (spent, self.ends[node])
            for node, spent, held in self.sets[at]
            if not held and node in self.ends and spent <= tolerance(self.ends[node])
        ]
        return min(hits)[::-1] if hits else None


@dataclass
class Lexicon:
    """Terms and stems, the probability of each kind of match, and the share of toxic documents without a match."""

    terms: tuple[str, ...] = ()
    stems: tuple[str, ...] = ()
    chance: dict = field(default_factory=dict)
    rest: float = 0.01


class Matcher:
    """Looks words up in a lexicon and remembers what it found."""

    def __init__(self, lexicon: Lexicon):
        self.automaton = Automaton(t for t in lexicon.terms if not lexicon.chance or ("near", t) in lexicon.chance)
        # Words like a term but for letters after the first are no match at the front, also where that tolerance was lost.
        self.guard = Automaton(lexicon.terms)
        self.front = Automaton((t for t in lexicon.terms if not lexicon.chance or ("front", t) in lexicon.chance), front=True)
        self.terms, self.stems = frozenset(lexicon.terms), frozenset(lexicon.stems)
        self.lengths = sorted({len(s) for s in self.stems})
        self.known: dict[str, tuple[str, str] | None] = {}

    def look(self, raw: str) -> tuple[str, str] | None:
        word = fold(raw)
        if not word:
            return None
        if word in self.terms:
            return "exact", word
        for n in self.lengths:
            if n < len(word) and word[:n] in self.stems:
                return "stem", word[:n]
        near = self.automaton.match(word)
        if near:
            return "near", near[0]
        front = None if self.guard.match(word) else self.front.match(word)
        return ("front", front[0]) if front else None

    def hits(self, parts: list[str]) -> list[tuple[int, str, str]]:
        """(place, kind, term) of the words of a text that match."""
        if len(self.known) > MEMORY:
            self.known.clear()
        known, different = self.known, set(parts)
        for raw in different:
            if raw not in known:
                known[raw] = self.look(raw)
        if not any(known[w] for w in different):
            return []
        return [(i, *known[w]) for i, w in enumerate(parts) if known[w]]


def is_quoted(parts: list[str], i: int) -> bool:
    """Whether word ``i`` stands between quotation marks that open and close within the window."""
    for j in range(i, max(-1, i - WINDOW - 1), -1):
        if parts[j][0] in OPENING:
            break
        if j < i and parts[j][-1] in CLOSING:
            return False
    else:
        return False
    for j in range(i, min(len(parts), i + WINDOW + 1)):
        if parts[j].rstrip(".,;:!?")[-1:] in CLOSING and parts[j].rstrip(".,;:!?"):
            return True
        if j > i and parts[j][0] in OPENING:
            return False
    return False


def weight(parts: list[str], i: int, places: set[int]) -> float:
    """What a match at word ``i`` counts in its context; 1 where nothing speaks for or against."""
    if is_quoted(parts, i):
        around = parts[max(0, i - WINDOW) : i + WINDOW + 1]
        return QUOTED * (REPORTED if any(fold(w) in REPORTING for w in around) else 1.0)
    value = 1.0
    if any(fold(w) in ADDRESS for w in parts[max(0, i - NEAR) : i + NEAR + 1]):
        value *= ADDRESSED
    if any(j in places for j in range(max(0, i - WINDOW), i + WINDOW + 1) if j != i):
        value *= CROWDED
    return value


def text_score(text: str, matcher: Matcher, lexicon: Lexicon) -> float:
    """Score of one text, from 0 to 1."""
    doubt = 1 - lexicon.rest
    parts = text.split()
    hits = matcher.hits(parts)
    places = {i for i, _, _ in hits}
    likely = 0.0
    for i, kind, term in hits:
        counts = min(0.995, lexicon.chance.get((kind, term), 0.0) * weight(parts, i, places))
        if kind in ("near", "front") and term not in SEEDS:
            likely = max(likely, counts)
        else:
            doubt *= 1 - counts
    return 1 - doubt * (1 - likely)


def least_hashes(text: str) -> list[int]:
    """The smallest hash of a text's runs of three words in ``SKETCHES`` orders: near-copies share one of them nearly always, other texts hardly ever."""
    parts = text.split()
    hashes = {zlib.crc32(" ".join(parts[i : i + 3]).encode()) for i in range(max(1, len(parts) - 2))}
    return [min((h * factor) & 0xFFFFFFFF for h in hashes) for factor in SKETCHES]


def with_groups(sample: DataFrame) -> DataFrame:
    """The sample with the number ``part`` of each document's group of near-copies, found on the driver from its few hashes a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [least_hashes(v.as_py() or "") for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "sketch"])

    schema = T.StructType([sample.schema["doc_id"], T.StructField("sketch", T.ArrayType(T.LongType()))])
    rows = sorted(sample.select("doc_id", "text").mapInArrow(run, schema).collect())
    root = list(range(len(rows)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    first: dict[tuple, int] = {}
    for k, r in enumerate(rows):
        for shared in [("id", r["doc_id"]), *enumerate(r["sketch"])]:
            a, b = find(k), find(first.setdefault(shared, k))
            root[max(a, b)] = min(a, b)
    numbers = {r["doc_id"]: find(k) for k, r in enumerate(rows)}
    table = sample.sparkSession.createDataFrame(list(numbers.items()), T.StructType([sample.schema["doc_id"], T.StructField("part", T.LongType())]))
    return sample.join(F.broadcast(table), "doc_id")


def _emit(rows: DataFrame, of_text, schema: str = "kind string, term string, y int, part long") -> DataFrame:
    """(kind, term, y, part): the different findings of each labelled text, and its group of near-copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = of_text()
        for batch in batches:
            for text, y, part in zip(*(batch.column(k) for k in range(3)), strict=True):
                found = sorted(find(text.as_py() or ""))
                if found:
                    kinds, terms = zip(*found, strict=True)
                    labels, groups = pa.array([y.as_py()] * len(found), pa.int32()), pa.array([part.as_py()] * len(found), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(terms), labels, groups], names=["kind", "term", "y", "part"])

    return rows.select("text", "y", "part").mapInArrow(run, schema)


def _words_and_stems():
    def find(text: str) -> set[tuple[str, str]]:
        different = {fold(w) for w in set(text.split())} - {""}
        return {("word", w) for w in different} | {("stem", w[:n]) for w in different for n in STEMS if n < len(w)}

    return find


def _counts(rows: DataFrame) -> DataFrame:
    """Toxic and all documents of each finding, and its toxic groups of near-copies ``apart``.

    The third of the groups that is not chosen from gives ``proof_toxic`` and ``proof_docs``.
    """
    proof = F.pmod(F.xxhash64("part"), F.lit(3)) == 0
    by_part = rows.groupBy("kind", "term", "part").agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("docs"))
    return by_part.groupBy("kind", "term").agg(
        F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"), F.count_if(F.col("toxic") > 0).alias("apart"),
        F.coalesce(F.sum(F.when(proof, F.col("toxic"))), F.lit(0)).alias("proof_toxic"), F.coalesce(F.sum(F.when(proof, F.col("docs"))), F.lit(0)).alias("proof_docs"),
    )


def _chosen(found: list, total: int, toxic: int, features: int) -> tuple[list[str], list[str]]:
    """Words and stems whose link with the label is beyond chance; a stem only where no single word explains it."""
    base = toxic / total

    def evidence(r) -> float:
        clean = r["docs"] - r["proof_docs"] - (r["toxic"] - r["proof_toxic"])
        a, n = r["apart"], clean + r["apart"]
        share = a / n
        return a * math.log(share / base) + ((n - a) * math.log((1 - share) / (1 - base)) if n > a else 0.0)

    def proven(r) -> bool:
        return r["toxic"] / r["docs"] >= LEAST_SHARE and r["proof_docs"] >= PROOF_DOCS and r["proof_toxic"] >= PROOF_SHARE * r["proof_docs"]

    strong = [r for r in found if proven(r) and evidence(r) >= math.log(max(2, features)) + 1]
    words = {r["term"]: r["toxic"] for r in strong if r["kind"] == "word"}
    stems = {r["term"]: r["toxic"] for r in strong if r["kind"] == "stem"}
    best: dict[str, int] = {}
    for w, a in words.items():
        for n in STEMS:
            best[w[:n]] = max(best.get(w[:n], 0), a)
    longer: dict[str, int] = {}
    for s, a in stems.items():
        for n in STEMS:
            if n < len(s):
                longer[s[:n]] = max(longer.get(s[:n], 0), a)
    kept = [s for s, a in stems.items() if best.get(s, 0) < 0.8 * a and longer.get(s, 0) < 0.97 * a]
    kept = [s for s in kept if not any(s[:n] in kept for n in STEMS if n < len(s))]
    plain = [w for w in words if not any(w[:n] in kept for n in STEMS)]
    return plain, kept


def near_chance(toxic: int, docs: int, exact: float) -> float:
    """Probability of a misspelled learned term; below ``DOUBTFUL`` only where the sample holds false ones."""
    value = (toxic + NEAR_WEIGHT * NEAR_SHARE * exact) / (docs + NEAR_WEIGHT)
    return min(value if toxic < docs else max(value, DOUBTFUL), NEAR_MOST)


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1,
    id_col: str = "doc_id", text: str = "text", rows: int = SAMPLE,
) -> Lexicon:
    """Lexicon from at most ``rows`` labelled documents outside the held-out fold."""
    sample = stored(labelled_sample(docs, labels, label, folds, held_out, rows, id_col, text), "labelled")
    sample = stored(with_groups(sample), "grouped")
    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("y")).first()
    total, toxic = totals["n"], totals["y"]
    terms, stems = list(SEEDS), []
    if toxic:
        counted = stored(_counts(_emit(sample, _words_and_stems)).filter(F.col("toxic") > 0), "terms")
        # Bounded by the sample: a word of four of its documents at least, most of them toxic.
        found = counted.filter((F.col("apart") >= LEAST_DOCS) & (F.col("toxic") >= LEAST_SHARE * F.col("docs"))).orderBy("kind", "term").collect()
        plain, stems = _chosen(found, total, toxic, counted.count())
        terms += sorted(plain)
    lexicon = Lexicon(tuple(dict.fromkeys(terms)), tuple(sorted(stems)))

    def matches():
        matcher = Matcher(lexicon)

        def find(value: str) -> set[tuple[str, str]]:
            return {(kind, term) for _, kind, term in matcher.hits(value.split())} or {("none", "")}

        return find

    # Copies of a toxic document speak for a match once.
    seen = {(r["kind"], r["term"]): (r["apart"], r["docs"] - r["toxic"] + r["apart"]) for r in _counts(_emit(sample, matches)).collect()}
    base = (toxic + 1) / (total + 10)
    for kind in ("exact", "near", "front"):
        for term in lexicon.terms:
            a, n = seen.get((kind, term), (0, 0))
            own = SEED_WEIGHT * (term in SEEDS)
            lexicon.chance[kind, term] = (a + own * (0.97 if kind == "exact" else NEAR_SHARE) + base) / (n + own + 1)
            if kind != "exact" and not own and lexicon.chance["exact", term] >= DOUBTFUL:
                lexicon.chance[kind, term] = near_chance(a, n, lexicon.chance["exact", term])
    for stem in lexicon.stems:
        a, n = seen.get(("stem", stem), (0, 0))
        lexicon.chance["stem", stem] = (a + base) / (n + 1)
    lexicon.chance = {k: p for k, p in lexicon.chance.items() if p >= DOUBTFUL}
    a, n = seen.get(("none", ""), (0, 0))
    lexicon.rest = min(0.5, (a + 0.5) / (n + 10))
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` without the text and with its score in ``out``."""
    kept = [f.name for f in docs.schema.fields if f.name not in (text, out)]
    schema = with_field(docs.select(*[docs[f"`{c}`"] for c in kept]).schema, out, T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            names = batch.schema.names
            values = np.fromiter((text_score(v.as_py() or "", matcher, lexicon) for v in batch.column(names.index(text))), "float64", batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(names.index(n)) for n in kept], pa.array(values)], names=schema.names)

    return map_batches(docs, run, schema)
