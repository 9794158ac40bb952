"""Quality rules with cutoffs whose joint false rejections are bounded, in DataFrame functions only.

A fixed base (too few words, too many repeated five-word windows) rejects first.
On top of it the method chooses cutoffs for a few measures from labelled documents:

* Labelled documents are split into strata, here by length, and each stratum in two halves by a hash of the id.
  Every measure has a fixed ladder of cutoffs, from lenient to strict.
* The first half proposes a path: one cutoff after the other is tightened, always the one that rejects most bad documents for the good
  ones it costs. Every step of the path rejects what the steps before it reject, and more.
* The second half walks the path. A step, all cutoffs of it together, is safe if the exact binomial bound says so: were the share of good documents of the
  stratum that it rejects above ``alpha``, as few rejections as were seen would have had a probability of at most ``delta`` / strata (Bonferroni).
  The walk ends at the first step that fails (fixed-sequence testing needs no further correction); the one before it is taken.

So the share of good documents of each stratum that all measures together reject is at
most ``alpha``, in all strata at once with probability 1 - ``delta``. Some 220 good documents of the second half are needed in a stratum before any
step can be safe. Documents of either half are counted by stratum and by the steps of the ladders they exceed, a table bounded
by the ladders whatever the size of the input. All labelled rows count.

Null and empty texts have no words and fail the base. Rows are judged one by one,
so ties and repeats are judged alike. A document labelled several times counts as
good if one of its labels is 1; labels without a document, and null labels, count
nothing. Without labelled documents no cutoff is safe and the base decides alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from caseworks.llm.common import let, named, words

ALPHA, DELTA = 0.02, 0.05
#: Words in a repeated-window count, and the base's limits.
RUN, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Upper ends of the length strata in words.
STRATA = (50, 200, 1000)
#: Measures and their ladders, from lenient to strict; a document is rejected above the cutoff.
LADDERS: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05),
    "chars_per_word": (40.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0),
    "few_chars_per_word": (-1.5, -2.0, -2.5, -3.0, -3.5, -4.0),
    "dup_lines_per_100_words": (10.0, 5.0, 2.0, 1.0, 0.5, 0.2),
    "repeated_share": (0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02),
}


def _repeat_words(tokens: Column) -> Column:
    """Words inside windows of ``RUN`` words that the text holds twice or more.

    Windows are compared by the 64-bit hash of their words' hashes. Only a text in
    which two are equal sorts its windows by hash and place.
    """

    def of(hashes: Column) -> Column:
        n = F.size(hashes)
        windows = F.transform(
            F.sequence(F.lit(0), F.greatest(n - RUN, F.lit(0))), lambda i: F.xxhash64(*[F.get(hashes, i + o) for o in range(RUN)])
        )

        def repeated(ws: Column) -> Column:
            return F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0)).otherwise(covered(ws))

        return F.when(n < RUN, F.lit(0)).otherwise(let(windows, repeated))

    def covered(ws: Column) -> Column:
        filed = F.array_sort(F.transform(ws, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def starts(rows: Column) -> Column:
            twin = F.transform(
                rows, lambda r, k: F.when((F.get(rows, k - 1)["w"] == r["w"]) | (F.get(rows, k + 1)["w"] == r["w"]), r["i"])
            )
            return F.sort_array(F.array_compact(twin))

        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

        def add(state: Column, i: Column) -> Column:
            end = i + RUN
            return F.struct(end.alias("end"), (state["total"] + end - F.greatest(i, state["end"])).alias("total"))

        return F.aggregate(let(filed, starts), zero, add)["total"]

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), of)


def _duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda rows: F.size(rows) - F.size(F.array_distinct(rows)))


def measure(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    rows = docs.select(named(id_col).alias("doc_id"), F.coalesce(named(text), F.lit("")).alias("text"))
    counts = let(
        words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    symbols = F.char_length("text") - F.char_length(F.regexp_replace("text", r"[#*$%&|<>]", ""))
    counted = rows.select(
        "doc_id", counts.alias("c"), symbols.cast("long").alias("n_symbols"), _duplicate_lines(F.col("text")).cast("long").alias("n_dup_lines")
    )
    return counted.select("doc_id", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def stratum() -> Column:
    """Number of the length stratum, from 0."""
    return sum((F.col("n_words") >= limit).cast("int") for limit in STRATA)


def measures() -> dict[str, Column]:
    """The measures of ``LADDERS`` from the counts; 0 for a text without words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbols_per_word": F.col("n_symbols") / n,
        "chars_per_word": F.col("word_chars") / n,
        "few_chars_per_word": -F.col("word_chars") / n,
        "dup_lines_per_100_words": 100 * F.col("n_dup_lines") / n,
        "repeated_share": F.col("n_repeat_words") / n,
    }


def log_tail(n: int, k: int, p: float) -> float:
    """Logarithm of P(X <= k) for X binomial (n, p) with k below n p, summed from the k-th term downwards until terms no longer count."""
    top = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total, term, i = 1.0, 1.0, k
    while i > 0 and term > 1e-17 * total:
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        i -= 1
    return top + math.log(total)


def _levels() -> list[Column]:
    """For each measure how many cutoffs of its ladder a document does not exceed: it is rejected from that step on."""
    found = []
    for name, value in measures().items():
        found.append(sum((value <= F.lit(cut)).cast("int") for cut in LADDERS[name]).alias(name))
    return found


def proposed_path(rows: list[Row]) -> list[str]:
    """Measures in the order in which their cutoffs are tightened by one step, from counted documents (levels, y, docs).

    Each turn tightens one measure by as many steps as pay best; the path ends when no step rejects a bad document any more.
    """
    reached = dict.fromkeys(LADDERS, 0)
    left, path = list(rows), []
    while True:
        turns = []
        for name, cuts in LADDERS.items():
            for until in range(reached[name] + 1, len(cuts) + 1):
                good, bad = (sum(r["docs"] for r in left if r["y"] == y and r[name] < until) for y in (1, 0))
                if bad:
                    turns.append(((bad + 1) / (good + 1), -good, reached[name] - until, name, until))
        if not turns:
            return path
        *_, name, until = max(turns)
        path += [name] * (until - reached[name])
        reached[name] = until
        left = [r for r in left if r[name] >= until]


def safe_steps(path: list[str], rows: list[Row], alpha: float, delta: float) -> dict[str, int]:
    """Steps taken on each ladder at the last safe point of ``path``, from counted good documents (levels, docs)."""
    reached = dict.fromkeys(LADDERS, 0)
    n = sum(r["docs"] for r in rows)
    left, gone = list(rows), 0
    for name in path:
        hit = [r for r in left if r[name] <= reached[name]]
        gone += sum(r["docs"] for r in hit)
        if gone >= n * alpha or log_tail(n, gone, alpha) > math.log(delta):
            break
        left = [r for r in left if r[name] > reached[name]]
        reached[name] += 1
    return reached


def calibrate(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, measure, cutoff): the safe cutoff of each ladder that has one, from the labelled rows of ``counts``."""
    known = labels.filter(named(label).isNotNull()).groupBy(named(id_col).alias("doc_id")).agg(F.max(named(label).cast("int")).alias("y"))
    held = counts.join(known, "doc_id").filter(~base_failed())
    proof = (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1).alias("proof")
    table = held.select(stratum().alias("stratum"), proof, F.when(F.col("y") == 1, 1).otherwise(0).alias("y"), *_levels())
    rows = table.groupBy(*table.columns).agg(F.count(F.lit(1)).alias("docs")).collect()
    found = []
    for number in range(len(STRATA) + 1):
        own = [r for r in rows if r["stratum"] == number]
        path = proposed_path([r for r in own if not r["proof"]])
        steps = safe_steps(path, [r for r in own if r["proof"] and r["y"] == 1], alpha, delta / (len(STRATA) + 1))
        found += [(number, name, LADDERS[name][step - 1]) for name, step in steps.items() if step]
    return counts.sparkSession.createDataFrame(found, "stratum int, measure string, cutoff double")


def verdict(counts: DataFrame, cutoffs: list[Row]) -> DataFrame:
    """``counts`` with base_failed and kept; ``cutoffs`` are rows of ``calibrate``, at most one per ladder."""
    values = measures()
    over = F.lit(False)
    for r in cutoffs:
        over = over | ((stratum() == r["stratum"]) & (values[r["measure"]] > F.lit(r["cutoff"])))
    return counts.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~over)
