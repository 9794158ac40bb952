"""Sentiment: lexicon score, external scorer, upset flags and summaries."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.clean import as_column, truncate_utf8
from caseworks.plans.bounded import bounded_rows

# Fixed values of the compound score (Hutto & Gilbert, 2014).
ALPHA = 15.0
CAPITALS, NEGATED, BOOST = 0.733, -0.74, 0.293
#: What a booster one, two and three words ahead still counts.
FADING = (1.0, 0.95, 0.9)
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MOST_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96

# Defaults; every call may bring its own lists.
NEGATIONS = (
    "not no never none nobody nothing neither nor nowhere cannot without isn't aren't wasn't weren't don't doesn't "
    "didn't won't wouldn't can't couldn't shouldn't hasn't haven't hadn't ain't"
).split()
BOOSTERS = {
    **dict.fromkeys("absolutely completely deeply entirely especially extremely highly incredibly really so totally truly utterly very".split(), BOOST),
    **dict.fromkeys("almost barely hardly kinda partly scarcely slightly somewhat".split(), -BOOST),
}
SLOTS = 4096


def _dictionary(entries: Mapping[str, float]) -> Callable[[Column], Column]:
    """Word -> number (null for other words) in constant time: a constant array of small maps, the slot by crc32."""
    slots: list[dict[str, float]] = [{} for _ in range(SLOTS)]
    for word, value in entries.items():
        slots[zlib.crc32(word.encode()) % SLOTS][word] = float(value)
    table = F.from_json(F.lit(json.dumps(slots)), "array<map<string,double>>")
    return lambda word: F.try_element_at(F.get(table, F.pmod(F.crc32(word.cast("binary")), F.lit(SLOTS)).cast("int")), word)


def lexicon_sentiment(
    df: DataFrame, id_col: str, text: str, lexicon: DataFrame, keep: Sequence[str] = (),
    negations: Sequence[str] = NEGATIONS, boosters: Mapping[str, float] = BOOSTERS, contrast: str = "but",
) -> DataFrame:
    """(id, keep…, compound): rule-based sum s of word valences, mapped to s / sqrt(s² + 15).

    Words are runs without white space, compared in lower case without the signs around them.
    A word of the lexicon counts its valence, more if it alone is in capitals, more or less with
    boosters among the three words before it (unless they are in the lexicon), reversed and
    weakened by each negation there, half before the first ``contrast`` word and one and a half
    times after it. Exclamation and question marks strengthen the sum.

    ``lexicon`` is (token, valence) of at most ``MAX_LOCAL_ROWS`` different tokens; it travels as a constant, so
    each text is scored where it is read and nothing is shuffled. Rows stay rows, equal ids or not.
    """
    entries = bounded_rows(
        lexicon.filter(F.col("token").isNotNull()).groupBy("token").agg(F.sum("valence").cast("double").alias("valence")), what="lexicon"
    )
    valence = _dictionary({r["token"]: r["valence"] for r in entries if r["valence"] is not None})
    boost = _dictionary(boosters)
    body = F.coalesce(as_column(text), F.lit(""))
    parts = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    bare = F.transform(parts, lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+\z", ""))
    marks = [F.char_length(body) - F.char_length(F.replace(body, F.lit(sign), F.lit(""))) for sign in "!?"]
    split = df.select(id_col, *keep, bare.alias("_bare"), marks[0].alias("_loudly"), marks[1].alias("_asked"))
    loud = F.transform("_bare", lambda w: (w == F.upper(w)) & (w != F.lower(w)))
    worded = split.select("*", F.transform("_bare", lambda w: F.lower(w)).alias("_low"), loud.alias("_loud")).drop("_bare")
    staged = worded.select(
        "*",
        F.transform("_low", valence).alias("_val"),
        F.transform("_low", boost).alias("_boost"),
        F.transform("_low", lambda w: w.isin(*negations)).alias("_not"),
        F.array_position("_low", contrast).alias("_turn"),
        (F.exists("_loud", lambda x: x) & ~F.forall("_loud", lambda x: x)).alias("_mixed"),
    )

    def counted(v: Column, i: Column) -> Column:
        own = v + F.when(F.get("_loud", i) & F.col("_mixed"), F.signum(v) * CAPITALS).otherwise(0.0)
        for back, share in enumerate(FADING, 1):
            near = F.when(F.get("_val", i - back).isNull(), F.get("_boost", i - back))
            own = own + F.signum(v) * share * F.coalesce(near, F.lit(0.0))
        for back in range(1, len(FADING) + 1):
            own = own * F.when(F.get("_not", i - back), NEGATED).otherwise(1.0)
        place = i + 1
        turn = F.when((F.col("_turn") == 0) | (place == F.col("_turn")), 1.0).when(place < F.col("_turn"), BEFORE_CONTRAST)
        return F.when(v.isNull(), 0.0).otherwise(own * turn.otherwise(AFTER_CONTRAST))

    summed = staged.select(
        id_col, *keep, "_loudly", "_asked",
        F.aggregate(F.transform("_val", counted), F.lit(0.0), lambda a, x: a + x).alias("_s"),
    )
    asked = F.when(F.col("_asked") <= 1, 0.0).when(F.col("_asked") <= MOST_QUESTIONS, F.col("_asked") * QUESTION).otherwise(MANY_QUESTIONS)
    strength = F.least("_loudly", F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION + asked
    total = F.col("_s") + F.signum("_s") * strength
    return summed.select(id_col, *keep, total.alias("_s")).select(
        id_col, *keep, (F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + F.lit(ALPHA))).alias("compound")
    )


def is_upset(score: Column | str, threshold: float = -0.5, mode: str = "lt") -> Column:
    """``lt``: compound strictly below the threshold. ``ge``: negative score at or above it."""
    c = as_column(score)
    hit = c < F.lit(threshold) if mode == "lt" else c >= F.lit(threshold)
    return F.coalesce(hit, F.lit(False))


def score_sentiment(
    df: DataFrame, id_col: str, text: str, scorer: Callable[[list[str]], list[tuple[str, float] | None]],
    batch: int = 25, limit_bytes: int | None = None,
) -> DataFrame:
    """(id, sentiment_label, negative_score) from a caller-supplied batch scorer.

    ``scorer`` gets up to ``batch`` texts, cut to ``limit_bytes`` bytes if given
    (``clean.SENTIMENT_BYTES`` suits hosted scorers), and returns one (label, negative score) or
    None per text. None reads as ("NEUTRAL", 0.0); a failed call, or an answer of another
    length, fails the task, which Spark tries again.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            results: list[tuple[str, float]] = []
            for start in range(0, len(frame), batch):
                chunk = frame["_text"].iloc[start : start + batch].tolist()
                got = list(scorer(chunk))
                if len(got) != len(chunk):
                    raise ValueError(f"{len(chunk)} texts, {len(got)} scores")
                results.extend(r if r is not None else ("NEUTRAL", 0.0) for r in got)
            yield pd.DataFrame(
                {
                    id_col: frame[id_col],
                    "sentiment_label": [r[0] for r in results],
                    "negative_score": [float(r[1]) for r in results],
                }
            )

    whole = F.coalesce(as_column(text), F.lit(""))
    ready = df.select(id_col, (truncate_utf8(text, limit_bytes) if limit_bytes else whole).alias("_text"))
    return ready.mapInPandas(run, f"{id_col} {kind}, sentiment_label string, negative_score double")


def sentiment_by_theme(
    df: DataFrame, theme: str, score: str, upset: Column, top: int | None = None, labels: DataFrame | None = None
) -> DataFrame:
    """Tickets, mean score and upset rate per theme, most upset first, label attached if given."""
    summary = (
        df.filter(F.col(theme).isNotNull())
        .groupBy(F.col(theme).alias("theme"))
        .agg(
            F.count(F.lit(1)).alias("tickets"),
            F.avg(score).alias("avg_score"),
            F.avg(upset.cast("double")).alias("upset_rate"),
        )
    )
    ordered = summary.orderBy(F.desc(F.round("upset_rate", 9)), F.desc("tickets"), "theme")
    ordered = ordered.limit(top) if top else ordered
    if labels is None:
        return ordered
    named = ordered.join(labels.select("theme", F.col("label").alias("_l")), "theme", "left")
    shown = F.concat(F.lit("Theme "), F.col("theme").cast("string"))
    return named.withColumn("label", F.coalesce("_l", shown)).drop("_l").orderBy(
        F.desc(F.round("upset_rate", 9)), F.desc("tickets"), "theme"
    )


def most_negative(df: DataFrame, id_col: str, score: str, n: int = 10, ascending: bool = True) -> DataFrame:
    """The ``n`` lowest compound scores, or the ``n`` highest negative scores."""
    order = F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()
    return df.orderBy(order, id_col).limit(n)
