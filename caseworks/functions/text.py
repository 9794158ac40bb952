"""Tokens and n-grams as array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.clean import as_column

# Two or more word characters, the token rule of the hashing and TF-IDF vectorisers.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# A short list of English function words; every text operator takes its own list instead.
STOP_WORDS = (
    "an and are as at be been but by for from had has have he her his if in into is it its no not of on "
    "or our she so that the their them then there these they this to was we were which who will with you"
).split()


def tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(as_column(text), F.lit(""))), F.lit(f"({TOKEN_PATTERN})"), F.lit(1))


def without_words(words: Column, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def ngrams(words: Column, n: int) -> Column:
    """Joined runs of ``n`` neighbouring tokens; n = 1 returns the tokens."""
    if n == 1:
        return words
    runs = words
    for shift in range(1, n):
        later = F.slice(words, F.lit(shift + 1), F.greatest(F.size(words) - shift, F.lit(0)))
        runs = F.zip_with(F.slice(runs, F.lit(1), F.size(later)), later, lambda a, b: F.concat(a, F.lit(" "), b))
    return runs


def with_terms(
    df: DataFrame, text: str, out: str, ngram_range: tuple[int, int] = (1, 2), stop_words: Sequence[str] = ()
) -> DataFrame:
    """Add all n-grams of the text; stop words leave before n-grams are formed.

    Words become a column of their own first, so the text is tokenised once however many
    n-gram sizes refer to it.
    """
    worded = df.withColumn("_words", without_words(tokens(text), stop_words))
    grams = [ngrams(F.col("_words"), n) for n in range(ngram_range[0], ngram_range[1] + 1)]
    return worded.withColumn(out, F.concat(*grams) if len(grams) > 1 else grams[0]).drop("_words")
