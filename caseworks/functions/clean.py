"""Column expressions for cleaning, casting and dates. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a missing target, and the two more the evaluation adds.
MISSING_TOKENS = ("", "nan", "NaN", "none", "None", "null", "NULL")
ZERO_TOKENS = ("0", "0.0")

# The widest text an embedding call, a label example and a sentiment call take.
EMBED_CHARS = 6000
LABEL_CHARS = 1200
SENTIMENT_BYTES = 4900

CASE_DATE_FORMAT = "M/d/yyyy, h:mm a"
EPOCH = "1970-01-01 00:00:00"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind; ``trim`` removes spaces only."""
    return F.regexp_replace(as_column(c), r"(?U)^\s+|\s+\z", "")


def norm_str(c: Column | str) -> Column:
    return strip(as_column(c).cast("string"))


def compose_text(subject: Column | str, description: Column | str) -> Column:
    empty = F.lit("")
    return strip(
        F.concat(
            F.coalesce(as_column(subject), empty), F.lit("\n"), F.coalesce(as_column(description), empty)
        )
    )


def _span_micros(start: Column, end: Column) -> Column:
    # timestampdiff() goes through the session time zone; subtracting wall clocks does not.
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return (span.cast("interval second").cast("decimal(20,6)") * F.lit(1_000_000)).cast("bigint")


def wall_micros(c: Column | str) -> Column:
    """Microseconds of a wall-clock time since 1970, whatever the session time zone."""
    return _span_micros(F.lit(EPOCH), as_column(c))


def wall_clock(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.lit(EPOCH).cast("timestamp_ntz"))


def to_ts(c: Column | str, formats: Sequence[str] = (CASE_DATE_FORMAT, "yyyy-MM-dd HH:mm:ss")) -> Column:
    """First format that parses, else NULL. Times are wall clock: no hour is lost to daylight saving."""
    text = F.concat(as_column(c), F.lit(" Z"))
    instant = F.coalesce(*[F.try_to_timestamp(text, F.lit(f"{f} X")) for f in formats])
    return wall_clock(F.unix_micros(instant))


def hours_between(start: Column | str, end: Column | str) -> Column:
    return _span_micros(as_column(start), as_column(end)) / F.lit(3.6e9)


def to_number(c: Column | str, default: float | None = 0.0) -> Column:
    """Unparsable and NaN become ``default``; with ``default=None`` they stay NULL."""
    number = as_column(c).cast("string").try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def valid_target(c: Column | str, zero_is_missing: bool = False) -> Column:
    tokens = MISSING_TOKENS + (ZERO_TOKENS if zero_is_missing else ())
    return F.coalesce(~norm_str(c).isin(*tokens), F.lit(False))


def blank_label(c: Column | str, label: str = "(blank)") -> Column:
    return F.coalesce(as_column(c).cast("string"), F.lit(label))


def truncate_chars(c: Column | str, n: int = EMBED_CHARS) -> Column:
    flat = F.replace(F.coalesce(as_column(c), F.lit("")), F.lit("\n"), F.lit(" "))
    return F.substring(strip(flat), 1, n)


def truncate_utf8(c: Column | str, limit: int = SENTIMENT_BYTES) -> Column:
    """At most ``limit`` UTF-8 bytes, never ending inside a character; NULL becomes ''."""
    text = F.coalesce(as_column(c), F.lit(""))
    raw = text.cast("binary")

    def starts_character(pos: int) -> Column:
        return ~F.hex(F.substring(raw, pos, 1)).between("80", "BF")

    # The cut is right after byte k when byte k+1 starts a character; a character has at most 4 bytes.
    cut = F.substring(raw, 1, max(limit - 3, 0))
    for k in range(max(limit - 2, 0), limit + 1):
        cut = F.when(starts_character(k + 1), F.substring(raw, 1, k)).otherwise(cut)
    return F.when(F.octet_length(text) <= limit, text).otherwise(cut.cast("string"))
