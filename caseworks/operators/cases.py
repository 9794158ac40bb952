"""Turning an export into a case table: headers, text, dates, durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.functions.clean import compose_text, hours_between, to_number, to_ts

# Name patterns tried for the opening and closing date, most specific first.
OPENED_PATTERNS = (("date", "open"), ("opened",), ("open",))
CLOSED_PATTERNS = (("date", "close"), ("closed",), ("close",))


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def with_case_text(df: DataFrame, subject: str, description: str, out: str = "text") -> DataFrame:
    """Add the composed text and drop rows in which it is empty."""
    return df.withColumn(out, compose_text(subject, description)).filter(F.length(out) > 0)


def with_text_length(df: DataFrame, text: str = "text", out: str = "text_length") -> DataFrame:
    return df.withColumn(out, F.length(text))


def find_first_matching(columns: Sequence[str], patterns: Sequence[Sequence[str]]) -> str | None:
    """First column, pattern by pattern, whose lower-cased name contains all parts of the pattern."""
    return next(
        (c for pattern in patterns for c in columns if all(part in c.lower() for part in pattern)), None
    )


def ensure_timestamp(df: DataFrame, name: str, fallbacks: Sequence[str | None] = ()) -> DataFrame:
    """Make ``name`` a timestamp: keep it, or parse the first fallback column, or parse itself, else NULL."""
    if name in df.columns and isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    source = next((c for c in [*fallbacks, name] if c and c in df.columns), None)
    if source is None:
        return df.withColumn(name, F.lit(None).cast("timestamp_ntz"))
    if isinstance(df.schema[source].dataType, T.StringType):
        return df.withColumn(name, to_ts(F.col(f"`{source}`")))
    return df.withColumn(name, F.col(f"`{source}`").cast("timestamp_ntz"))


def with_open_hours(
    df: DataFrame, opened: str = "opened_at", closed: str = "closed_at", out: str = "open_hours"
) -> DataFrame:
    """Duration in hours, negative or NULL where the dates say so; an existing column is only made numeric."""
    if out in df.columns:
        return df.withColumn(out, to_number(out, default=None))
    return df.withColumn(out, hours_between(opened, closed))


def load_cases(
    df: DataFrame, subject: str = "Subject", description: str = "Description",
    opened: str | None = None, closed: str | None = None,
) -> DataFrame:
    """Export to case table: trimmed headers, ``text``, ``opened_at``, ``closed_at``, ``open_hours``."""
    df = strip_headers(df)
    opened = opened or find_first_matching(df.columns, OPENED_PATTERNS)
    closed = closed or find_first_matching(df.columns, CLOSED_PATTERNS)
    df = with_case_text(df, subject, description)
    df = ensure_timestamp(df, "opened_at", [opened])
    df = ensure_timestamp(df, "closed_at", [closed])
    return with_open_hours(df)
