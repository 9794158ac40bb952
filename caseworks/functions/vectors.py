"""Array arithmetic for embedding columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseworks.functions.clean import as_column


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    a, b = as_column(a), as_column(b)
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(as_column(v), lambda x: x.cast("double") * x.cast("double"))))


def l2_normalize(v: Column | str) -> Column:
    """Unit vector; the zero vector stays zero."""
    scale = F.transform(F.array(l2_norm(v)), lambda n: F.struct(n.alias("n"), as_column(v).alias("v")))
    # The norm is bound once as a lambda variable instead of being recomputed per element.
    unit = F.transform(
        scale, lambda s: F.transform(s["v"], lambda x: F.when(s["n"] > 0, x.cast("double") / s["n"]).otherwise(0.0))
    )
    return unit[0]


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """``1 - cos``; a zero vector has similarity 0 with everything."""
    norms = l2_norm(a) * l2_norm(b)
    return F.lit(1.0) - F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)
