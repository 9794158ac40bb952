"""Exact interpolated quantiles that hold up for groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one task's
memory. Here a first pass sketches each group and brackets each wanted rank, and a second
pass counts and ranks only the values inside the brackets; the answer is still exact. Both passes are the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from caseworks.plans.bounded import lookup_join
from caseworks.plans.stages import write_stage

#: A sketched rank is off by at most one part in this many; smaller groups are bracketed by their whole range.
SKETCH_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    extra: Sequence[Column] = (),
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per group with ``quantiles`` (name -> probability) and the ``extra`` aggregates.

    NULL values are skipped, positions between two values interpolate linearly; a group without a value has NULLs.
    """
    groups = list(groups)
    # A struct, so that groups of NULL keys meet too.
    anchor = ["_g"]
    df = df.withColumn("_g", F.struct(*groups) if groups else F.struct(F.lit(0).alias("all")))
    values = df.filter(F.col(value).isNotNull())
    # A sketched rank is off by at most n/accuracy; four times that also covers interpolation
    # between neighbours once n >= accuracy. Smaller groups are bracketed by their whole range.
    slack = 4.0 / accuracy
    sketched = F.col("_n") >= accuracy
    names, probs = list(quantiles), [float(p) for p in quantiles.values()]
    lows = F.array(*[F.lit(max(p - slack, 0.0)) for p in probs])
    highs = F.array(*[F.lit(min(p + slack, 1.0)) for p in probs])
    sketch = df.groupBy(*anchor).agg(
        *extra,
        F.count(value).alias("_n"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
        F.percentile_approx(value, lows, accuracy).alias("_lo"),
        F.percentile_approx(value, highs, accuracy).alias("_hi"),
    )
    known = sketch.columns
    # One row per group, written so that the input is read once for it.
    sketch, _ = write_stage(sketch, "sketch")
    targets = F.array(
        *[
            F.struct(
                F.lit(i).alias("q"),
                (F.lit(p) * (F.col("_n") - 1)).alias("pos"),
                (F.col("_min") if p <= slack else F.when(sketched, F.col("_lo")[i]).otherwise(F.col("_min"))).alias("lo"),
                (F.col("_max") if p + slack >= 1 else F.when(sketched, F.col("_hi")[i]).otherwise(F.col("_max"))).alias("hi"),
            )
            for i, p in enumerate(probs)
        ]
    )
    brackets = sketch.filter(F.col("_n") > 0).select(*anchor, targets.alias("_t"))
    slim = values.select(*anchor, F.col(value).cast("double").alias("_v"))
    tagged = lookup_join(slim, brackets, anchor, ["_v"], "inner")

    inside = (
        tagged.withColumn("_t", F.explode(F.filter("_t", lambda t: F.col("_v") <= t["hi"])))
        .select(
            *anchor,
            F.col("_t.q").alias("_q"),
            F.col("_t.pos").alias("_pos"),
            F.when(F.col("_v") >= F.col("_t.lo"), F.col("_v")).alias("_v"),
        )
        .groupBy(*anchor, "_q", "_pos", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    # NULL stands for everything below the bracket and sorts first: it seeds the running rank.
    by_value = W.partitionBy(*anchor, "_q").orderBy(F.col("_v").asc_nulls_first())
    ranked = inside.withColumn("_end", F.sum("_c").over(by_value)).withColumn(
        "_start", F.col("_end") - F.col("_c")
    )
    lower, upper = F.floor("_pos"), F.ceil("_pos")

    def value_at(rank: Column) -> Column:
        found = F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))
        return F.coalesce(found, F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"))

    picked = ranked.groupBy(*anchor, "_q", "_pos").agg(value_at(lower).alias("_a"), value_at(upper).alias("_b"))
    exact = picked.withColumn("_x", F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_pos") - lower))
    wide = exact.groupBy(*anchor).agg(
        *[F.max(F.when(F.col("_q") == i, F.col("_x"))).alias(name) for i, name in enumerate(names)]
    )
    kept = [c for c in known if c not in (*anchor, "_n", "_min", "_max", "_lo", "_hi")]
    joined = sketch.select(*anchor, *kept).join(wide, anchor, "left")
    return joined.select(*[F.col(f"_g.`{g}`").alias(g) for g in groups], *kept, *names)
