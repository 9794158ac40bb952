"""Structured Streaming forms of daily volume, repeat contact and scoring.

Each trigger writes folders of its own number, so a repeated trigger replaces what
it wrote before, and a reader joins the folders to what the batch operator gives on
all rows that have arrived.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from caseworks.functions.clean import wall_micros
from caseworks.operators.contacts import repeat_contacts
from caseworks.operators.scoring import captured, score
from caseworks.operators.training import Classifier


def stream_daily_volume(stream: DataFrame, ts: str, theme: str, out: str, checkpoint: str) -> StreamingQuery:
    """Rows per (day, theme), open days included; rows may come however late.

    Each trigger writes the counts it changed; the state is one count per day and theme.
    """
    timed = stream.filter(F.col(ts).isNotNull() & F.col(theme).isNotNull())
    counted = timed.groupBy(F.to_date(ts).alias("day"), F.col(theme).alias("theme")).agg(F.count(F.lit(1)).alias("count"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/trigger={number}")

    writer = counted.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def daily_volume_so_far(spark: SparkSession, out: str, theme_type: str = "string") -> DataFrame:
    """(day, theme, count) from the folders of ``stream_daily_volume``: the newest count of each."""
    found = spark.read.schema(f"day date, theme {theme_type}, count long, trigger long").parquet(out)
    return found.groupBy("day", "theme").agg(F.max_by("count", "trigger").alias("count"))


def stream_repeat(
    stream: DataFrame, key: str, ts: str, id_col: str, out: str, checkpoint: str, days: float = 7, lateness_hours: float = 24
) -> StreamingQuery:
    """Repeat contact in order of event time.

    A row waits until the newest time seen lies ``lateness_hours`` beyond it, so rows that come in
    another order still meet their true predecessor. Each trigger writes the rows that are
    final (``done``), those that wait (``open``), the last final contact of each key
    (``last``) and rows that came too late (``late``: not after the watermark of the trigger
    before; they are kept apart and never change final rows). A trigger reads ``open`` and
    ``last`` of the trigger before it. The order is found by the batch operator, which splits
    keys with very many rows.
    """
    spark = stream.sparkSession
    fields = stream.select(key, id_col, ts).schema

    def write(batch: DataFrame, number: int) -> None:
        here, before = f"{out}/%s/trigger={number}", f"{out}/%s/trigger={number - 1}"
        arrived = batch.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, id_col, ts)
        waiting = spark.read.schema(fields).parquet(before % "open") if number else spark.createDataFrame([], fields)
        last = spark.read.schema(fields).parquet(before % "last") if number else spark.createDataFrame([], fields)
        mark = spark.read.schema("mark long").parquet(before % "mark").first()[0] if number else None
        newest = arrived.agg(F.max(wall_micros(ts))).first()[0]
        passed = None if newest is None else newest - int(lateness_hours * 3.6e9)
        now = max((m for m in (mark, passed) if m is not None), default=None)
        too_late = F.coalesce(wall_micros(ts) <= F.lit(mark).cast("long"), F.lit(False))
        arrived.filter(too_late).write.mode("overwrite").parquet(here % "late")
        known = waiting.unionByName(arrived.filter(~too_late))
        ready = F.coalesce(wall_micros(ts) <= F.lit(now).cast("long"), F.lit(False))
        known.filter(~ready).write.mode("overwrite").parquet(here % "open")
        _followed(last, known.filter(ready), key, ts, id_col, days).write.mode("overwrite").parquet(here % "done")
        newer = last.unionByName(known.filter(ready)).groupBy(key).agg(F.max(F.struct(ts, id_col)).alias("_last"))
        newer.select(key, f"_last.{id_col}", f"_last.{ts}").write.mode("overwrite").parquet(here % "last")
        spark.range(1).select(F.lit(now).cast("long").alias("mark")).write.mode("overwrite").parquet(here % "mark")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _followed(last: DataFrame, rows: DataFrame, key: str, ts: str, id_col: str, days: float) -> DataFrame:
    """(key, id, ts, hours_since_prev, is_repeat) of ``rows``, the last contacts before them given."""
    both = last.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
    return repeat_contacts(both, key, ts, id_col, days).filter("_new").select(key, id_col, ts, "hours_since_prev", "is_repeat")


def repeat_so_far(spark: SparkSession, stream_schema: StructType, key: str, ts: str, id_col: str, out: str, days: float = 7) -> DataFrame:
    """What ``stream_repeat`` has found: the final rows, and the waiting ones in the order known so far."""
    kinds = {c: stream_schema[c].dataType.simpleString() for c in (key, id_col, ts)}
    fields = ", ".join(f"`{c}` {t}" for c, t in kinds.items())
    done = spark.read.schema(f"{fields}, hours_since_prev double, is_repeat boolean").parquet(f"{out}/done")
    marks = spark.read.schema("mark long, trigger long").parquet(f"{out}/mark")
    newest = marks.agg(F.max("trigger")).first()[0]
    waiting, last = (spark.read.schema(fields).parquet(f"{out}/{part}/trigger={newest}") for part in ("open", "last"))
    columns = [key, id_col, ts, "hours_since_prev", "is_repeat"]
    return done.select(*columns).unionByName(_followed(last, waiting, key, ts, id_col, days))


def stream_score(
    stream: DataFrame, latest: Callable[[], Classifier], id_col: str, out: str, checkpoint: str,
    percent: float = 100.0,
) -> StreamingQuery:
    """Score arriving rows with the model ``latest`` returns at each trigger and capture a share as JSON.

    Each trigger writes its own folder, so a repeated trigger replaces what it wrote before.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = captured(score(batch, latest()), id_col, percent)
        kept.write.mode("overwrite").json(f"{out}/trigger={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
