"""Streams over several triggers against the batch operators."""

import random

from pyspark.sql import functions as F

from caseworks.operators.contacts import repeat_contacts
from caseworks.operators.incidents import daily_theme_counts
from caseworks.streaming import jobs

SCHEMA = "id long, k string, theme string, ts timestamp_ntz"


def _files(spark, tmp_path, parts):
    for part in parts:
        df = spark.createDataFrame(part, "id long, k string, theme string, s long")
        df = df.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000).cast("timestamp_ntz")).drop("s")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    whole = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in")
    return whole, spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def _rows(n=300):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", "b", None]), rng.choice(["x", "y", None]), rng.randrange(600_000)) for i in range(n)]
    return rng, rows


def test_repeat_waits_for_rows_out_of_order(spark, tmp_path):
    rng, rows = _rows()
    rows.sort(key=lambda r: r[3] + rng.randrange(40_000))
    whole, stream = _files(spark, tmp_path, [rows[:100], rows[100:200], rows[200:]])
    jobs.stream_repeat(stream, "k", "ts", "id", f"{tmp_path}/out", f"{tmp_path}/state", days=0.05, lateness_hours=24).awaitTermination()
    found = jobs.repeat_so_far(spark, stream.schema, "k", "ts", "id", f"{tmp_path}/out", days=0.05)
    columns = ["id", "hours_since_prev", "is_repeat"]
    assert found.select(columns).orderBy("id").collect() == repeat_contacts(whole, "k", "ts", "id", 0.05).select(columns).orderBy("id").collect()
    assert not spark.read.parquet(f"{tmp_path}/out/done").isEmpty()
    assert spark.read.parquet(f"{tmp_path}/out/late").isEmpty()


def test_too_late_rows_are_kept_apart(spark, tmp_path):
    _, stream = _files(spark, tmp_path, [[(1, "a", "x", 0), (2, "a", "x", 500_000)], [(3, "a", "x", 100), (4, "a", "x", 500_010)]])
    jobs.stream_repeat(stream, "k", "ts", "id", f"{tmp_path}/out", f"{tmp_path}/state", lateness_hours=1).awaitTermination()
    found = jobs.repeat_so_far(spark, stream.schema, "k", "ts", "id", f"{tmp_path}/out").orderBy("id").collect()
    assert [(r["id"], r["is_repeat"]) for r in found] == [(1, False), (2, True), (4, True)]
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/out/late").collect()] == [3]


def test_volume_counts_every_day_in_any_order(spark, tmp_path):
    rng, rows = _rows(120)
    rng.shuffle(rows)
    whole, stream = _files(spark, tmp_path, [rows[:50], rows[50:80], rows[80:]])
    jobs.stream_daily_volume(stream, "ts", "theme", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    found = {(r["day"], r["theme"]): r["count"] for r in jobs.daily_volume_so_far(spark, f"{tmp_path}/out").collect()}
    assert found == {(r["day"], r["theme"]): r["count"] for r in daily_theme_counts(whole, "ts", "theme").collect()}
