"""CSV with line breaks inside quoted fields, read by many tasks.

A quote is open at a line if the quotes before it in its file are odd in number (doubled quotes inside a field keep
that number even). A first pass counts the quotes of each byte range of each file, running totals over the ranges tell which begin
inside a quoted field, and a second pass joins the lines of each range to records. What a range begins or ends with of
a record that crosses its border is put together by the number of the record, from the few ranges that have such pieces.
So a single large file is read by as many tasks as it has ranges; nothing but one row per range and the pieces is shuffled.

As the format asks, a field that contains a quote is quoted and its quotes are doubled. Line ends are LF or CRLF, those
inside fields are kept.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.plans.bounded import bounded_rows, lookup_join
from caseworks.plans.stages import write_stage

#: Types a column may have, the first that all its values fit.
KINDS = ("int", "long", "double", "boolean", "date", "timestamp")


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, range, value): the lines of each byte range in order, CR included."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range")]
    return spark.read.option("lineSep", "\n").text(list(paths)).select(*place, "value")


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, range, open, torn): whether a quote is open where the range begins, and whether one is at either of its ends."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "range").agg(F.sum(quotes).alias("quotes"))
    before = W.partitionBy("file").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    opened = counted.withColumn("open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    return opened.select("file", "range", "open", (F.col("open") | (F.col("quotes") % 2 == 1)).alias("torn"))


class _Assembler:
    """Joins the lines of ranges to records: kind WHOLE, or END, BEGIN and INSIDE of one that crosses borders.

    ``first`` marks the record that a file begins with.
    """

    WHOLE, END, BEGIN, INSIDE = range(4)

    def __init__(self):
        self.place, self.held = None, []
        self.inside = self.torn = self.fresh = False

    def close(self) -> Iterator[tuple]:
        """What the range leaves open."""
        if self.held:
            yield (*self.place, self.INSIDE if self.torn else self.BEGIN, self.fresh and not self.torn, "\n".join(self.held))
        self.held = []

    def take(self, place: tuple, open_: bool, line: str, turns: bool) -> Iterator[tuple]:
        if place != self.place:
            yield from self.close()
            self.place, self.inside, self.torn, self.fresh = place, open_, open_, place[1] == 0
        self.held.append(line)
        self.inside ^= turns
        if not self.inside:
            yield (*place, self.END if self.torn else self.WHOLE, self.fresh and not self.torn, "\n".join(self.held))
            self.held, self.torn, self.fresh = [], False, False


RECORDS = "file string, range long, kind int, first boolean, value string"


def _records(placed: DataFrame, pieces: bool) -> DataFrame:
    """``RECORDS`` of lines (file, range, open, value): the whole ones, or the ``pieces`` of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        state = _Assembler()

        def made(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            kept = [r for r in rows if (r[2] != state.WHOLE) == pieces]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*kept), kinds, strict=True)], names=[p.split()[0] for p in RECORDS.split(", ")])

        for batch in batches:
            file, start, open_ = (batch.column(k).to_pylist() for k in range(3))
            turns = pc.count_substring(batch.column(3), '"').to_numpy(zero_copy_only=False) % 2 == 1
            rows: list[tuple] = []
            for f, s, o, line, turn in zip(file, start, open_, batch.column(3).to_pylist(), turns.tolist(), strict=True):
                rows.extend(state.take((f, s), o, line, turn))
            yield from made(rows)
        yield from made(list(state.close()))

    return placed.select("file", "range", "open", "value").mapInArrow(run, RECORDS)


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, first, value): the records of the files that aren't empty; ``first`` marks the one a file begins with."""
    lines = _lines(spark, paths)
    ranges, _ = write_stage(_ranges(lines), "ranges")
    keys = ["file", "range"]
    placed = lookup_join(lines, ranges.select(*keys, "open"), keys, ["value"], "inner")
    whole = _records(placed, False).select("file", "first", "value")
    torn = ranges.filter("torn").select(*keys, "open")
    pieces = _records(lookup_join(lines, torn, keys, ["value"], "inner"), True)
    until = W.partitionBy("file").orderBy("range", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == _Assembler.BEGIN).cast("int")).over(until))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("range", "kind", "value"))), lambda p: p["value"])
    crossing = numbered.groupBy("file", "number").agg(F.max("first").alias("first"), F.array_join(parts, "\n").alias("value"))
    every = whole.union(crossing.select("file", "first", "value"))
    return every.select("file", "first", F.regexp_replace("value", "\r$", "").alias("value")).filter(F.col("first") | (F.col("value") != ""))


def infer_schema(records: DataFrame, names: Sequence[str], options: dict[str, str]) -> T.StructType:
    """Narrowest type of ``KINDS`` each column's values fit, else string; one pass over all ``records`` (value)."""
    plain = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    rows = records.select(F.from_csv("value", plain.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    whole, number = r"^[+-]?\d+$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?Infinity$|^[+-]?Inf$|^NaN$"
    day, clock = r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
    checks = []
    for k in range(len(names)):
        value = F.col(f"r.c{k}")
        fits = {
            "int": value.rlike(whole) & value.try_cast("int").isNotNull(), "long": value.rlike(whole) & value.try_cast("long").isNotNull(),
            "double": value.rlike(number), "boolean": F.lower(value).isin("true", "false"),
            "date": value.rlike(day) & value.try_cast("date").isNotNull(), "timestamp": (value.rlike(clock) | value.rlike(day)) & value.try_cast("timestamp").isNotNull(),
        }
        checks += [F.coalesce(F.min(fits[kind]), F.lit(False)).alias(f"{kind}{k}") for kind in KINDS]
    found = rows.agg(*checks).first()
    kinds = [next((kind for kind in KINDS if found[f"{kind}{k}"]), "string") for k in range(len(names))]
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in zip(names, kinds, strict=True)])


def read_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of CSV files that begin with a header, fields by place."""
    options = {"escape": '"', "multiLine": "true"}
    records = csv_records(spark, paths)
    body = records.filter(~F.col("first")).select("value")
    if schema is None:
        heads = bounded_rows(records.filter("first").select("value").limit(1), 1, "header")
        names = next(csv.reader(io.StringIO(heads[0]["value"]))) if heads else []
        if not names:
            raise ValueError("no header")
        schema = infer_schema(body, names, options)
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    plain = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(kind.fields)])
    rows = body.select(F.from_csv("value", plain.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    return rows.select(*[F.col(f"r.c{k}").alias(f.name) for k, f in enumerate(kind.fields)])
