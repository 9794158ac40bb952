"""What several operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.session import checkpoint_folder

#: The six ASCII characters that separate words.
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text: maximal runs of anything but space, tab and the line separators; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with none of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        own = f"_{name}"
        while own.lower() in taken:
            own = f"_{own}"
        taken.add(own.lower())
        found.append(own)
    return found


def named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there and a lost executor costs nothing."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_col: str, text_col: str, names: list[str]) -> list[Column]:
    """Two columns that tell rows apart: the id, and a hash of the text. Rows equal in both count as one document."""
    return [
        named(id_col).alias(names[0]),
        F.xxhash64(F.coalesce(named(text_col), F.lit(""))).alias(names[1]),
    ]


def same_key(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    """Null-safe equality of the key columns of two tables."""
    condition = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        condition = condition & (a[n] == b[n])
    return condition


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """``schema`` with the column ``name`` appended; a column of the same name gives way."""
    kept = [f for f in schema.fields if f.name.lower() != name.lower()]
    return T.StructType([*kept, T.StructField(name, kind)])


def by_shuffle(table: DataFrame) -> DataFrame:
    """``table`` for a join that deals both sides out by key, whatever size Spark expects.

    Spark sizes what stands above an ``explode`` by the rows below it, and a stored table by its compressed files, so without this it
    broadcasts tables many times its bound, which the driver has to hold.
    """
    return table.hint("merge")


def spread_lookup(rows: DataFrame, table: DataFrame, key: str, by: str, salts: int = 16) -> DataFrame:
    """``rows`` left-joined with ``table`` (one row per ``key``), a hot key spread over ``salts`` tasks.

    The rows are first counted by key and salt, which map-side combining makes
    cheap; the table is joined to those at most ``salts`` rows per key, and the
    rows meet it again by key and salt. Only keys that occur are copied, and only
    as often as they have salts.
    """
    (salt,) = private(rows, "salt")
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(named(by)), F.lit(salts)).cast("int"))
    present = salted.select(key, salt).distinct()
    return salted.join(by_shuffle(present.join(by_shuffle(table), key)), [key, salt], "left").drop(salt)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for columns of any name, dots and all: they travel under plain names."""
    names = df.columns
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(plain.names)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, plain).toDF(*schema.names)
