"""Readers for CSV, JSON and libsvm on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.sources.split_csv import read_csv


def table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """Parquet table. ``spread`` is for text-heavy work on input that cannot be split.

    A scan with fewer splits than cores (one file with one row group) is dealt out over the
    cores; a scan that already has enough splits is left alone, so large tables never pay for it.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def case_csv_files(spark: SparkSession, path: str, which: str = "all") -> list[str]:
    """The CSV files of ``path``, a file or a folder, by name.

    ``which="one"`` picks one: the only ``*.csv`` of a folder, else its ``data.csv``, else the first by name. None at all is an error.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place) or system.getFileStatus(place).isFile():
        return [path]
    listed = (s.getPath() for s in system.listStatus(place) if s.isFile())
    files = sorted(str(p) for p in listed if p.getName().endswith(".csv") and not p.getName().startswith(("_", ".")))
    if not files:
        raise FileNotFoundError(f"no CSV file in {path}")
    if which == "all" or len(files) == 1:
        return files
    return [next((f for f in files if f.endswith("/data.csv")), files[0])]


def read_cases_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, which: str = "all") -> DataFrame:
    """CSV with header from a file or a folder of ``*.csv`` files (see ``case_csv_files``); quoted fields may hold line breaks.

    Large files are read by many tasks, line breaks or not. Types not given are inferred in a pass over all records.
    """
    return read_csv(spark, case_csv_files(spark, path, which), schema)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON documents holding an array of records or one record each."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def parse_json_records(df: DataFrame, json_col: str, schema: str, keep: list[str] | None = None) -> DataFrame:
    """Records inside a text column, each an array of objects or a single object."""
    records = F.coalesce(
        F.when(F.ltrim(json_col).startswith("["), F.from_json(json_col, f"array<struct<{schema}>>")),
        F.array(F.from_json(json_col, f"struct<{schema}>")),
    )
    return df.select(*(keep or []), F.inline(records))


def columns_json_to_rows(df: DataFrame, json_col: str, schema: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Column-oriented JSON ``{"a": […], "b": […]}`` to rows; ``schema`` maps column to element type."""
    kind = ", ".join(f"{name}: array<{t}>" for name, t in schema.items())
    parsed = df.select(*(keep or []), F.from_json(json_col, f"struct<{kind}>").alias("_j"))
    zipped = F.arrays_zip(*[F.col(f"_j.{name}") for name in schema])
    return parsed.select(*(keep or []), F.inline(zipped))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", num_features)
    return reader.load(path)
