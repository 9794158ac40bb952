"""Inputs shared by the registered queries, and the SQL forms of the same inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.functions.clean import hours_between
from caseworks.sources.readers import table

__all__ = ["table", "r6", "durations", "labelled_documents", "document_vectors", "DURATIONS_SQL", "DOCLABELS_SQL", "split_sql"]


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def durations(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their lines: opened at order date, closed at ship date, theme is the priority."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        F.col("o_orderpriority").alias("theme"),
        F.col("o_orderdate").alias("opened_at"),
        F.col("l_shipdate").alias("closed_at"),
        hours_between("o_orderdate", "l_shipdate").alias("open_hours"),
    )


DURATIONS_SQL = """
dur AS (
  SELECT o_orderpriority AS theme, o_orderdate AS opened_at, l_shipdate AS closed_at,
         date_diff('microsecond', o_orderdate, l_shipdate) / 3.6e9 AS open_hours
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
)"""


def labelled_documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", *columns)
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


DOCLABELS_SQL = "dl AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def document_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that have an embedding, with its cluster as theme."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("theme"))
    return table(spark, sf, "documents").select("doc_id", "text", "source").join(vectors, "doc_id")


def split_sql(source: str, id_col: str, quota: str, columns: str = "") -> str:
    """CTEs m and s: ``source`` must be a SELECT of (id, target, label); quota is an expression of n."""
    return f"""
m AS ({source}),
c AS (
  SELECT *, count(*) OVER (PARTITION BY target, label) AS n,
         row_number() OVER (PARTITION BY target, label ORDER BY md5(concat({id_col}, '-42')), {id_col}) AS rn
  FROM m WHERE label IS NOT NULL
),
s AS (
  SELECT {id_col}, target, label, CASE WHEN rn <= {quota} THEN 'validation' ELSE 'train' END AS split{columns}
  FROM c
)"""
