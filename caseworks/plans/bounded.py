"""Small tables with a measured size, and joins against them.

Class counts, theme statistics, thresholds and code tables are usually tiny next
to the rows they describe, but nothing guarantees it. Each helper here measures
the table first, in rows and bytes: it is broadcast only when it fits. When it does
not, a shuffle join takes over in which the keys measured to be hot, and only those,
are salted, so none of them lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LOCAL_ROWS = 100_000
MAX_LOCAL_BYTES = 32 << 20
#: Rows of one key that one task takes in a shuffle join.
KEY_ROWS = 1_000_000


def _array_bytes(field: T.StructField) -> Column:
    """Bytes an array takes, roughly; text counts in full."""
    column = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType.elementType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.octet_length(x), F.lit(0))), F.lit(0))
    return 8 * F.greatest(F.size(column), F.lit(0)).cast("long")


def local_table(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS, max_bytes: int = MAX_LOCAL_BYTES) -> DataFrame | None:
    """``df`` held as a literal relation; None when it has more rows or bytes.

    Arrays are measured before anything is fetched; flat rows are measured once fetched.
    """
    head = df.limit(max_rows + 1)
    arrays = [_array_bytes(f) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if arrays and (head.agg(F.sum(sum(arrays))).first()[0] or 0) > max_bytes:
        return None
    table = head.toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def bounded_rows(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS, what: str = "table") -> list[Row]:
    """Rows of a table that must be small; an error instead of a silent cut when it is not."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows")
    return rows


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    max_rows: int = MAX_LOCAL_ROWS,
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """Join ``rows`` with a table holding one row per ``on`` key.

    Broadcast when the table is small (measured, not guessed). Otherwise the rows are
    counted by key first: a key with more than ``key_rows`` rows gets as many salts as it
    takes, chosen by ``spread_by``, and its row of the table as many copies. Other keys
    are neither salted nor copied. Rows with a NULL key match nothing and are spread freely.
    """
    small = local_table(table, max_rows)
    if small is not None:
        return rows.join(F.broadcast(small), list(on), how)
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > key_rows)
    # One row per ``key_rows`` rows at most.
    hot = F.broadcast(counts.select(*on, F.ceil(F.col("_n") / key_rows).cast("int").alias("_salts")))
    place = F.xxhash64(*spread_by)
    no_key = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
    salt = F.when(no_key, F.pmod(place, F.lit(1 << 30))).otherwise(F.pmod(place, F.coalesce("_salts", F.lit(1))))
    salted = rows.join(hot, list(on), "left").withColumn("_salt", salt.cast("int")).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = table.join(hot, list(on), "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, key: str, min_rows: int) -> list:
    """Keys holding at least ``min_rows`` rows, whatever their share of all rows.

    One key in ``min_rows`` rows can qualify at most, which bounds what reaches the driver.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return [r[0] for r in counts.filter(F.col("_n") >= min_rows).select(key).collect()]
