"""Every registered query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.9g}") + 0.0
    if hasattr(value, "isoformat"):
        return str(value)[:26]
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf, duck, name):
    found = queries()[name](spark, sf)
    rows = found.collect()
    assert rows
    if name not in SQL:
        return
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    order = sorted(columns)
    ours = sorted((tuple(plain(r[c]) for c in order) for r in rows), key=repr)
    places = [columns.index(c) for c in order]
    theirs = sorted((tuple(plain(r[i]) for i in places) for r in cursor.fetchall()), key=repr)
    assert ours == theirs
