"""Every query that has SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, DATA)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()), key=repr)
    theirs = sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in result.fetchall()), key=repr)
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
