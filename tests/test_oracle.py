"""Every query with SQL gives the rows that DuckDB gives."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from concord import queries as tables

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="session")
def oracle():
    c = duckdb.connect()
    for n in NAMES:
        c.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(tables.SQL))
def test_query(spark, oracle, name):
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    cursor = oracle.execute(entry.oracle_sql()[name])
    theirs = [d[0] for d in cursor.description]
    assert sorted(theirs) == columns
    expected = sorted(tuple(plain(r[theirs.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
