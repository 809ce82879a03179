"""Every registered query against its SQL twin on the smallest data."""

import os

import pytest

import __spark_entry__ as entry
from paperloom import catalog

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test data not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    return value.isoformat() if hasattr(value, "isoformat") else repr(value)


def test_every_query_has_a_twin():
    queries, twins = catalog.load()
    assert set(queries) == set(twins)
    assert set(queries) <= set(entry.queries()) and set(twins) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.load()[0]))
def test_twin(spark, duck, name):
    frame = entry.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in frame.collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())
