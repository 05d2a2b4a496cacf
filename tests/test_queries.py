"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from lettermill.catalog import load_all

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
REGISTRY = load_all()
QUERIES, SQL = ({n: e.run for n, e in REGISTRY.items()}, {n: e.sql for n, e in REGISTRY.items()})


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(DATA):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{name}'")
    return connection


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, tables, name):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(str(tuple(r[c] for c in columns)) for r in frame.collect())
    result = tables.execute(SQL[name])
    at = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(at) == columns
    assert got == sorted(str(tuple(r[at[c]] for c in columns)) for r in result.fetchall())
    assert got


def test_entry(spark):
    assert driver.entry(spark).columns == ["namespace", "email_id", "copies", "first_doc_id"]
