"""Every query against its SQL equivalent in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entries
from workbench.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def test_each_query_has_an_equivalent():
    assert set(REGISTRY) <= set(entries.queries())
    assert set(REGISTRY) <= set(entries.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    ours = entries.queries()[name](spark, SF_DIR)
    columns = sorted(ours.columns)
    found = duck.execute(entries.oracle_sql()[name])
    theirs = [c[0] for c in found.description]
    assert sorted(theirs) == columns
    want = sorted(repr(tuple(row[theirs.index(c)] for c in columns)) for row in found.fetchall())
    got = sorted(repr(tuple(row[c] for c in columns)) for row in ours.collect())
    assert got == want
    assert got


def test_entry(spark):
    assert entries.entry(spark).count() > 0
