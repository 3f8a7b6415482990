"""Every registered query against its SQL in DuckDB, over whole tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from claimweave.checks import oracle, queries
from claimweave.sources.sample import BASE_TABLES

# The optional training-data queries have tests of their own.
QUERIES = queries.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, folder, name):
    result = QUERIES[name](spark, folder)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    wanted = Counter(cursor.fetchall())
    got = Counter(tuple(r) for r in result.select(*columns).collect())
    assert got == wanted and sum(got.values()) > 0


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
