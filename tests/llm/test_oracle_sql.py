"""The operators that SQL can express, against DuckDB over whole tables."""

from collections import Counter

import duckdb
import pytest

from claimweave.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    with duckdb.connect() as duck:
        for table in ("documents", "benchmark", "pages"):
            duck.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
        cursor = duck.execute(queries.ORACLE_SQL[name])
        columns = [c[0] for c in cursor.description]
        want = Counter(cursor.fetchall())
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == want and want
