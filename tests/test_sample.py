"""The sample views over hand-made tables: large keys, and large files."""

import datetime as dt

import pytest

from claimweave.checks.queries import QUERIES
from claimweave.sources.sample import SampleViews

DAY = dt.datetime(1996, 5, 1)
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def tables(spark, folder, customers=(8,), orders=1):
    """A folder of test tables with one order and two lines per number up to ``orders``."""
    rows = {
        "nation": [(n, f"NATION {n}") for n in range(3)],
        "region": [(r, f"REGION {r}") for r in range(5)],
        "customer": [(c, f"Customer {c}", 1, 1.0, "SEGMENT") for c in customers],
        "supplier": [(n, f"Supplier {n}", 1, 1.0) for n in range(2)],
        "part": [(n, f"part {n}", "Brand", "TYPE", 1, 1.0) for n in range(2)],
        "orders": [(n, customers[n % len(customers)], "F", 1.0, DAY, "1") for n in range(1, orders + 1)],
        "lineitem": [(n, 1, 1, m, 5.0, 100.0, 0.1, 0.1, "N", "O", DAY) for n in range(1, orders + 1) for m in (1, 2)],
    }
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["member_details", "member_other_id"])
def test_a_day_of_a_large_key_does_not_stop_the_job(spark, tmp_path, name):
    rows = QUERIES[name](spark, tables(spark, tmp_path, (400_016, 400_024), 4))
    found = rows.collect()
    assert found
    if "patient_death_date" in rows.columns:
        assert {r.patient_death_date for r in found} == {None}


def test_a_file_that_is_read_in_parts_is_not_shuffled_before_use(spark, tmp_path):
    folder = tables(spark, tmp_path, orders=2000)

    def plan(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            return SampleViews(spark, folder)["lineitem"]._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    assert "Repartition" not in plan("1k")
    assert "Repartition" in plan("128m")
