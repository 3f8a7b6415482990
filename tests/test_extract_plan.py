"""What an extract shuffles, and that rows which pass the bitmaps of due keys without being due leave no trace."""

import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from claimweave import Staging, extract_records
from claimweave.operators import keys
from claimweave.operators.keys import likely_rows
from small import values
from test_extract import DAY, LOOKUP, staged


def test_no_raw_columns_are_shuffled_for_an_extract(spark, tmp_path):
    base = staged(spark, "PROFESSIONAL", [(1, DAY, 1)], [(1, 10), (1, 11)])
    for name, frame in (("audit", base.audit), ("claims_professional", base.claims), ("lines_professional", base.lines)):
        frame.write.parquet(f"{tmp_path}/{name}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = extract_records(Staging.from_files(spark, str(tmp_path), "professional"), "professional")
        plan = records._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len([columns for columns in shuffled if "_run" in columns]) == 2
    assert not [columns for columns in shuffled if "NOTE_TEXT" in columns]


@pytest.mark.parametrize("places", [keys.PLACES, 1])
def test_rows_that_only_pass_the_bitmaps_make_no_records(spark, monkeypatch, places):
    """With one place every row with a key passes."""
    monkeypatch.setattr(keys, "PLACES", places)
    twice = [*LOOKUP, ("INT005", "BILL_TYPE", "22", "A"), ("INT005", "BILL_TYPE", "22", "B")]
    claims = [(1, DAY, 1, "0110"), (1, DAY, 2, "0110"), (2, DAY, 3, "0220"), (None, DAY, 4, "0110"), (3, DAY, 5, None)]
    audit = [(1, "SUCCESS", None), (1, "SUCCESS", ""), (2, "FAILED", None), (None, "SUCCESS", None), (4, "SUCCESS", "")]
    lines = [(1, 11), (1, None), (2, 21), (None, 31), (3, 41), (4, 51)]
    data = staged(spark, "INSTITUTIONAL", claims, lines, twice, audit)
    for ordered in (True, False):
        records = extract_records(data, "institutional", ordered=ordered)
        assert values(records, "claim_fact_key", "claim_line_fact_key") == [(1, None)] * 4 + [(1, 11)] * 4
    due = staged(spark, "INSTITUTIONAL", claims, lines, twice, [*audit, (2, "SUCCESS", None)])
    with pytest.raises(PySparkException, match="more than one lookup row"):
        extract_records(due, "institutional").collect()


def test_likely_rows_are_all_of_the_keys_few_others_and_none_without_a_key(spark):
    rows = spark.range(-5000, 5000).select(F.expr("nullif(id, 7)").alias("k"), F.col("id").alias("t"))
    few = spark.range(-300, 2000, 10).select(F.expr("nullif(id, 0)").alias("k"))
    wanted = values(rows.join(few, "k", "left_semi"))
    found = values(likely_rows(rows, few, "k"))
    assert wanted and set(wanted) <= set(found) and len(found) < len(wanted) + 50
    assert not [r for r in found if r[0] is None]
    for kind in ("int", "decimal(12,1)", "string"):
        other = few.select(F.col("k").cast(kind))
        assert values(likely_rows(rows, other, "k")) == wanted
    assert likely_rows(rows, few.limit(0), "k").count() == 0


@pytest.mark.parametrize("ordered", [True, False])
def test_key_columns_are_found_whatever_their_case(spark, ordered):
    """Claims staged from a build have their keys in upper case."""
    base = staged(spark, "PROFESSIONAL", [(1, DAY, 1), (2, DAY, 2)], [(1, 10), (2, 20), (3, 30)])
    upper = ("CLAIM_FACT_KEY", "CREATED_DATE", "SEQ_NO")
    data = Staging(base.audit, base.claims.withColumnsRenamed({c.lower(): c for c in upper}), base.lines)
    records = extract_records(data, "professional", ordered=ordered)
    assert records.columns == ["claim_fact_key", "claim_line_fact_key", "claim_data"]
    assert values(records) == values(extract_records(base, "professional", ordered=ordered))
    few = spark.createDataFrame([(2,)], "claim_fact_key long")
    met = likely_rows(data.claims, few, "claim_fact_key")
    assert values(met, "CLAIM_FACT_KEY") == [(2,)]
    assert "bitmap_construct_agg" in met._jdf.queryExecution().optimizedPlan().toString()
