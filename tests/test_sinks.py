import datetime as dt
import glob
import shutil

import pytest
from pyspark.sql import functions as F

from claimweave import (
    Staging,
    Warehouse,
    damaged_files,
    extract_records,
    publish_records,
    read_outcome,
    read_published,
    write_outcomes,
    write_staging,
)
from claimweave.plans.assemble import lay_out
from claimweave.plans.extract import due_claims
from claimweave.sources import sinks
from small import values, warehouse
from test_extract import staged

WINDOW = (dt.datetime(2023, 1, 2), dt.datetime(2023, 1, 2, 23))


def records(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "claim_data string").coalesce(1)


def scan_of(df):
    """Files and rows that the only scan of a collected frame has read."""
    metrics = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics()
    return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()


def test_a_repeated_slice_is_published_once(spark, tmp_path):
    root = str(tmp_path)
    first = publish_records(records(spark, ["a|1", "a|1", "b|", None]), root, "s1")
    assert publish_records(records(spark, ["other"]), root, "s1") == first
    publish_records(records(spark, []), root, "empty")
    assert values(read_published(spark, root, "s1")) == [("",), ("a|1",), ("a|1",), ("b|",)]
    assert read_published(spark, root, "empty").count() == 0
    assert len(glob.glob(f"{root}/attempts/s1-*")) == 1


def test_a_run_killed_before_publishing_is_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    with monkeypatch.context() as killed:
        killed.setattr(sinks, "_create_once", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            publish_records(records(spark, ["a"]), root, "s1")
    with pytest.raises(ValueError, match="not published"):
        read_published(spark, root, "s1")
    publish_records(records(spark, ["a"]), root, "s1")
    assert values(read_published(spark, root, "s1")) == [("a",)]


def test_the_first_of_two_runs_wins(spark, tmp_path):
    marker = f"{tmp_path}/published/s1.json"
    for text in ("first", "second"):
        sinks._create_once(spark, marker, text)
    assert open(marker).read() == "first"


def test_a_line_break_in_a_text_stops_the_publishing(spark, tmp_path):
    with pytest.raises(ValueError, match="line break"):
        publish_records(records(spark, ["a\nb"]), str(tmp_path), "s1")
    assert sinks.published(spark, str(tmp_path), "s1") is None


def test_damaged_files_are_found(spark, tmp_path):
    root = str(tmp_path)
    folder = publish_records(records(spark, ["a", "b"]), root, "s1").removeprefix("file:")
    assert damaged_files(spark, root, "s1").count() == 0
    part = glob.glob(f"{folder}/part-*")[0]
    shutil.copy(part, f"{folder}/part-99999.txt")
    spark.catalog.refreshByPath(folder)
    assert values(damaged_files(spark, root, "s1")) == [("part-99999.txt",)]


def test_both_outcomes_come_from_one_run(spark, tmp_path):
    rows = spark.createDataFrame([(1, "12"), (2, "x"), (3, None)], "key long, weight string")
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        runs.add(1)
        return text

    weight = seen(F.col("weight")).alias("weight")
    wide = lay_out(rows.select("key", weight), "PROFESSIONAL", {
        "CLAIM_FACT_KEY": F.col("key"), "PATIENT_WEIGHT": F.col("weight"),
        "CLAIM_TYPE_NAME": F.lit("PROFESSIONAL")})
    path = str(tmp_path / "out")
    assert write_outcomes(wide, path) == {"accepted": 2, "rejected": 1}
    assert runs.value == 3
    kept = read_outcome(spark, path, "professional", "accepted")
    assert kept.columns == wide.drop("reject_reason").columns
    assert values(kept, "CLAIM_FACT_KEY", "PATIENT_WEIGHT") == values(
        wide.filter("reject_reason is null"), "CLAIM_FACT_KEY", "PATIENT_WEIGHT")
    left_out = read_outcome(spark, path, "professional", "rejected")
    assert values(left_out, "CLAIM_FACT_KEY", "reject_reason") == [(2, "PATIENT_WEIGHT")]
    assert write_outcomes(wide.limit(0), str(tmp_path / "none")) == {"accepted": 0, "rejected": 0}


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """Four days of 500 claims; claim 1 has rows of two days, claim 2 no day, line 5000 no claim."""
    claims = [(n, dt.datetime(2023, 1, 1 + n % 4, 8), n) for n in range(3, 2003)]
    claims += [(1, dt.datetime(2023, 1, 1), 1), (1, dt.datetime(2023, 1, 2), 1), (2, None, 2)]
    lines = [(n, n) for n in (1, 2, 5, 6, 1001, 5000)]
    plain = staged(spark, "PROFESSIONAL", claims, lines)
    plain = Staging(plain.audit.distinct(), plain.claims.select("claim_fact_key", "created_date", "seq_no", "CLAIM_ID",
                    *(c for c in plain.claims.columns if c.upper() not in
                      ("CLAIM_FACT_KEY", "CREATED_DATE", "SEQ_NO", "CLAIM_ID"))), plain.lines)
    root = str(tmp_path_factory.mktemp("laid_out"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_staging(plain, root, "professional")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return plain, Staging.from_files(spark, root, "professional")


def test_a_small_slice_reads_few_files_and_row_groups(spark, laid_out):
    _, source = laid_out
    every = source.claims.select("seq_no")
    window = due_claims(source, time_range=WINDOW).select("seq_no")
    part = due_claims(source, (1000, 1010), WINDOW).select("seq_no")
    counts = [len(df.collect()) for df in (every, window, part)]
    assert counts == [2003, 501, 3]
    (files, rows), (window_files, window_rows), (part_files, part_rows) = map(scan_of, (every, window, part))
    assert rows == 2003 and window_files < files / 2 and window_rows == 501
    assert part_files <= window_files and part_rows < window_rows


@pytest.mark.parametrize("bounds", [(None, None), (None, WINDOW), ((1, 1000), WINDOW), ((1, 9), None)])
def test_laid_out_staging_gives_the_same_records(laid_out, bounds):
    plain, source = laid_out
    wanted = values(extract_records(plain, "professional", *bounds), "claim_fact_key", "claim_line_fact_key")
    assert wanted
    assert values(
        extract_records(source, "professional", *bounds), "claim_fact_key", "claim_line_fact_key"
    ) == wanted


def test_warehouse_from_the_catalog(spark, tmp_path):
    frames = warehouse(spark, diagnosis=[
        {"diagnosis_code": "A", "deleted_flag": "y "}, {"diagnosis_code": "B"}])
    spark.sql(f"create database warehouse_trial location '{tmp_path}/database'")
    try:
        frames["diagnosis"].write.saveAsTable("warehouse_trial.diagnosis")
        read = Warehouse.from_catalog(spark, "warehouse_trial")
        assert values(read["diagnosis"]) == values(frames["diagnosis"])
        assert values(read.live("diagnosis"), "diagnosis_code") == [("B",)]
        with pytest.raises(KeyError):
            read["no_such_table"]
    finally:
        spark.sql("drop database warehouse_trial cascade")
