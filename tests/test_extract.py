import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from claimweave import Staging, extract_records, write_records
from claimweave.operators.skew import frequent_keys, salted_join
from claimweave.plans.extract import record_pipe_count
from claimweave.plans.records import RECORDS
from small import values

DAY = dt.datetime(2023, 1, 5)
WINDOW = (dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 31))
LOOKUP = [("INT005", "BILL_TYPE", "11", "HOSP"), ("INT005", "OTHER", "12", "no"),
          ("INT009", "BILL_TYPE", "13", "no")]


def staged(spark, kind, claims, lines, lookup=LOOKUP, audit=None, named=True):
    """Staged rows in which every text field holds its own name."""
    def side(name, keys, rows):
        df = spark.createDataFrame(rows, keys)
        fields = {f.name: f.form for f in RECORDS[kind] if f.side == name}
        kinds = {"text": "string", "date": "date", "number": "decimal(10,2)"}
        return df.select(*df.columns, *(
            F.lit(n if f == "text" and named else None).cast(kinds[f]).alias(n)
            for n, f in fields.items() if n.lower() not in df.columns))

    audit = audit or [(c[0], "SUCCESS", None) for c in claims]
    keys = "claim_fact_key long, created_date timestamp_ntz, seq_no long"
    return Staging(
        spark.createDataFrame(audit, "claim_number long, insert_status string, extract_status string"),
        side("claim", keys + (", bill_type string" if kind == "INSTITUTIONAL" else ""), claims),
        side("line", "claim_fact_key long, claim_line_fact_key long", lines),
        spark.createDataFrame(lookup, "int_id string, type string, code string, value string"),
    )


@pytest.mark.parametrize("kind", ["PROFESSIONAL", "INSTITUTIONAL"])
def test_every_field_stands_in_its_place_without_a_last_pipe(spark, kind):
    claim = (1, DAY, 1) + (("0110",) if kind == "INSTITUTIONAL" else ())
    text = extract_records(staged(spark, kind, [claim], [(1, 10)]), kind, (1, 1), WINDOW).first()
    wanted = [
        {"lookup": "HOSP"}.get(f.side, "0110" if f.name == "BILL_TYPE" else f.name)
        if f.form == "text" else ""
        for f in RECORDS[kind]
    ]
    assert text.claim_data.split("|") == wanted
    assert not text.claim_data.endswith("|")


def test_missing_lookup_row_makes_the_record_null_but_keeps_the_line(spark):
    claims = [(1, DAY, 1, "0110"), (2, DAY, 2, "0120"), (3, DAY, 3, "0130"), (4, DAY, 4, None)]
    data = staged(spark, "INSTITUTIONAL", claims, [(n, n) for n in (1, 2, 3, 4)])
    rows = extract_records(data, "Institutional", (1, 9), WINDOW)
    assert values(rows.select("claim_fact_key", F.col("claim_data").isNull())) == [
        (1, False), (2, True), (3, True), (4, True)]


def test_lookup_rows_meet_whatever_their_case_and_trailing_blanks(spark):
    rows = [("int005 ", "Bill_Type", "1x ", "MIXED")]
    data = staged(spark, "INSTITUTIONAL", [(1, DAY, 1, "01X0")], [(1, 1)], rows)
    at = [f.side for f in RECORDS["INSTITUTIONAL"]].index("lookup")
    text = extract_records(data, "institutional").first().claim_data
    assert text.split("|")[at] == "MIXED"


def test_pipes_are_counted_per_field_over_due_rows(spark):
    claims = [(1, DAY, 1), (2, DAY, 2), (3, DAY, 3)]
    audit = [(1, "SUCCESS", None), (1, "SUCCESS", None), (2, "SUCCESS", None), (3, "FAILED", None)]
    data = staged(spark, "PROFESSIONAL", claims, [(1, 1), (1, 2), (3, 3)], audit=audit)
    piped = F.when(F.col("claim_fact_key") != 2, "a|b||c")
    data = Staging(
        data.audit, data.claims.withColumn("CLAIM_NOTE_TEXT", piped),
        data.lines.withColumn("LINE_NOTE_TEXT", F.lit("|")),
    )
    counts = record_pipe_count(data, "professional")
    found = counts.filter("with_pipe > 0")
    assert values(found, "side", "field", "rows", "with_pipe") == [
        ("claim", "CLAIM_NOTE_TEXT", 2, 1), ("line", "LINE_NOTE_TEXT", 2, 2)]
    texts = {(f.side, f.name) for f in RECORDS["PROFESSIONAL"] if f.form == "text"}
    assert counts.count() == len(texts)
    none = record_pipe_count(data, "professional", seq_range=(7, 9))
    assert values(none.agg(F.sum("rows"), F.sum("with_pipe"))) == [(0, 0)]


def test_lookup_code_stored_twice_fails_only_when_used(spark):
    twice = [*LOOKUP, ("INT005", "BILL_TYPE", "11", "again")]
    used = staged(spark, "INSTITUTIONAL", [(1, DAY, 1, "0110")], [(1, 1)], twice)
    with pytest.raises(PySparkException, match="more than one lookup row"):
        extract_records(used, "institutional", (1, 9), WINDOW).collect()
    unused = staged(spark, "INSTITUTIONAL", [(1, DAY, 1, "0990")], [(1, 1)], twice)
    assert extract_records(unused, "institutional", (1, 9), WINDOW).count() == 1


def test_slices_add_up_and_rows_are_sorted(spark):
    claims = [(n, DAY, n) for n in (3, 1, 2, 4)]
    lines = [(n, n * 10 + m) for n in (1, 2, 3, 4, 5) for m in (2, 1)]
    data = staged(spark, "PROFESSIONAL", claims, lines)
    def run(first, last):
        return [tuple(r)[:2] for r in extract_records(data, "professional", (first, last), WINDOW).collect()]
    assert run(1, 4) == sorted(run(1, 4)) == run(1, 2) + run(3, 4)
    assert len(run(1, 4)) == 8


def test_window_uses_the_creation_time(spark):
    claims = [(1, dt.datetime(2023, 1, 31), 1), (2, dt.datetime(2023, 1, 31, 0, 0, 1), 2)]
    data = staged(spark, "PROFESSIONAL", claims, [(1, 1), (2, 2)])
    assert values(extract_records(data, "professional", (1, 9), WINDOW), "claim_fact_key") == [(1,)]


def test_audit_rows_repeat_records(spark):
    audit = [(1, "SUCCESS", None), (1, "success", ""), (2, "SUCCESS", "X")]
    data = staged(spark, "PROFESSIONAL", [(1, DAY, 1), (2, DAY, 2)], [(1, 1), (2, 2)], audit=audit)
    assert values(extract_records(data, "professional", (1, 9), WINDOW), "claim_fact_key") == [(1,), (1,)]


def test_empty_fields_leave_only_pipes(spark):
    data = staged(spark, "PROFESSIONAL", [(1, DAY, 1)], [(1, 1)], named=False)
    assert extract_records(data, "professional", (1, 9), WINDOW).first().claim_data == "|" * 501


def test_unknown_type_is_refused(spark):
    data = staged(spark, "PROFESSIONAL", [(1, DAY, 1)], [(1, 1)])
    with pytest.raises(ValueError, match="dental"):
        extract_records(data, "dental", (1, 9), WINDOW)


def test_records_are_written_as_text(spark, tmp_path):
    data = staged(spark, "PROFESSIONAL", [(1, DAY, 1)], [(1, 1)])
    records = extract_records(data, "professional", (1, 9), WINDOW)
    write_records(records, str(tmp_path / "out"))
    assert values(spark.read.text(str(tmp_path / "out"))) == values(records, "claim_data")


def test_salted_join_equals_the_plain_join_and_spreads_the_hot_key(spark):
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("line"))
    small = spark.createDataFrame([(k, c) for k in range(60) for c in "ab"], "k long, name string")
    plain = values(small.join(big, "k"), "k", "name", "line")
    assert values(salted_join(small, big, "k", "line", rows_per_task=100), "k", "name", "line") == plain
    assert values(frequent_keys(big, "k", 100)) == [(7, 11)]


def test_staging_from_files_and_from_the_catalog_give_the_same_records(spark, tmp_path):
    base = staged(spark, "INSTITUTIONAL", [(1, DAY, 1, "0110")], [(1, 10), (1, 11)])
    parts = {
        "audit": base.audit, "claims_institutional": base.claims,
        "lines_institutional": base.lines, "lookup": base.lookup,
    }
    spark.sql(f"create database staging_trial location '{tmp_path}/database'")
    for name, frame in parts.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        spark.sql(f"create table staging_trial.{name} using parquet location '{tmp_path}/{name}'")
    try:
        got = [
            values(extract_records(source, "institutional"))
            for source in (
                base,
                Staging.from_files(spark, str(tmp_path), "institutional"),
                Staging.from_catalog(spark, "staging_trial", "institutional"),
            )
        ]
    finally:
        spark.sql("drop database staging_trial cascade")
    assert got[0] and got[0] == got[1] == got[2]
