import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimweave import functions as fn
from claimweave.functions.xml import element, xml_list
from claimweave.operators import audit_passed, in_slice, in_window
from claimweave.operators.lists import list_to_slots, ordered_list
from small import values


def column(spark, rows, kind="string"):
    return spark.createDataFrame([(r,) for r in rows], f"v {kind}")


def apply(spark, rows, rule, kind="string"):
    df = column(spark, rows, kind).select(rule(F.col("v")).alias("r"))
    return [r.r for r in df.collect()]


def kept(spark, rows, rule):
    return [r.v for r in column(spark, rows).filter(rule(F.col("v"))).collect()]


def test_missing_delete_flag_counts_as_live(spark):
    assert kept(spark, ["Y", "y", "y ", "N", None, ""], fn.not_deleted) == ["N", None, ""]


def test_missing_status_is_rejected(spark):
    assert kept(spark, ["R", "v", "A", None], fn.not_in_workbasket) == ["A"]


def test_version_range_is_half_open(spark):
    df = spark.createDataFrame([(10, 10, 20), (20, 10, 20), (19, 10, 20)], "k int, f int, t int")
    hit = df.filter(fn.in_version(F.col("k"), F.col("f"), F.col("t")))
    assert values(hit, "k") == [(10,), (19,)]


def test_blank_ignores_trailing_blanks(spark):
    assert kept(spark, [None, "", "  ", " x", "X"], fn.blank) == [None, "", "  "]
    assert kept(spark, [None, "", "  ", "X"], fn.filled) == ["X"]


@pytest.mark.parametrize(
    ("bill_type", "padded", "code"),
    [("0110", "0110", "11"), ("110", "0110", "11"), ("0000", "0000", ""), (None, "0000", None),
     ("1 30", "1 30", "10")],
)
def test_bill_type_forms(spark, bill_type, padded, code):
    assert apply(spark, [bill_type], fn.pad_bill_type) == [padded]
    assert apply(spark, [bill_type], fn.bill_type_code) == [code]


def test_poa_codes(spark):
    assert apply(spark, ["N/S", "N/A", "Yes", "", None], fn.poa_code) == ["", "", "Y", "", None]
    assert apply(spark, ["n/s", "N/A  ", " N/A"], fn.poa_code) == ["", "", " "]


def test_taxonomy_decides_claim_type(spark):
    codes = ["261QA1903X", "261qa1903x ", "207Q", None]
    assert apply(spark, codes, fn.claim_type_from_taxonomy) == ["A", "A", "P", "P"]


def test_numbers_and_dates(spark):
    assert apply(spark, ["123", "", "12x", None, "12345678901"], lambda c: fn.number_or_null(c, 10)) == [
        Decimal(123), None, None, None, None]
    assert apply(spark, [Decimal("12.50"), None], fn.number_text, "decimal(10,2)") == ["12.50", None]
    assert apply(spark, [dt.date(2023, 7, 8), None], fn.yyyymmdd, "date") == ["20230708", None]
    assert apply(spark, ["12-34-5", None], fn.strip_dashes) == ["12345", None]
    assert apply(spark, ["x", "", None], fn.presence_qualifier) == ["0", "0", ""]
    assert apply(spark, ["123456", None], lambda c: fn.left_n(c, 4)) == ["1234", None]


def test_element_escapes_and_leaves_out_null(spark):
    texts = ["a&b<c>", "", None]
    assert apply(spark, texts, lambda c: element("E", c)) == [
        "<E>a&amp;b&lt;c&gt;</E>", "<E></E>", ""]


def test_list_is_ordered_as_text_with_null_first_and_renumbered(spark):
    df = spark.createDataFrame([("10", "b"), ("2", "c"), (None, "a")], "o string, code string")
    entries = ordered_list([F.col("code")], ["CODE"], F.col("o"), renumber=True)
    row = df.agg(entries.alias("e")).select(
        xml_list(F.col("e"), ["CODE", "SORT_ORDER"], "ROW", "ROOT").alias("x")
    ).first()
    assert row.x == (
        "<ROOT><ROW><CODE>a</CODE><SORT_ORDER>1</SORT_ORDER></ROW>"
        "<ROW><CODE>b</CODE><SORT_ORDER>2</SORT_ORDER></ROW>"
        "<ROW><CODE>c</CODE><SORT_ORDER>3</SORT_ORDER></ROW></ROOT>"
    )


def test_list_without_members_is_null(spark):
    df = spark.createDataFrame([("1", "a")], "o string, code string")
    none = ordered_list([F.col("code")], ["CODE"], F.col("o"), only=F.col("code") == "z")
    assert df.agg(none.alias("e")).select(xml_list(F.col("e"), ["CODE"], "R", "L")).first()[0] is None


def test_slots_take_entries_in_order_and_leave_the_rest_null(spark):
    df = spark.sql("select array(named_struct('c', 'x'), named_struct('c', 'y')) as a")
    assert tuple(df.select(*list_to_slots(F.col("a"), {"c": "S_#"}, 2, 4)).first()) == ("x", "y", None)


def test_audit_gate(spark):
    rows = [(1, "success", None), (2, "SUCCESS", ""), (3, "Success", " "), (4, "SUCCESS", "X"),
            (5, "FAILED", None), (6, None, None)]
    audit = spark.createDataFrame(rows, "claim_number long, insert_status string, extract_status string")
    assert values(audit_passed(audit), "claim_number") == [(1,), (2,), (3,)]


def test_window_and_slice_are_closed(spark):
    days = [(n, dt.datetime(2023, 1, n)) for n in range(1, 6)]
    df = spark.createDataFrame(days, "seq_no long, created_date timestamp_ntz")
    window = in_window("created_date", dt.datetime(2023, 1, 2), dt.datetime(2023, 1, 4))
    assert values(df.filter(window), "seq_no") == [(2,), (3,), (4,)]
    assert values(df.filter(in_slice("seq_no", 2, 4)), "seq_no") == [(2,), (3,), (4,)]
