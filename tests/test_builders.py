import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from small import FOREVER, values, warehouse

from claimweave import (
    BuildOptions,
    HeaderOptions,
    Warehouse,
    accepted,
    build_claims,
    rejected,
    stage_claims,
    write_claims,
)
from claimweave.operators import joins
from claimweave.plans import bridge, clinical, header, member, provider
from claimweave.plans.amounts import claim_amounts
from claimweave.sources import warehouse as warehouse_module

AS_OF = dt.datetime(2020, 1, 1)
CLAIM = {"claim_fact_key": 1, "claim_hcc_id": "H1", "claim_type_name": "Institutional",
         "statement_start_date_key": 20230615, "is_adjusted": "N"}


def test_split_lines_drop_only_lines_named_by_another_live_split(spark):
    def line(key, hcc, original=None, split=None, deleted=None, copay=None, claim=1):
        return {"claim_fact_key": claim, "claim_line_fact_key": key, "claim_line_hcc_id": hcc,
                "original_line_number": original, "is_split": split, "deleted_flag": deleted,
                "billed_amount": Decimal(10), "base_copay_amount": copay,
                "base_deductible_amount": Decimal("1.50")}

    wh = warehouse(
        spark,
        all_claim_fact=[CLAIM, CLAIM | {"claim_fact_key": 2}],
        all_claim_line_fact=[
            line(11, "L1"), line(12, "L2"), line(13, "L3", "L1", "y"),
            line(14, "L4", "L2", "Y", deleted="y"),
            line(15, "L5", "L5", "Y"),
            line(16, "L3", "L3", "N"),
            line(21, "L1", claim=2), line(22, None, claim=2),
        ],
    )
    claims = wh["all_claim_fact"].select("claim_fact_key")
    got = values(claim_amounts(claims, wh), "claim_fact_key", "claim_billed_amount",
                 "claim_copay_amount", "claim_patient_liability_amount")
    assert got == [(1, Decimal("40.00"), None, Decimal("6.00")),
                   (2, Decimal("20.00"), None, Decimal("3.00"))]
    twice = claims.union(claims)
    assert values(claim_amounts(twice, wh), "claim_billed_amount") == [
        (Decimal("40.00"),), (Decimal("80.00"),)]


def test_newest_payment_link_wins_even_without_a_paid_payment(spark):
    wh = warehouse(
        spark,
        payment_fact_to_claim_fact=[
            {"claim_fact_key": 1, "payment_fact_key": 5}, {"claim_fact_key": 1, "payment_fact_key": 9},
            {"claim_fact_key": 2, "payment_fact_key": 5},
            {"claim_fact_key": 2, "payment_fact_key": 9, "deleted_flag": "Y"},
            {"claim_fact_key": 3, "payment_fact_key": None},
        ],
        payment_fact=[
            {"payment_fact_key": 5, "payment_status_code": "3", "payment_date_key": 20230101},
            {"payment_fact_key": 9, "payment_status_code": "1", "payment_date_key": 20230202},
        ],
        date_dimension=[{"date_key": 20230101, "date_value": dt.date(2023, 1, 1)},
                        {"date_key": 20230202, "date_value": dt.date(2023, 2, 2)}],
    )
    assert values(clinical.latest_payment(wh)) == [(1, None), (2, dt.date(2023, 1, 1)), (3, None)]


def test_rendering_falls_back_on_the_key_alone(spark):
    history = FOREVER | {"practitioner_status": "A", "practitioner_hcc_id": "P7"}
    wh = warehouse(
        spark,
        all_claim_fact=[
            CLAIM | {"supplier_key": 3, "attending_practitioner_key": 7},
            CLAIM | {"claim_fact_key": 2, "supplier_key": 3},
            CLAIM | {"claim_fact_key": 3, "supplier_key": 3, "attending_practitioner_key": 8},
            CLAIM | {"claim_fact_key": 4, "supplier_key": 3, "claim_type_name": "PROFESSIONAL"},
        ],
        all_practitioner_history_fact=[history | {"practitioner_key": 7}],
        all_supplier_history_fact=[
            FOREVER | {"supplier_key": 3, "supplier_status": "A", "supplier_hcc_id": "S3"}],
        all_claim_line_fact=[
            {"claim_fact_key": 4, "claim_line_fact_key": 1},
            {"claim_fact_key": 4, "claim_line_fact_key": 2, "practitioner_key": 8, "deleted_flag": "y"},
            {"claim_fact_key": 4, "claim_line_fact_key": 4, "practitioner_key": 9},
            {"claim_fact_key": 4, "claim_line_fact_key": 3, "practitioner_key": 7},
        ],
    )
    scalars = provider.claim_scalars(wh["all_claim_fact"])
    keyed = provider.rendering_key(scalars, provider.first_line_practitioner(wh))
    rows = provider.rendering_provider(keyed, provider.billing_provider(scalars, wh), wh)
    assert values(rows, "claim_fact_key", "provider_id") == [(1, "P7"), (2, "S3"), (4, "P7")]


def test_supplier_id_is_the_newest_in_force(spark):
    span = {"effective_start_date_key": 20200101, "effective_end_date_key": 20240101}
    ids = [(1, "old", span), (2, "new", span), (3, "late", span | {"effective_end_date_key": 20230615})]
    wh = warehouse(
        spark,
        all_claim_fact=[CLAIM | {"supplier_key": 3}],
        all_supplier_history_fact=[FOREVER | {
            "supplier_key": 3, "supplier_history_fact_key": 30, "supplier_status": "A"}],
        supplier_other_id=[
            {"supplier_other_id_key": k, "supplier_history_fact_key": 30, "id_type_key": 1,
             "identification_number": n} | s for k, n, s in ids],
        id_type_code=[{"id_type_key": 1, "id_type_code": "1C"}],
    )
    assert values(provider.supplier_other_id(wh["all_claim_fact"], wh), "medicare_provider_id") == [("new",)]


def member_row(**more):
    return FOREVER | {"member_key": 5, "member_history_fact_key": 50, "member_status": "A",
                      "endor_exp_date": dt.datetime(9999, 12, 31)} | more


def test_member_version_bounds_status_and_endorsement(spark):
    wh = warehouse(
        spark,
        all_claim_fact=[CLAIM | {"member_key": 5}, CLAIM | {
            "claim_fact_key": 2, "member_key": 5, "statement_start_date_key": None}],
        all_member_version_hist_fact=[
            member_row(member_history_fact_key=1, version_eff_date_key=20230615),
            member_row(member_history_fact_key=2, version_exp_date_key=20230615),
            member_row(member_history_fact_key=3, member_status=None),
            member_row(member_history_fact_key=4, member_status="v"),
            member_row(member_history_fact_key=5, deleted_flag="y"),
            member_row(member_history_fact_key=6, endor_exp_date=dt.datetime(2019, 1, 1)),
        ],
    )
    rows = member.member_details(wh["all_claim_fact"], wh, AS_OF)
    assert values(rows, "claim_fact_key", "member_history_fact_key") == [(1, 1)]


def test_prior_claim_needs_an_adjusted_claim_and_a_live_prior(spark):
    prior = {"previous_final_claim_fact_key": 8}
    wh = warehouse(
        spark,
        all_claim_fact=[
            CLAIM | {"claim_fact_key": 8, "claim_hcc_id": "OLD"},
            CLAIM | {"claim_fact_key": 9, "claim_hcc_id": "GONE", "deleted_flag": "Y"},
            CLAIM | prior | {"is_adjusted": "Y"},
            CLAIM | prior | {"claim_fact_key": 2},
            CLAIM | {"claim_fact_key": 3, "is_adjusted": "Y", "previous_final_claim_fact_key": 9},
        ],
    )
    rows = header.claim_details(wh, "PAYER")
    assert values(rows, "claim_fact_key", "claim_id_orig") == [(1, "OLD"), (2, ""), (3, ""), (8, "")]


def hicn_warehouse(spark):
    return warehouse(
        spark,
        all_claim_fact=[CLAIM | {"member_key": 5, "most_recent_process_date_key": 20230701}],
        medicare_hicn_info_fact=[
            {"member_key": 5, "mbi": "M1"}, {"member_key": 5, "hicn": "H1", "deleted_flag": "y"}],
        date_dimension=[
            {"date_key": 20230701, "date_value": dt.date(2023, 7, 1), "deleted_flag": "Y"}],
    )


def test_deleted_medicare_row_repeats_the_claim_and_blanks_the_date(spark):
    rows = header.claim_details(hicn_warehouse(spark), "PAYER")
    assert values(rows, "sub_medicare_id", "date_adjudicated") == [
        ("H1", None), ("M1", dt.date(2023, 7, 1))]


def test_one_medicare_row_per_member_on_request(spark):
    once = HeaderOptions(one_id_row_per_member=True)
    rows = header.claim_details(hicn_warehouse(spark), "PAYER", options=once)
    assert values(rows, "sub_medicare_id", "date_adjudicated") == [("M1", dt.date(2023, 7, 1))]


def wide_warehouse(spark, npi="1234567890"):
    return warehouse(
        spark,
        all_claim_fact=[
            CLAIM | {"attending_practitioner_key": 7, "type_of_bill_code": "110", "member_key": 5},
            CLAIM | {"claim_fact_key": 2, "claim_type_name": "professional", "supplier_key": 3},
            CLAIM | {"claim_fact_key": 3, "claim_type_name": "Dental"},
        ],
        all_practitioner_history_fact=[FOREVER | {
            "practitioner_key": 7, "practitioner_status": "A", "practitioner_npi": npi}],
        all_member_version_hist_fact=[member_row(member_mailing_address_key=4, tax_id="1-2")],
        postal_address=[{"postal_address_key": 4, "zip_4_code": "123456"}],
        all_supplier_history_fact=[FOREVER | {
            "supplier_key": 3, "supplier_status": "A", "primary_classification_key": 1}],
        provider_taxonomy=[{"provider_taxonomy_key": 1, "provider_taxonomy_code": "261QA1903X"}],
        claim_fact_to_diagnosis=[
            {"claim_fact_key": 2, "diagnosis_code": "D1", "sort_order": n} for n in (2, 10)],
        diagnosis=[{"diagnosis_code": "D1", "standardized_diagnosis_code": "A<1"}],
    )


def test_wide_tables_keep_nulls_defaults_and_widths(spark):
    build = build_claims(wide_warehouse(spark), "PAYER", options=BuildOptions(as_of=AS_OF))
    row = accepted(build.institutional).first().asDict()
    assert len(row) == 532
    assert (row["BILL_TYPE"], row["CLAIM_TYPE"]) == ("0110", "110")
    assert (row["CLAIM_DOS_FROM"], row["ADMIT_DATE"]) == (dt.date(1900, 1, 1), None)
    assert (row["PATIENT_ZIP_PLUS_4"], row["PATIENT_SSN"]) == ("1234", "12")
    assert (row["BILLING_NAME"], row["BILLING_PROVIDER_ID"]) == (None, "")
    assert row["OTHER_DIAGNOSIS_LIST"] is None and row["CLAIM_PAID_DATE"] is None
    assert (row["CONDITION_CODE_3"], row["VALUE_AMOUNT_3"], row["SUB_SEVERITY"]) == ("", None, None)
    assert row["RENDERING_NPI"] == Decimal(1234567890)
    row = accepted(build.professional).first().asDict()
    assert len(row) == 157
    assert row["CLAIM_TYPE"] == "A"
    assert row["DIAGNOSIS_CODE_LIST"].startswith(
        "<DIAGNOSIS_LIST><DIAGNOSIS><DIAGNOSIS_QUAL>0</DIAGNOSIS_QUAL>"
        "<STANDARDIZED_DIAGNOSIS_CODE>A&lt;1</STANDARDIZED_DIAGNOSIS_CODE>"
        "<SORT_ORDER>10</SORT_ORDER></DIAGNOSIS>")


def test_blank_npi_is_set_aside_not_lost(spark):
    build = build_claims(wide_warehouse(spark, npi=""), "PAYER", options=BuildOptions(as_of=AS_OF))
    assert accepted(build.institutional).count() == 0
    assert values(rejected(build.institutional), "CLAIM_ID", "reject_reason") == [("H1", "RENDERING_NPI")]


@pytest.mark.parametrize("keys", [[1], [2, 3], []])
def test_claim_keys_restrict_the_build(spark, keys):
    chosen = spark.createDataFrame([(k,) for k in keys], "claim_fact_key long")
    build = build_claims(wide_warehouse(spark), "PAYER", chosen, BuildOptions(as_of=AS_OF))
    assert values(build.header, "claim_fact_key") == [(k,) for k in keys]
    assert build.institutional.count() == (1 in keys)
    assert build.professional.count() == (2 in keys)


def test_lists_become_slots_of_the_staged_claim(spark):
    wh = wide_warehouse(spark)
    build = build_claims(wh, "PAYER", options=BuildOptions(as_of=AS_OF))
    diagnoses = clinical.claim_diagnosis(build.header, wh)
    arrays = clinical.professional_diagnosis_array(diagnoses)
    staged = stage_claims(accepted(build.professional), arrays, "professional", dt.datetime(2023, 1, 1))
    row = staged.first().asDict()
    assert (row["DIAGNOSIS_CODE_1"], row["DIAGNOSIS_CODE_2"], row["DIAGNOSIS_CODE_3"]) == ("A<1", "A<1", None)
    assert (row["SEQ_NO"], row["CREATED_DATE"]) == (2, dt.datetime(2023, 1, 1))
    assert len([c for g in bridge.INSTITUTIONAL_SLOTS for c in g.columns()]) == 186


def test_row_parity_repeats_professional_rows(spark):
    wh = wide_warehouse(spark)
    plain = build_claims(wh, "PAYER", options=BuildOptions(as_of=AS_OF, row_parity=False))
    full = build_claims(wh, "PAYER", options=BuildOptions(as_of=AS_OF))
    assert values(plain.professional) == values(full.professional)
    assert plain.professional.agg(F.count("*")).first()[0] == 1


def test_row_parity_counts_overlapping_versions(spark):
    tables = dict(wide_warehouse(spark))
    more = warehouse(
        spark,
        all_claim_fact=[
            CLAIM | {"claim_fact_key": 2, "claim_type_name": "professional", "supplier_key": 3, "submitted_drg_key": 9},
            CLAIM | {"claim_fact_key": 4, "claim_type_name": "Professional", "supplier_key": 3},
        ],
        drg_history_fact=[FOREVER | {"drg_key": 9, "drg_code": c, "drg_status": "A"} for c in "xyz"],
        all_claim_line_fact=[{"claim_fact_key": 2, "claim_line_fact_key": 1, "practitioner_key": 7}],
        all_practitioner_history_fact=[
            FOREVER | {"practitioner_key": 7, "practitioner_status": "A", "practitioner_npi": "1"}] * 2,
        all_supplier_history_fact=[FOREVER | {"supplier_key": 3, "supplier_status": "A"}] * 2,
    )
    wh = Warehouse.from_frames(tables | dict(more))
    build = build_claims(wh, "PAYER", options=BuildOptions(as_of=AS_OF))
    # claim 2: 2 billing rows, 3 DRG rows, 2 practitioner rows; claim 4: 2 billing rows, twice as rendering
    counts = build.professional.groupBy("CLAIM_FACT_KEY").count()
    assert values(counts) == [(Decimal(2), 12), (Decimal(4), 4)]


def test_time_cells_do_not_change_a_build(spark, monkeypatch):
    plain = wide_warehouse(spark)
    wanted, got = [], []
    for found, many, bytes_ in ((wanted, 256, 1 << 40), (got, 0, 0)):
        monkeypatch.setattr(joins, "MANY_VERSIONS", many)
        monkeypatch.setattr(warehouse_module, "LARGE_HISTORY", bytes_)
        build = build_claims(Warehouse.from_frames(dict(plain)), "PAYER", options=BuildOptions(as_of=AS_OF))
        found += [values(build.institutional), values(build.professional)]
    assert got == wanted


def test_wide_table_is_written_by_claim_type(spark, tmp_path):
    build = build_claims(wide_warehouse(spark), "PAYER", options=BuildOptions(as_of=AS_OF))
    path = str(tmp_path / "claims")
    write_claims(accepted(build.institutional), path)
    back = spark.read.parquet(path)
    assert values(back, "CLAIM_TYPE_NAME", "CLAIM_FACT_KEY") == [("INSTITUTIONAL", Decimal(1))]
    assert len(back.columns) == 532


def test_professional_claims_with_more_diagnoses_than_slots_are_listed(spark, monkeypatch):
    from claimweave.checks import queries

    many = spark.createDataFrame([(1, ["x"] * 26), (2, ["x"] * 24)], "claim_fact_key long, diagnosis array<string>")
    monkeypatch.setattr(queries, "plain_arrays", lambda wh: many)
    found = queries.queries()["slot_overflow_by_kind"](spark, "/root/testdata/sf0.001").where("kind = 'PROFESSIONAL'")
    assert values(found) == [(1, "diagnosis", 26, 2, "PROFESSIONAL")]
