"""One registered query per operator, each over the whole sample tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions import (
    claim_type_from_taxonomy,
    left_n,
    not_deleted,
    not_in_workbasket,
    number_or_null,
    number_text,
    or_empty,
    pad_bill_type,
    poa_code,
    presence_qualifier,
    strip_dashes,
    yyyymmdd,
)
from claimweave.operators import (
    asof_join,
    audit_passed,
    drop_superseded_lines,
    in_slice,
    in_window,
    lookup_join,
    of_type,
)
from claimweave.operators.records import join_runs, render_runs
from claimweave.operators.stage import new_folder
from claimweave.plans import bridge, clinical, header, member, provider
from claimweave.plans.amounts import MONEY, claim_amounts
from claimweave.plans.assemble import BuildOptions, accepted, build_claims, rejected
from claimweave.plans.extract import (
    extract_records,
    lookup_copies,
    record_pipe_count,
    translate_bill_type,
)
from claimweave.plans.records import Field
from claimweave.plans.outcomes import ACCEPTED, REJECTED, read_outcome, write_outcomes
from claimweave.sources import Staging, Warehouse
from claimweave.sources.sample import SampleViews, sample_staging, sample_warehouse
from claimweave.sources.sinks import publish_records, read_published, write_staging

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.datetime(2020, 1, 1)
PAYER = "PAYER"
WINDOW = (dt.datetime(1996, 2, 29), dt.datetime(2000, 12, 31))
SLICE = (10, 1_000_000_000)
OPTIONS = BuildOptions(as_of=AS_OF)

QUERIES: dict[str, Query] = {}


def on_warehouse(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a query that needs the warehouse tables only."""
    QUERIES[build.__name__] = lambda spark, folder: build(sample_warehouse(spark, folder))
    return build


def on_spark(build: Query) -> Query:
    """Register a query as it stands."""
    QUERIES[build.__name__] = build
    return build


def on_views(build: Callable[[SampleViews], DataFrame]) -> Callable[[SampleViews], DataFrame]:
    """Register a query that reads staged, audit or lookup views."""
    QUERIES[build.__name__] = lambda spark, folder: build(SampleViews(spark, folder))
    return build


def claims_of(wh: Warehouse) -> DataFrame:
    return header.claim_details(wh, PAYER)


def rows_of(wh: Warehouse) -> DataFrame:
    return header.claim_rows(wh)


def scalars_of(wh: Warehouse) -> DataFrame:
    return provider.claim_scalars(header.selected_claims(wh))


# Filters.


@on_warehouse
def soft_delete_filter(wh):
    claims = wh["all_claim_fact"].select("claim_fact_key", "deleted_flag")
    return claims.filter(not_deleted(F.col("deleted_flag")))


@on_warehouse
def status_not_in(wh):
    members = wh["all_member_version_hist_fact"]
    return members.select("member_history_fact_key", "member_status").filter(
        not_in_workbasket(F.col("member_status"))
    )


@on_views
def audit_gate(views):
    return audit_passed(views["audit"]).select("claim_number", "extract_status")


@on_views
def extract_window(views):
    claims = views["claims_professional"].select("claim_fact_key", "seq_no", "created_date")
    return claims.filter(in_window("created_date", *WINDOW) & in_slice("seq_no", *SLICE))


@on_warehouse
def claim_type_filter(wh):
    claims = wh["all_claim_fact"].filter(of_type("claim_type_name", "professional"))
    return claims.select("claim_fact_key", F.upper("claim_type_name").alias("claim_type_name"))


# Scalar rules.


@on_warehouse
def null_default(wh):
    return wh["all_member_version_hist_fact"].select(
        "member_history_fact_key",
        or_empty(F.col("member_middle_name")).alias("middle_name"),
        or_empty(F.col("subscriber_middle_name")).alias("subscriber_middle_name"),
        or_empty(F.col("member_gender_code")).alias("gender"),
    )


@on_warehouse
def coalesce_ids(wh):
    return wh["medicare_hicn_info_fact"].select(
        "member_key", "hicn", F.coalesce("mbi", "hicn").alias("medicare_id")
    )


@on_warehouse
def fixed_width_trim(wh):
    return wh["all_claim_fact"].select(
        "claim_fact_key",
        left_n(F.col("patient_account_number"), 24).alias("control_number"),
        left_n(F.col("type_of_bill_code"), 2).alias("bill_prefix"),
        left_n(F.col("benefit_assignment"), 1).alias("assignment"),
    )


@on_warehouse
def strip_dashes_in_ids(wh):
    return wh["all_member_version_hist_fact"].select(
        "member_history_fact_key", strip_dashes(F.col("tax_id")).alias("ssn")
    )


QUERIES["strip_dashes"] = QUERIES.pop("strip_dashes_in_ids")


@on_warehouse
def date_112(wh):
    return wh["all_claim_fact"].select(
        "claim_fact_key", yyyymmdd(F.col("endorsement_eff_time")).alias("day_text")
    )


@on_warehouse
def number_to_text(wh):
    return wh["all_claim_line_fact"].select(
        "claim_line_fact_key",
        number_text(F.col("billed_amount")).alias("billed_text"),
        number_text(F.col("claim_fact_key")).alias("key_text"),
        number_text(F.col("base_copay_amount")).alias("copay_text"),
    )


@on_warehouse
def npi_cast(wh):
    npi = left_n(F.col("practitioner_npi"), 10)
    number = number_or_null(npi, 10)
    return wh["all_practitioner_history_fact"].select(
        "practitioner_key",
        "version_eff_date_key",
        number.alias("npi"),
        F.when(npi.isNotNull() & number.isNull(), F.lit("not a number")).alias("fault"),
    )


@on_warehouse
def bill_type_pad(wh):
    return wh["all_claim_fact"].select(
        "claim_fact_key", pad_bill_type(F.col("type_of_bill_code")).alias("bill_type")
    )


@on_warehouse
def poa_normalise(wh):
    codes = wh["diagnosis_poa_indicator_code"].drop("deleted_flag")
    claims = wh["all_claim_fact"].select("claim_fact_key", "primary_diagnosis_poa_ind_key")
    joined = claims.join(
        codes,
        claims["primary_diagnosis_poa_ind_key"] == codes["diagnosis_poa_indicator_key"],
        "left",
    )
    return joined.select(
        "claim_fact_key", poa_code(F.col("diagnosis_poa_indicator_code")).alias("poa")
    )


@on_warehouse
def presence_flag(wh):
    code = F.col("principal_procedure_code")
    return wh["all_claim_fact"].select(
        "claim_fact_key", presence_qualifier(code).alias("procedure_qual")
    )


QUERIES["presence_qualifier"] = QUERIES.pop("presence_flag")


@on_warehouse
def claim_type_of_billing(wh):
    billing = provider.billing_provider(scalars_of(wh), wh)
    return billing.select(
        "claim_fact_key", claim_type_from_taxonomy(F.col("subspec_id")).alias("claim_type")
    )


QUERIES["claim_type_from_taxonomy"] = QUERIES.pop("claim_type_of_billing")


# Joins.


@on_warehouse
def filtered_left_join(wh):
    claims = wh["all_claim_fact"].select("claim_fact_key", "primary_diagnosis_code")
    return lookup_join(
        claims, wh["diagnosis"], ("primary_diagnosis_code", "diagnosis_code"),
        ["standardized_diagnosis_code"],
    ).select("claim_fact_key", "standardized_diagnosis_code")


@on_warehouse
def date_roles(wh):
    facts = header.date_roles(header.selected_claims(wh), wh, header.DATE_ROLES)
    return facts.select("claim_fact_key", *header.DATE_ROLES)


@on_warehouse
def prior_claim_id(wh):
    facts = header.selected_claims(wh).select("claim_fact_key", "previous_final_claim_fact_key")
    return header.prior_claim(facts, wh).select("claim_fact_key", F.col("_prior_id").alias("prior_id"))


@on_warehouse
def conditional_date_join(wh):
    facts = header.add_medicare_id(header.selected_claims(wh), wh, header.HeaderOptions())
    return facts.select("claim_fact_key", "sub_medicare_id", "date_adjudicated")


@on_warehouse
def asof_left_join(wh):
    claims = wh["all_claim_fact"].select(
        "claim_fact_key", "submitted_drg_key", "statement_start_date_key"
    )
    return asof_join(
        claims, wh["drg_history_fact"], ("submitted_drg_key", "drg_key"), ["drg_code"],
        how="left", status="drg_status",
    ).select("claim_fact_key", "drg_code")


@on_warehouse
def asof_inner_join(wh):
    claims = wh["all_claim_fact"].select("claim_fact_key", "member_key", "statement_start_date_key")
    return asof_join(
        claims, wh["all_member_version_hist_fact"], ("member_key", "member_key"),
        ["member_history_fact_key"], status="member_status",
    ).select("claim_fact_key", "member_history_fact_key")


@on_warehouse
def claim_drg(wh):
    return clinical.claim_drg(rows_of(wh), wh)


@on_warehouse
def split_line_anti_join(wh):
    kept = drop_superseded_lines(wh["all_claim_line_fact"])
    return kept.select("claim_fact_key", "claim_line_fact_key")


# Picks and sums.


@on_warehouse
def line_totals(wh):
    sums = claim_amounts(rows_of(wh), wh)
    return sums.select(
        "claim_fact_key", *(F.col(c).cast(MONEY).alias(c) for c in sums.columns if c != "claim_fact_key")
    )


QUERIES["claim_amounts"] = QUERIES.pop("line_totals")


@on_warehouse
def latest_payment(wh):
    return clinical.latest_payment(wh)


@on_warehouse
def first_line_practitioner(wh):
    return provider.first_line_practitioner(wh)


@on_warehouse
def supplier_other_id(wh):
    return provider.supplier_other_id(rows_of(wh), wh)


@on_warehouse
def member_other_id(wh):
    return member.member_other_id(member.member_details(rows_of(wh), wh, AS_OF), wh)


# Providers.


@on_warehouse
def billing_provider(wh):
    return provider.billing_provider(scalars_of(wh), wh)


@on_warehouse
def referring_provider(wh):
    return provider.referring_provider(scalars_of(wh), wh)


@on_warehouse
def rendering_provider(wh):
    scalars = scalars_of(wh)
    keyed = provider.rendering_key(scalars, provider.first_line_practitioner(wh))
    return provider.rendering_provider(keyed, provider.billing_provider(scalars, wh), wh)


# Diagnoses, procedures and lists.


@on_warehouse
def claim_diagnosis(wh):
    return clinical.claim_diagnosis(rows_of(wh), wh)


@on_warehouse
def claim_procedure(wh):
    return clinical.claim_procedure(rows_of(wh), wh)


def diagnosis_arrays(wh: Warehouse) -> DataFrame:
    return clinical.diagnosis_arrays(clinical.claim_diagnosis(rows_of(wh), wh))


def diagnosis_list(wh: Warehouse, name: str) -> DataFrame:
    lists = clinical.diagnosis_lists(diagnosis_arrays(wh))
    return lists.select("claim_fact_key", name).filter(F.col(name).isNotNull())


@on_warehouse
def other_diagnosis_list(wh):
    return diagnosis_list(wh, "other_diagnosis_list")


@on_warehouse
def external_cause_list(wh):
    return diagnosis_list(wh, "external_cause_of_injury_list")


@on_warehouse
def reason_for_visit_list(wh):
    return diagnosis_list(wh, "patients_reason_for_visit_list")


def procedure_arrays(wh: Warehouse) -> DataFrame:
    return clinical.procedure_array(clinical.claim_procedure(rows_of(wh), wh))


@on_warehouse
def procedure_list(wh):
    return clinical.procedure_list(procedure_arrays(wh))


def plain_arrays(wh: Warehouse) -> DataFrame:
    return clinical.professional_diagnosis_array(clinical.claim_diagnosis(rows_of(wh), wh))


@on_warehouse
def professional_diagnosis_list(wh):
    return clinical.professional_diagnosis_list(plain_arrays(wh))


@on_warehouse
def list_renumber(wh):
    entries = diagnosis_arrays(wh).select("claim_fact_key", F.inline("external_cause"))
    return entries.select(
        "claim_fact_key",
        F.col("SORT_ORDER").alias("position"),
        F.col("STANDARDIZED_DIAGNOSIS_CODE").alias("code"),
        F.col("DIAGNOSIS_POA_INDICATOR_CODE").alias("poa"),
    )


@on_warehouse
def slots_institutional(wh):
    arrays = diagnosis_arrays(wh).join(procedure_arrays(wh), "claim_fact_key", "full")
    return bridge.slot_columns(arrays, bridge.INSTITUTIONAL_SLOTS)


@on_warehouse
def slots_professional(wh):
    return bridge.slot_columns(plain_arrays(wh), bridge.PROFESSIONAL_SLOTS)


@on_warehouse
def slot_overflow(wh):
    arrays = diagnosis_arrays(wh).join(procedure_arrays(wh), "claim_fact_key", "full")
    return bridge.slot_overflow(arrays, bridge.INSTITUTIONAL_SLOTS)


@on_warehouse
def slot_overflow_by_kind(wh):
    arrays = diagnosis_arrays(wh).join(procedure_arrays(wh), "claim_fact_key", "full")
    institutional = bridge.slot_overflow(arrays, bridge.INSTITUTIONAL_SLOTS)
    professional = bridge.slot_overflow(plain_arrays(wh), bridge.PROFESSIONAL_SLOTS)
    return institutional.withColumn("kind", F.lit("INSTITUTIONAL")).unionByName(
        professional.withColumn("kind", F.lit("PROFESSIONAL"))
    )


# Whole builds.


@on_warehouse
def claim_details(wh):
    return claims_of(wh)


@on_warehouse
def member_details(wh):
    return member.member_details(rows_of(wh), wh, AS_OF).drop("statement_start_date_key")


@on_warehouse
def cds_institutional(wh):
    return accepted(build_claims(wh, PAYER, options=OPTIONS).institutional)


@on_warehouse
def cds_professional(wh):
    return accepted(build_claims(wh, PAYER, options=OPTIONS).professional)


@on_warehouse
def cds_rejected(wh):
    return rejected(build_claims(wh, PAYER, options=OPTIONS).institutional)


@on_warehouse
def cds_rejected_professional(wh):
    return rejected(build_claims(wh, PAYER, options=OPTIONS).professional)


@on_warehouse
def cds_selected(wh):
    """The professional claims that another claim replaces, built by their keys."""
    keys = wh["all_claim_fact"].select(F.col("previous_final_claim_fact_key").alias("claim_fact_key"))
    return accepted(build_claims(wh, PAYER, keys.distinct(), OPTIONS).professional)


@on_warehouse
def claim_copies(wh):
    return header.claim_copies(claims_of(wh))


# Extracts.


@on_views
def bill_type_crosswalk(views):
    claims = views["claims_institutional"].select(
        "claim_fact_key", F.col("BILL_TYPE").alias("bill_type")
    )
    return translate_bill_type(claims, views["lookup"], "translated")


@on_views
def code_copies(views):
    return lookup_copies(views["lookup"])


QUERIES["lookup_copies"] = QUERIES.pop("code_copies")


@on_views
def pipe_record(views):
    fields = [
        Field("claim", "PAYER_SHORT"),
        Field("claim", "CLAIM_TYPE"),
        Field("claim", "PATIENT_DOB", "date"),
        Field("claim", "PATIENT_WEIGHT", "number"),
        Field("claim", "CLAIM_ID"),
    ]
    runs = views["claims_professional"].select("claim_fact_key", *render_runs(fields, "claim"))
    return runs.select("claim_fact_key", join_runs(fields).alias("record"))


def extract(
    kind: str,
    numbers: tuple[int, int] | None = None,
    window: tuple[dt.datetime, dt.datetime] | None = None,
) -> Query:
    return lambda spark, folder: extract_records(
        sample_staging(spark, folder, kind), kind, numbers, window
    )


QUERIES["extract_professional"] = extract("professional")
QUERIES["extract_institutional"] = extract("institutional")


@on_spark
def pipe_count(spark, folder):
    counted = [
        record_pipe_count(sample_staging(spark, folder, kind), kind).withColumn("kind", F.lit(kind))
        for kind in ("INSTITUTIONAL", "PROFESSIONAL")
    ]
    return counted[0].unionByName(counted[1])


QUERIES["record_pipe_count"] = QUERIES.pop("pipe_count")


def built_records(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """From warehouse to records: build, number the lists, stage, extract."""
    wh = sample_warehouse(spark, folder)
    build = build_claims(wh, PAYER, options=OPTIONS)
    diagnoses = clinical.claim_diagnosis(build.header, wh)
    if kind == "professional":
        arrays = clinical.professional_diagnosis_array(diagnoses)
    else:
        procedures = clinical.procedure_array(clinical.claim_procedure(build.header, wh))
        arrays = clinical.diagnosis_arrays(diagnoses).join(procedures, "claim_fact_key", "full")
    staged = bridge.stage_claims(accepted(getattr(build, kind)), arrays, kind, AS_OF)
    staging = replace(sample_staging(spark, folder, kind), claims=staged)
    return extract_records(staging, kind)


@on_spark
def built_records_professional(spark, folder):
    return built_records(spark, folder, "professional")


@on_spark
def built_records_institutional(spark, folder):
    return built_records(spark, folder, "institutional")


QUERIES["extract_slice"] = extract("professional", SLICE, WINDOW)


# Written results.


@on_warehouse
def cds_outcomes(wh):
    """Both outcomes of the professional claims, from one run of the build."""
    rows = build_claims(wh, PAYER, options=OPTIONS).professional
    folder = new_folder(rows.sparkSession, "outcomes")
    write_outcomes(rows, folder)
    kept, left_out = (
        read_outcome(rows.sparkSession, folder, "professional", outcome)
        for outcome in (ACCEPTED, REJECTED)
    )
    return kept.select(
        "CLAIM_FACT_KEY", F.lit(ACCEPTED).alias("outcome"), F.lit(None).cast("string").alias("reject_reason")
    ).unionByName(left_out.select("CLAIM_FACT_KEY", F.lit(REJECTED).alias("outcome"), "reject_reason"))


@on_spark
def extract_laid_out(spark, folder):
    """The slice and window of ``extract_slice`` from staging tables laid out for them."""
    root = new_folder(spark, "staging")
    write_staging(sample_staging(spark, folder, "professional"), root, "professional")
    return extract_records(Staging.from_files(spark, root, "professional"), "professional", SLICE, WINDOW)


@on_spark
def published_slice(spark, folder):
    """The records of ``extract_slice``, published and then published once more, as readers see them."""
    root = new_folder(spark, "published")
    records = QUERIES["extract_slice"](spark, folder)
    for _ in range(2):
        publish_records(records, root, "slice")
    return read_published(spark, root, "slice")


def queries() -> dict[str, Query]:
    return dict(QUERIES)
