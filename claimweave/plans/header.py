"""Claim header: one claim fact with its codes, dates, prior claim and Medicare id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions import left_n, not_deleted, poa_code, same_text
from claimweave.operators.joins import lookup_join, spread_null_join
from claimweave.operators.keys import only_keys
from claimweave.plans.columns import HEADER_TEXT, text_columns
from claimweave.sources import Warehouse

# Date roles of a claim: output column and the fact column that holds its date key.
DATE_ROLES = {
    "principal_procedure_date": "principal_procedure_date_key",
    "claim_dos_from": "statement_start_date_key",
    "claim_dos_to": "statement_end_date_key",
    "admit_date": "admission_date_key",
    "discharge_date": "discharge_date_key",
    "date_received_client": "receipt_date_key",
}
PLAIN_COLUMNS = (
    "claim_type_name claim_fact_key submitted_drg_key calculated_drg_key member_key supplier_key "
    "location_key attending_practitioner_key referring_practitioner_key endorsement_eff_time "
    "is_voided statement_start_date_key length_of_stay"
).split()

# What the parts of a claim are joined on.
ROW_KEYS = (
    "claim_fact_key claim_type_name member_key supplier_key statement_start_date_key "
    "submitted_drg_key calculated_drg_key"
).split()


@dataclass(frozen=True)
class HeaderOptions:
    """``one_id_row_per_member`` keeps one Medicare id row per member instead of one claim row per
    id row; the default repeats the claim, as the stored source data implies."""

    one_id_row_per_member: bool = False


def selected_claims(wh: Warehouse, claim_keys: DataFrame | None = None) -> DataFrame:
    """Live claim facts, all of them or those named by ``claim_keys``."""
    return only_keys(wh.live("all_claim_fact"), claim_keys)


def prior_claim(facts: DataFrame, wh: Warehouse) -> DataFrame:
    """Add the id of the previous version of a claim; most claims have none."""
    previous = wh.live("all_claim_fact").select(
        F.col("claim_fact_key").alias("_prior_key"),
        F.col("claim_hcc_id").alias("_prior_id"),
    )
    return spread_null_join(
        facts, previous, ("previous_final_claim_fact_key", "_prior_key"), "claim_fact_key"
    )


def date_roles(facts: DataFrame, wh: Warehouse, roles: dict[str, str]) -> DataFrame:
    """Resolve each date key through the date dimension, once per role."""
    for name, key in roles.items():
        facts = lookup_join(
            facts, wh.codes("date_dimension"), (key, "date_key"), [F.col("date_value").alias(name)]
        )
    return facts


def medicare_ids(wh: Warehouse, options: HeaderOptions) -> DataFrame:
    """Medicare id rows per member, deleted rows included: they still carry the id."""
    ids = wh["medicare_hicn_info_fact"].select(
        F.col("member_key").alias("_member"),
        left_n(F.coalesce("mbi", "hicn"), 25).alias("sub_medicare_id"),
        not_deleted(F.col("deleted_flag")).alias("_id_live"),
    )
    if not options.one_id_row_per_member:
        return ids
    best = F.max(F.struct("_id_live", "sub_medicare_id")).alias("best")
    return ids.groupBy("_member").agg(best).select("_member", "best.*")


def add_medicare_id(facts: DataFrame, wh: Warehouse, options: HeaderOptions) -> DataFrame:
    """Add the Medicare id and the adjudication date.

    The date depends on the id row: a deleted id row leaves it empty.
    """
    ids = medicare_ids(wh, options)
    joined = spread_null_join(facts, ids, ("member_key", "_member"), "claim_fact_key")
    return lookup_join(
        joined,
        _undeleted_view(wh),
        ("most_recent_process_date_key", "date_key"),
        [F.col("date_value").alias("date_adjudicated")],
        when=F.coalesce(F.col("_id_live"), F.lit(True)),
    )


def _undeleted_view(wh: Warehouse) -> DataFrame:
    """The date dimension with every row counted as live: this role never tests the flag."""
    return wh.codes("date_dimension").withColumn("deleted_flag", F.lit(None).cast("string"))


def claim_details(
    wh: Warehouse,
    payer_short: str,
    claim_keys: DataFrame | None = None,
    options: HeaderOptions = HeaderOptions(),
    claim_type: str | None = None,
) -> DataFrame:
    """The claim header, of one type of claims or all; one row per claim and Medicare id row of its member."""
    facts = selected_claims(wh, claim_keys)
    if claim_type is not None:
        facts = facts.filter(same_text(F.col("claim_type_name"), claim_type))
    diagnosis = wh.codes("diagnosis")
    standard = F.col("standardized_diagnosis_code")
    facts = lookup_join(
        facts, diagnosis, ("primary_diagnosis_code", "diagnosis_code"),
        [left_n(standard, 7).alias("principal_diagnosis")],
    )
    facts = lookup_join(
        facts, diagnosis, ("admit_diagnosis_code", "diagnosis_code"),
        [left_n(standard, 7).alias("admitting_diagnosis")],
    )
    facts = lookup_join(
        facts, wh.codes("diagnosis_poa_indicator_code"),
        ("primary_diagnosis_poa_ind_key", "diagnosis_poa_indicator_key"),
        [poa_code(F.col("diagnosis_poa_indicator_code")).alias("principal_diagnosis_poa")],
    )
    facts = date_roles(facts, wh, DATE_ROLES)
    facts = prior_claim(facts, wh)
    facts = add_medicare_id(facts, wh, options)
    prior_id = F.when(
        same_text(F.col("is_adjusted"), "Y"), F.coalesce(left_n(F.col("_prior_id"), 25), F.lit(""))
    ).otherwise(F.lit(""))
    return facts.select(
        *PLAIN_COLUMNS,
        F.lit(payer_short).alias("payer_short"),
        *text_columns(HEADER_TEXT),
        prior_id.alias("claim_id_orig"),
        "principal_diagnosis",
        "principal_diagnosis_poa",
        "admitting_diagnosis",
        *DATE_ROLES,
        F.lit("Y").alias("cv_us_only_yn"),
        "sub_medicare_id",
        "date_adjudicated",
    )


def claim_rows(
    wh: Warehouse,
    claim_keys: DataFrame | None = None,
    options: HeaderOptions = HeaderOptions(),
) -> DataFrame:
    """The header's rows with their keys only, for parts that are wanted without a header.

    One row per claim and Medicare id row of its member, as in ``claim_details``, without the joins for
    codes, dates and the prior claim, each of which adds a column and no row where its table's key is unique.
    """
    facts = selected_claims(wh, claim_keys).select(*ROW_KEYS)
    ids = medicare_ids(wh, options).select("_member")
    return spread_null_join(facts, ids, ("member_key", "_member"), "claim_fact_key")


def claim_copies(header: DataFrame) -> DataFrame:
    """claim_fact_key, copies of the claims with several header rows, as several id rows make them."""
    counts = header.groupBy("claim_fact_key").agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter("copies > 1")
