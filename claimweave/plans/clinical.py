"""Diagnoses, procedures, DRG codes and payment dates of claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions import (
    NEVER_DATE,
    filled,
    left_n,
    not_deleted,
    one_of,
    poa_code,
    xml_list,
    yyyymmdd,
)
from claimweave.operators.joins import asof_join, lookup_join
from claimweave.operators.keys import only_keys
from claimweave.operators.lists import ordered_list
from claimweave.sources import Warehouse

# Fixed values.
PAID_STATUSES = ("3", "7")
CODE_QUALIFIER = "0"
EXTERNAL_CAUSE = "E"
REASON_FOR_VISIT = "R"

DIAGNOSIS_TAGS = ("DIAGNOSIS_QUAL", "STANDARDIZED_DIAGNOSIS_CODE", "DIAGNOSIS_POA_INDICATOR_CODE")
PLAIN_DIAGNOSIS_TAGS = ("DIAGNOSIS_QUAL", "STANDARDIZED_DIAGNOSIS_CODE")
PROCEDURE_TAGS = ("PROCEDURE_QUAL", "PROCEDURE_CODE", "PROCEDURE_CODE_DATE")


def for_claims(facts: DataFrame, claims: DataFrame) -> DataFrame:
    """Fact rows of the given claim rows; a claim present twice doubles its facts."""
    return claims.select("claim_fact_key").join(facts, "claim_fact_key")


def claim_diagnosis(
    claims: DataFrame, wh: Warehouse, claim_keys: DataFrame | None = None
) -> DataFrame:
    """Live diagnoses of each claim with the standard code and the POA letter."""
    rows = lookup_join(
        only_keys(wh.live("claim_fact_to_diagnosis"), claim_keys), wh.codes("diagnosis"), ("diagnosis_code", "diagnosis_code"),
        [left_n(F.col("standardized_diagnosis_code"), 7).alias("_standard")], how="inner",
    )
    rows = lookup_join(
        rows, wh.codes("diagnosis_poa_indicator_code"), ("poa_indicator", "diagnosis_poa_indicator_key"),
        [poa_code(F.col("diagnosis_poa_indicator_code")).alias("_poa")],
    )
    return for_claims(
        rows.select(
            "claim_fact_key",
            "diagnosis_code",
            F.col("_standard").alias("standardized_diagnosis_code"),
            F.col("_poa").alias("diagnosis_poa_indicator_code"),
            F.col("sort_order").cast("string").alias("sort_order"),
            left_n(F.col("claim_diagnosis_type"), 1).alias("claim_diagnosis_type"),
        ),
        claims,
    )


def claim_procedure(
    claims: DataFrame, wh: Warehouse, claim_keys: DataFrame | None = None
) -> DataFrame:
    """Live procedures of each claim; a missing date becomes 1900-01-01."""
    rows = lookup_join(
        only_keys(wh.live("claim_fact_to_procedure_code"), claim_keys), wh.codes("date_dimension"),
        ("procedure_date_key", "date_key"), [F.col("date_value").alias("_date")],
    )
    return for_claims(
        rows.select(
            "claim_fact_key",
            left_n(F.col("procedure_code"), 7).alias("procedure_code"),
            yyyymmdd(F.coalesce("_date", F.lit(NEVER_DATE))).alias("procedure_code_date"),
            F.col("sort_order").cast("string").alias("sort_order"),
        ),
        claims,
    )


def diagnosis_fields(with_poa: bool = True) -> list[Column]:
    fields = [F.lit(CODE_QUALIFIER), F.col("standardized_diagnosis_code")]
    return fields + [F.col("diagnosis_poa_indicator_code")] if with_poa else fields


def diagnosis_arrays(diagnoses: DataFrame) -> DataFrame:
    """All three institutional lists of a claim in one pass over its diagnoses."""
    order = F.col("sort_order")
    kind = F.upper("claim_diagnosis_type")

    def renumbered(code: str) -> Column:
        return ordered_list(
            diagnosis_fields(), DIAGNOSIS_TAGS, order, only=kind == code, renumber=True
        )

    return diagnoses.groupBy("claim_fact_key").agg(
        ordered_list(
            [*diagnosis_fields(), order], (*DIAGNOSIS_TAGS, "SORT_ORDER"), order
        ).alias("other_diagnosis"),
        renumbered(EXTERNAL_CAUSE).alias("external_cause"),
        renumbered(REASON_FOR_VISIT).alias("reason_for_visit"),
    )


def diagnosis_lists(arrays: DataFrame) -> DataFrame:
    """Text form of the three institutional diagnosis lists."""
    tags = (*DIAGNOSIS_TAGS, "SORT_ORDER")
    return arrays.select(
        "claim_fact_key",
        xml_list(F.col("other_diagnosis"), tags, "OTHER_DIAGNOSIS", "OTHER_DIAGNOSIS_LIST").alias(
            "other_diagnosis_list"
        ),
        xml_list(
            F.col("external_cause"), tags, "DIAGNOSIS", "EXTERNAL_CAUSE_OF_INJURY_LIST"
        ).alias("external_cause_of_injury_list"),
        xml_list(
            F.col("reason_for_visit"), tags, "DIAGNOSIS", "PATIENTS_REASON_FOR_VISIT_LIST"
        ).alias("patients_reason_for_visit_list"),
    )


def professional_diagnosis_array(diagnoses: DataFrame) -> DataFrame:
    order = F.col("sort_order")
    return diagnoses.groupBy("claim_fact_key").agg(
        ordered_list(
            [*diagnosis_fields(with_poa=False), order], (*PLAIN_DIAGNOSIS_TAGS, "SORT_ORDER"), order
        ).alias("diagnosis")
    )


def professional_diagnosis_list(arrays: DataFrame) -> DataFrame:
    tags = (*PLAIN_DIAGNOSIS_TAGS, "SORT_ORDER")
    return arrays.select(
        "claim_fact_key",
        xml_list(F.col("diagnosis"), tags, "DIAGNOSIS", "DIAGNOSIS_LIST").alias(
            "diagnosis_code_list"
        ),
    )


def procedure_array(procedures: DataFrame) -> DataFrame:
    order = F.col("sort_order")
    fields = [F.lit(CODE_QUALIFIER), F.col("procedure_code"), F.col("procedure_code_date"), order]
    return procedures.groupBy("claim_fact_key").agg(
        ordered_list(fields, (*PROCEDURE_TAGS, "SORT_ORDER"), order).alias("other_procedure")
    )


def procedure_list(arrays: DataFrame) -> DataFrame:
    tags = (*PROCEDURE_TAGS, "SORT_ORDER")
    return arrays.select(
        "claim_fact_key",
        xml_list(F.col("other_procedure"), tags, "PROCEDURE", "OTHER_PROCEDURE_LIST").alias(
            "other_procedure_list"
        ),
    )


def claim_drg(claims: DataFrame, wh: Warehouse) -> DataFrame:
    """Submitted and calculated DRG codes in force; rows with neither code drop out."""
    rows = claims.select(
        "claim_fact_key", "statement_start_date_key", "submitted_drg_key", "calculated_drg_key"
    )
    for key, name in (("submitted_drg_key", "sub_drg"), ("calculated_drg_key", "allowed_drg")):
        rows = asof_join(
            rows, wh["drg_history_fact"], (key, "drg_key"), [F.col("drg_code").alias(name)],
            how="left", status="drg_status", by_time=wh.large("drg_history_fact"),
        )
    return rows.filter(filled(F.col("sub_drg")) | filled(F.col("allowed_drg"))).select(
        "claim_fact_key", "sub_drg", "allowed_drg"
    )


def latest_payment(wh: Warehouse, claim_keys: DataFrame | None = None) -> DataFrame:
    """Date of the newest payment link of each claim.

    The newest link wins even where its payment is not paid or deleted; the date is then empty.
    Links are reduced to one key per claim before payments are joined.
    """
    links = only_keys(wh.live("payment_fact_to_claim_fact"), claim_keys)
    newest = links.groupBy("claim_fact_key").agg(F.max("payment_fact_key").alias("_newest"))
    paid = wh["payment_fact"].filter(
        one_of(F.col("payment_status_code"), PAID_STATUSES) & not_deleted(F.col("deleted_flag"))
    ).drop("deleted_flag")
    dated = lookup_join(
        paid, wh.codes("date_dimension"), ("payment_date_key", "date_key"), ["date_value"]
    )
    dates = dated.groupBy("payment_fact_key").agg(F.max("date_value").alias("claim_paid_date"))
    return newest.join(dates, newest["_newest"] == dates["payment_fact_key"], "left").select(
        "claim_fact_key", "claim_paid_date"
    )
