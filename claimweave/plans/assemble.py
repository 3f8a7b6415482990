"""Assembly of the two wide claim tables from the builders' results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions import (
    NEVER_DATE,
    claim_type_from_taxonomy,
    left_n,
    or_empty,
    pad_bill_type,
    presence_qualifier,
    same_text,
    strip_dashes,
)
from claimweave.operators.stage import stage, stage_together
from claimweave.plans import clinical, provider
from claimweave.plans.amounts import LINE_AMOUNTS, claim_amounts
from claimweave.plans.header import HeaderOptions, claim_details, selected_claims
from claimweave.plans.layouts import LAYOUTS, LayoutColumn
from claimweave.plans.member import member_details, member_other_id
from claimweave.plans.naming import names
from claimweave.sources import Warehouse

# Output columns that repeat the patient's value under the subscriber's name.
SUBSCRIBER_COPIES = {
    "SUB_ADDRESS_1": "patient_address_1",
    "SUB_ADDDRESS_2": "patient_address_2",
    "SUB_CITY": "patient_city",
    "SUB_STATE": "patient_state",
    "SUB_ZIP": "patient_zip",
    "SUB_ZIP_PLUS_4": "patient_zip_plus_4",
    "SUB_COUNTRY": "patient_country",
    "SUB_GENDER_ID": "patient_gender_id",
}
# Columns written as they are, and columns whose missing value becomes an empty text.
AS_IS = (
    "claim_fact_key payer_short patient_dob patient_death_date admit_date discharge_date "
    "date_received_client cv_us_only_yn endorsement_eff_time is_adjusted_claim is_voided"
).split()
OR_EMPTY = (
    "claim_id sub_id patient_gender_id patient_id patient_control_number patient_last_name "
    "patient_first_name patient_middle_name patient_name_suffix relationship_to_sub "
    "sub_medicare_id assignment_of_benefits claim_id_orig group_id group_name sub_last_name "
    "sub_first_name sub_middle_name sub_name_suffix patient_address_1 patient_address_2 "
    "patient_city patient_state patient_zip patient_zip_plus_4 patient_country"
).split()
AMOUNTS = (*LINE_AMOUNTS, "claim_patient_liability_amount")
REJECT_REASON = "reject_reason"
Rows = Callable[[DataFrame, Warehouse, "BuildOptions", DataFrame | None], DataFrame]


@dataclass(frozen=True)
class BuildOptions:
    """``as_of`` fixes the endorsement test, else the time of the run counts. ``row_parity`` keeps
    joins that add no column but repeat a claim where a versioned source overlaps."""

    as_of: dt.datetime | None = None
    header: HeaderOptions = field(default_factory=HeaderOptions)
    row_parity: bool = True


def shared_values() -> dict[str, Column]:
    """Columns both tables fill in the same way."""
    values = {name.upper(): F.col(name) for name in (*AS_IS, *AMOUNTS)}
    values |= {name.upper(): or_empty(F.col(name)) for name in OR_EMPTY}
    values |= {name: or_empty(F.col(source)) for name, source in SUBSCRIBER_COPIES.items()}
    ssn = strip_dashes(or_empty(F.col("patient_ssn")))
    return values | {
        "CLAIM_TYPE_NAME": or_empty(F.upper("claim_type_name")),
        "PATIENT_SSN": ssn,
        "SUB_SSN": ssn,
        "SUB_DOB": F.col("patient_dob"),
    }


def rendering_values() -> dict[str, Column]:
    """Rendering columns: empty where absent, save the NPI; the tax group falls back to billing."""
    plain = [c for c in provider.PROVIDER_COLUMNS if c not in ("npi", "taxgroup_id")]
    values = {f"RENDERING_{c}".upper(): or_empty(F.col(f"rendering_{c}")) for c in plain}
    return values | {
        "RENDERING_NPI": F.col("rendering_npi"),
        "RENDERING_TAXGROUP_ID": F.coalesce("rendering_taxgroup_id", "billing_taxgroup_id"),
        "RENDERING_TAXONOMY_CODE": or_empty(F.col("rendering_subspec_id")),
    }


def billing_values() -> dict[str, Column]:
    """Billing columns; name and address stay NULL where the claim has no supplier row."""
    renamed = {"name": "last_name", "address_1": "street_address_1", "address_2": "street_address_2"}
    same = {c: c for c in ("entity_type", "city", "state", "zip", "zip_plus_4", "country")}
    values = {
        f"BILLING_{name}".upper(): F.col(f"billing_{source}")
        for name, source in (renamed | same).items()
    }
    taxonomy = or_empty(F.col("billing_subspec_id"))
    return values | {
        "BILLING_PROVIDER_ID": or_empty(F.col("billing_provider_id")),
        "BILLING_TAXGROUP_ID": strip_dashes(or_empty(F.col("billing_taxgroup_id"))),
        "BILLING_SUBSPEC_ID": taxonomy,
        "BILLING_TAXONOMY_CODE": taxonomy,
    }


def referring_values() -> dict[str, Column]:
    parts = ("provider_id", "npi", "subspec_id", *provider.NAME_PARTS)
    values = {f"REFERRING_{p}".upper(): F.col(f"referring_{p}") for p in parts}
    return values | {"REFERRING_TAXONOMY_CODE": F.col("referring_subspec_id")}


def institutional_values() -> dict[str, Column]:
    coded = {
        name.upper(): or_empty(F.col(name))
        for name in ("principal_diagnosis", "admitting_diagnosis", "principal_procedure")
    }
    qualifiers = {
        f"{name}_QUAL": presence_qualifier(F.col(name.lower())) for name in coded
    }
    lists = names(
        "OTHER_DIAGNOSIS_LIST EXTERNAL_CAUSE_OF_INJURY_LIST PATIENTS_REASON_FOR_VISIT_LIST "
        "OTHER_PROCEDURE_LIST"
    )
    return (
        shared_values() | rendering_values() | billing_values() | referring_values()
        | coded | qualifiers
        | {name: F.col(name.lower()) for name in lists}
        | {
            name: or_empty(F.col(name.lower()))
            for name in ("DISCHARGE_STATUS", "SUB_DRG", "ALLOWED_DRG", "MEDICARE_PROVIDER_ID")
        }
        | {
            "CLAIM_TYPE": F.col("bill_type"),
            "BILL_TYPE": pad_bill_type(F.col("bill_type")),
            "CLAIM_DOS_FROM": F.coalesce("claim_dos_from", F.lit(NEVER_DATE)),
            "CLAIM_DOS_TO": F.coalesce("claim_dos_to", F.lit(NEVER_DATE)),
            "PRINCIPAL_DIAGNOSIS_POA": F.col("principal_diagnosis_poa"),
            "PRINCIPAL_PROCEDURE_DATE": F.col("principal_procedure_date"),
            "LENGTH_OF_STAY": F.col("length_of_stay"),
            "DATE_ADJUDICATED": F.col("date_adjudicated"),
        }
    )


def professional_values() -> dict[str, Column]:
    return shared_values() | {
        "CLAIM_TYPE": claim_type_from_taxonomy(F.col("billing_subspec_id")),
        "DIAGNOSIS_CODE_LIST": F.col("diagnosis_code_list"),
        "CLAIM_PAID_DATE": F.col("claim_paid_date"),
    }


def typed(column: LayoutColumn, value: Column) -> Column:
    """Fit a value to its column: cut text to the width, read numbers without failing the job."""
    if column.is_decimal:
        return value.try_cast(column.kind)
    if column.width is not None:
        return left_n(value.cast("string"), column.width)
    return value.cast(column.kind)


def reject_reason(layout: tuple[LayoutColumn, ...], values: Mapping[str, Column]) -> Column:
    """Names of the number columns whose value does not fit; NULL for a sound row."""
    faults = [
        F.when(
            values[c.name].isNotNull() & values[c.name].try_cast(c.kind).isNull(), F.lit(c.name)
        )
        for c in layout
        if c.is_decimal and c.name in values
    ]
    listed = F.concat_ws(",", *faults)
    return F.when(listed != "", listed)


def lay_out(rows: DataFrame, kind: str, values: Mapping[str, Column]) -> DataFrame:
    """One select to the declared columns, defaults included, plus the reject reason."""
    layout = LAYOUTS[kind]
    unfilled = {(c.default, c.kind) for c in layout if c.name not in values}
    defaults = {key: F.lit(key[0]).cast(key[1]) for key in unfilled}
    filled = [
        typed(c, values[c.name]) if c.name in values else defaults[c.default, c.kind]
        for c in layout
    ]
    return rows.select(
        *(column.alias(c.name) for c, column in zip(layout, filled, strict=True)),
        reject_reason(layout, values).alias(REJECT_REASON),
    )


def _of_kind(kind: str) -> Column:
    return same_text(F.col("claim_type_name"), kind)


def star(claims: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Left join every part on the claim key; one shuffle of each side serves all the joins."""
    for part in parts:
        claims = claims.join(part, "claim_fact_key", "left")
    return claims


def referring_columns(referring: DataFrame) -> DataFrame:
    parts = ("provider_id", "npi", "subspec_id", *provider.NAME_PARTS)
    return referring.select(
        "claim_fact_key", *(F.col(p).alias(f"referring_{p}") for p in parts)
    )


def institutional_rows(
    claims: DataFrame, wh: Warehouse, options: BuildOptions, claim_keys: DataFrame | None
) -> DataFrame:
    """Join everything an institutional claim needs; parts with one row per claim come first.

    Members and suppliers are staged: each history is met once, and the parts made from its rows
    (alternate ids, the rendering provider's fallback) read the staged table.
    """
    facts = selected_claims(wh, claim_keys).filter(_of_kind(provider.INSTITUTIONAL))
    scalars = provider.claim_scalars(facts)
    kept = ("supplier_history_fact_key", "statement_start_date_key")
    members, billing = stage_together(
        members=member_details(claims, wh, options.as_of),
        suppliers=provider.billing_provider(scalars, wh, kept),
    )
    rendering = provider.rendering_provider(
        provider.rendering_key(scalars), billing.drop(*kept), wh
    )
    referring = provider.referring_provider(scalars, wh)
    diagnoses = clinical.diagnosis_arrays(clinical.claim_diagnosis(claims, wh, claim_keys))
    procedures = clinical.procedure_array(clinical.claim_procedure(claims, wh, claim_keys))
    return star(
        claims,
        [
            claim_amounts(claims, wh, claim_keys),
            clinical.diagnosis_lists(diagnoses),
            clinical.procedure_list(procedures),
            clinical.claim_drg(claims, wh),
            members.drop("statement_start_date_key", "member_history_fact_key"),
            member_other_id(members, wh).drop("member_history_fact_key"),
            provider.with_role(billing, "billing"),
            provider.with_role(rendering, "rendering"),
            provider.newest_supplier_id(billing, wh).drop("supplier_history_fact_key"),
            referring_columns(referring),
        ],
    )


def professional_rows(
    claims: DataFrame, wh: Warehouse, options: BuildOptions, claim_keys: DataFrame | None
) -> DataFrame:
    """Join everything a professional claim needs; DRG and rendering only repeat rows.

    What has one row per claim is joined and staged before the wide rows meet it, the amounts alone
    before that, so that no job holds the shuffles and sort buffers of all parts at once.
    """
    facts = selected_claims(wh, claim_keys).filter(_of_kind(provider.PROFESSIONAL))
    scalars = provider.claim_scalars(facts)
    members = stage(member_details(claims, wh, options.as_of), "members")
    billing = provider.billing_provider(scalars, wh)
    diagnoses = clinical.professional_diagnosis_array(clinical.claim_diagnosis(claims, wh, claim_keys))
    once = [
        stage(claim_amounts(claims, wh, claim_keys), "amounts"),
        clinical.latest_payment(wh, claim_keys),
        clinical.professional_diagnosis_list(diagnoses),
    ]
    if options.row_parity:
        first = provider.first_line_practitioner(wh, claim_keys)
        codes = clinical.claim_drg(claims, wh).groupBy("claim_fact_key").agg(F.count(F.lit(1)).alias("_drgs"))
        once += [codes, provider.rendering_copies(provider.rendering_key(scalars, first), wh)]
    per_claim = Window.partitionBy("claim_fact_key")
    rows = star(
        claims,
        [
            stage(star(claims.select("claim_fact_key").distinct(), once), "parts"),
            members.drop("statement_start_date_key", "member_history_fact_key"),
            member_other_id(members, wh).drop("member_history_fact_key"),
            billing.select(
                "claim_fact_key", F.col("subspec_id").alias("billing_subspec_id"),
                F.count(F.lit(1)).over(per_claim).alias("_billings"),
            ),
        ],
    )
    return repeated(rows) if options.row_parity else rows


def repeated(rows: DataFrame) -> DataFrame:
    """Rows as often as left joins with DRG codes and rendering providers would repeat them.

    Both parts come as a number per claim: the rows of its DRG codes, and the versions of its
    rendering practitioner or, where none is known, the rows of its billing supplier.
    """
    versions = F.when(F.col("_known"), F.col("_versions")).when(F.col("_supplied"), F.col("_billings"))

    def at_least_one(n: Column) -> Column:
        return F.greatest(F.coalesce(n, F.lit(1)), F.lit(1))

    copies = (at_least_one(F.col("_drgs")) * at_least_one(versions)).cast("int")
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).drop(
        "_copy", "_drgs", "_known", "_supplied", "_versions"
    )


def accepted(rows: DataFrame) -> DataFrame:
    """Rows whose numbers all fit their columns."""
    return rows.filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON)


def rejected(rows: DataFrame) -> DataFrame:
    """Keys and reasons of the rows left out of the wide table."""
    return rows.filter(F.col(REJECT_REASON).isNotNull()).select(
        "CLAIM_FACT_KEY", "CLAIM_ID", "CLAIM_TYPE_NAME", REJECT_REASON
    )


@dataclass(frozen=True)
class ClaimBuild:
    """The header and the wide tables with their reject reasons, each planned on first use.

    What is read by many branches is staged: the header of all claims, or of a table's claims alone
    where only the table is asked for.
    """

    warehouse: Warehouse
    payer_short: str
    options: BuildOptions
    claim_keys: DataFrame | None

    @cached_property
    def header(self) -> DataFrame:
        return self._header("header")

    @cached_property
    def institutional(self) -> DataFrame:
        return self._table(provider.INSTITUTIONAL, institutional_rows, institutional_values())

    @cached_property
    def professional(self) -> DataFrame:
        return self._table(provider.PROFESSIONAL, professional_rows, professional_values())

    def _header(self, label: str, kind: str | None = None) -> DataFrame:
        return stage(
            claim_details(self.warehouse, self.payer_short, self.claim_keys, self.options.header, kind), label
        )

    def _table(self, kind: str, rows: Rows, values: Mapping[str, Column]) -> DataFrame:
        staged = "header" in self.__dict__
        mine = self.header.filter(_of_kind(kind)) if staged else self._header(f"header-{kind.lower()}", kind)
        return lay_out(rows(mine, self.warehouse, self.options, self.claim_keys), kind, values)


def build_claims(
    wh: Warehouse,
    payer_short: str,
    claim_keys: DataFrame | None = None,
    options: BuildOptions = BuildOptions(),
) -> ClaimBuild:
    """Wide claim tables for all live claims, or for those in ``claim_keys``.

    The keys are materialised once and restrict every fact table. Claims of other types get a header
    row only. Split a result with ``accepted`` and ``rejected``.
    """
    if claim_keys is not None:
        claim_keys = stage(claim_keys.select("claim_fact_key").distinct(), "keys")
    return ClaimBuild(wh, payer_short, options, claim_keys)
