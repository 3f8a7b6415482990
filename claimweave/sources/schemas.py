"""Columns of the source tables, typed by naming rule."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The warehouse tables and the columns the pipeline reads from them.
WAREHOUSE_COLUMNS = {
    "all_account_history_fact": (
        "account_key account_hcc_id account_name account_status "
        "version_eff_date_key version_exp_date_key deleted_flag"
    ),
    "all_claim_fact": (
        "claim_fact_key claim_hcc_id claim_type_name patient_account_number type_of_bill_code "
        "discharge_status_code principal_procedure_code benefit_assignment is_adjusted is_voided "
        "submitted_drg_key calculated_drg_key member_key supplier_key location_key "
        "attending_practitioner_key referring_practitioner_key previous_final_claim_fact_key "
        "endorsement_eff_time length_of_stay primary_diagnosis_code primary_diagnosis_poa_ind_key "
        "admit_diagnosis_code principal_procedure_date_key statement_start_date_key "
        "statement_end_date_key admission_date_key discharge_date_key receipt_date_key "
        "most_recent_process_date_key deleted_flag"
    ),
    "all_claim_line_fact": (
        "claim_fact_key claim_line_fact_key claim_line_hcc_id original_line_number is_split "
        "practitioner_key billed_amount base_non_covered_amount base_allowed_amount "
        "base_paid_amount base_coinsurance_amount base_copay_amount base_deductible_amount "
        "deleted_flag"
    ),
    "all_member_version_hist_fact": (
        "member_key member_history_fact_key subscription_hcc_id member_gender_code tax_id "
        "member_last_name member_first_name member_middle_name member_name_suffix "
        "subscriber_last_name subscriber_first_name subscriber_middle_name subscriber_name_suffix "
        "account_key member_mailing_address_key member_birth_date_key member_death_date_key "
        "endor_exp_date member_status version_eff_date_key version_exp_date_key deleted_flag"
    ),
    "all_practitioner_history_fact": (
        "practitioner_key practitioner_hcc_id practitioner_npi practitioner_last_name "
        "practitioner_first_name practitioner_middle_name practitioner_name_suffix tax_id "
        "primary_specialty_key practitioner_corr_addr_key practitioner_status "
        "version_eff_date_key version_exp_date_key deleted_flag"
    ),
    "all_supplier_history_fact": (
        "supplier_key supplier_history_fact_key supplier_hcc_id supplier_npi supplier_name "
        "supplier_corr_address_key primary_classification_key tax_entity_key supplier_status "
        "version_eff_date_key version_exp_date_key deleted_flag"
    ),
    "claim_fact_to_diagnosis": (
        "claim_fact_key diagnosis_code sort_order claim_diagnosis_type poa_indicator deleted_flag"
    ),
    "claim_fact_to_procedure_code": (
        "claim_fact_key procedure_code sort_order procedure_date_key deleted_flag"
    ),
    "date_dimension": "date_key date_value deleted_flag",
    "diagnosis": "diagnosis_code standardized_diagnosis_code deleted_flag",
    "diagnosis_poa_indicator_code": (
        "diagnosis_poa_indicator_key diagnosis_poa_indicator_code deleted_flag"
    ),
    "drg_history_fact": (
        "drg_key drg_code drg_status version_eff_date_key version_exp_date_key deleted_flag"
    ),
    "id_type_code": "id_type_key id_type_code deleted_flag",
    "medicare_hicn_info_fact": "member_key mbi hicn deleted_flag",
    "member_other_id": (
        "member_history_fact_key id_type_key identification_number "
        "effective_start_date_key effective_end_date_key deleted_flag"
    ),
    "payment_fact": "payment_fact_key payment_status_code payment_date_key deleted_flag",
    "payment_fact_to_claim_fact": "claim_fact_key payment_fact_key deleted_flag",
    "postal_address": (
        "postal_address_key address_line address_line_2 city_name state_code zip_code zip_4_code "
        "country_code deleted_flag"
    ),
    "provider_taxonomy": "provider_taxonomy_key provider_taxonomy_code deleted_flag",
    "supplier_other_id": (
        "supplier_other_id_key supplier_history_fact_key id_type_key identification_number "
        "effective_start_date_key effective_end_date_key deleted_flag"
    ),
    "tax_entity_history_fact": (
        "tax_entity_key tax_id tax_entity_status version_eff_date_key version_exp_date_key "
        "deleted_flag"
    ),
}

STAGING_TABLES = ("audit", "claims_professional", "lines_professional", "claims_institutional",
                  "lines_institutional", "lookup")

EXACT_TYPES = {
    "date_key": "int",
    "date_value": "date",
    "endor_exp_date": "timestamp_ntz",
    "endorsement_eff_time": "timestamp_ntz",
    "length_of_stay": "int",
    "poa_indicator": "bigint",
    "sort_order": "int",
}
SUFFIX_TYPES = (("_date_key", "int"), ("_key", "bigint"), ("_amount", "decimal(19,2)"))


def column_type(name: str) -> str:
    """Type of a warehouse column: exact name first, then suffix, then text."""
    if name in EXACT_TYPES:
        return EXACT_TYPES[name]
    return next((kind for suffix, kind in SUFFIX_TYPES if name.endswith(suffix)), "string")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns of ``table`` with their declared types.

    A cast that changes nothing is removed by the optimizer, so filters still reach the scan.
    """
    names = WAREHOUSE_COLUMNS[table].split()
    return df.selectExpr(*(f"cast({n} as {column_type(n)}) as {n}" for n in names))
