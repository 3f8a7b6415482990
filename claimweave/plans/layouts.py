"""The two wide claim tables: column order, types, widths and defaults.

Order is stated by name groups. Types follow from the name: an exact entry first, then the longest
matching suffix. Columns the pipeline does not fill get an empty text, or NULL for other types.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from claimweave.plans.naming import (
    address,
    adjustments,
    names,
    numbered,
    person,
    phones,
    prefixed,
    region,
)

# Column order of the institutional table.
INSTITUTIONAL_NAMES = names(
    "CLAIM_TYPE_NAME CLAIM_ID CLAIM_FACT_KEY CLAIM_TYPE PAYER_SHORT SUB_ID DEP_ID PATIENT_DOB",
    "PATIENT_GENDER_ID PATIENT_SSN PATIENT_ID PATIENT_CONTROL_NUMBER",
    person("PATIENT"),
    "RELATIONSHIP_TO_SUB PROVIDER_CLAIM_ID MED_REC_NO BILL_TYPE",
    numbered(1, 24, "CONDITION_CODE_#"),
    numbered(1, 24, "VALUE_CODE_# VALUE_AMOUNT_#"),
    "CLAIM_DOS_FROM CLAIM_DOS_TO",
    prefixed("ADMIT", "DATE TIME_HH TIME_MM TYPE SOURCE_CODE"),
    prefixed("DISCHARGE", "DATE TIME_HH TIME_MM STATUS"),
    "SUB_DRG SUB_SEVERITY ALLOWED_DRG ALLOWED_SEVERITY DRG_INLIER_AMOUNT DRG_OUTLIER_AMOUNT",
    "GROUPER_ID REGULATORY_STATE",
    "PRINCIPAL_DIAGNOSIS_QUAL PRINCIPAL_DIAGNOSIS PRINCIPAL_DIAGNOSIS_POA OTHER_DIAGNOSIS_LIST",
    "ADMITTING_DIAGNOSIS_QUAL ADMITTING_DIAGNOSIS",
    "EXTERNAL_CAUSE_OF_INJURY_LIST PATIENTS_REASON_FOR_VISIT_LIST",
    "PRINCIPAL_PROCEDURE_QUAL PRINCIPAL_PROCEDURE PRINCIPAL_PROCEDURE_DATE OTHER_PROCEDURE_LIST",
    "AUTH_NO_A AUTH_NO_B AUTH_NO_C",
    prefixed("RENDERING", "PROVIDER_ID TAXGROUP_ID NPI STATE_LICENSE SUBSPEC_ID ENTITY_TYPE"),
    person("RENDERING"),
    "RENDERING_STREET_ADDRESS_1 RENDERING_STREET_ADDRESS_2",
    region("RENDERING"),
    phones("RENDERING"),
    prefixed(
        "BILLING",
        "PROVIDER_ID TAXGROUP_ID STATE_LICENSE SUBSPEC_ID CURRENCY_CODE ENTITY_TYPE NAME",
    ),
    address("BILLING"),
    "BILLING_CONTACT",
    phones("BILLING"),
    prefixed("CLAIM", "BILLED_AMOUNT NONCOVERED_AMOUNT ALLOWED_AMOUNT PAID_AMOUNT PAID_DATE"),
    "DRG_PAYABLE_YN ASSIGNMENT_OF_BENEFITS PRIOR_PAYMENTS AUDIT_BYPASS_CODE",
    "DATE_RECEIVED_CLIENT DATE_ADJUDICATED CLAIM_APPROVED_BY LETTER_PLAN_CODE CLAIM_ID_ORIG",
    "GROUP_ID GROUP_NAME RISK_POOL CLAIM_DENIAL_RSN_CD MORTALITY_RISK BIRTH_WEIGHT",
    "ALC_DAYS ALC_AMOUNT PAYER_NAME",
    address("PAYER"),
    "CLAIM_FILING_INDICATOR",
    person("SUB"),
    "SUB_ADDRESS_1 SUB_ADDDRESS_2",
    region("SUB"),
    "SUB_DOB SUB_GENDER_ID SUB_SSN",
    address("PATIENT"),
    "PAY_TO_ENTITY_TYPE PAY_TO_NAME",
    address("PAY_TO"),
    [
        name
        for role in ("ATTENDING", "OPERATING", "OTHER_OPERATING")
        for name in names(
            prefixed(role, "PROVIDER_ID TAXGROUP_ID NPI STATE_LICENSE SUBSPEC_ID ENTITY_TYPE"),
            person(role),
        )
    ],
    prefixed(
        "REFERRING", "PCP_YN PROVIDER_ID TAXGROUP_ID NPI STATE_LICENSE SUBSPEC_ID ENTITY_TYPE"
    ),
    person("REFERRING"),
    "PATIENT_STATUS_CODE CLAIM_ATTACHMENT_TYPE_CODE CLAIM_ATTACHMENT_TRANSMIT_CODE CLAIM_ACN",
    "PATIENT_RESP_AMOUNT AUTH_EXCEPTION_CODE REFERRAL_ID PRO_AUTH_ID",
    "CLAIM_NOTE_REF_CODE CLAIM_NOTE_TEXT EPSDT_REFERRAL_YN",
    numbered(1, 3, "EPSDT_COND_INDICATOR_#"),
    numbered(1, 24, "OCCUR_SPAN_CODE_# OCCUR_SPAN_FROM_# OCCUR_SPAN_TO_#"),
    numbered(1, 24, "OCCUR_CODE_# OCCUR_DATE_#"),
    numbered(1, 10, "ATTACHMENT_TYPE_CODE_# ATTACHMENT_TRANSMIT_CODE_# ACN_#"),
    adjustments("CLAIM_"),
    "CV_US_ONLY_YN",
    numbered(1, 3, "CLAIM_CDF_TEXT_#"),
    "CHECK_NUM CLAIM_FEE_SCHEDULE_AMOUNT CLAIM_REIMBURSE_TYPE PATIENT_PLAN_CODE",
    "PER_CASE_RATE_AMOUNT PER_DIEM_RATE_AMOUNT PER_DIEM_WEIGHTED_AMOUNT CLIENT_PLATFORM",
    "SUB_MEDICARE_ID MEDICAID_ID PATIENT_DEATH_DATE LENGTH_OF_STAY GROUPER_VERSION",
    "BLUE_CARD_INDICATOR",
    prefixed("ITS", "HOME_STATE HOST_STATE SERIAL_NUM"),
    "MEDICARE_PROVIDER_ID MEDICAID_PROVIDER_ID RENDERING_TAXONOMY_CODE BILLING_TAXONOMY_CODE",
    prefixed(
        "CLAIM",
        "COINSURANCE_AMOUNT COPAY_AMOUNT DEDUCTIBLE_AMOUNT DISALLOWED_AMOUNT "
        "PATIENT_LIABILITY_AMOUNT",
    ),
    prefixed(
        "CLAIM_COB",
        "AMOUNT ALLOWED_AMOUNT COINSURANCE_AMOUNT PAID_AMOUNT DEDUCT_AMOUNT",
    ),
    "CLAIM_CHECK_PAID_DATE PAID_TO_CODE PAYMENT_STATUS CLAIM_CAPITATION_INDICATOR",
    "CLAIM_FEE_SCHEDULE_CODE WHOLE_CLAIM_PRICING_LINE_YN OTHER_INSURANCE_INDICATOR",
    "COORDINATED_BENEFITS_YN RETIRED_INDICATOR",
    [f"{r}_TAXONOMY_CODE" for r in ("ATTENDING", "OPERATING", "OTHER_OPERATING", "REFERRING")],
    "DOCUMENT_CONTROL_NUMBER CLAIM_ADJUSTMENT_NUMBER DATA_SOURCE PAPER_INDICATOR",
    "CIT_RESTRICTED_ID ENDORSEMENT_EFF_TIME IS_ADJUSTED_CLAIM IS_VOIDED",
)

# Column order of the professional table.
PROFESSIONAL_NAMES = names(
    "CLAIM_TYPE_NAME CLAIM_ID CLAIM_FACT_KEY CLAIM_TYPE PAYER_SHORT SUB_ID DEP_ID PATIENT_DOB",
    "PATIENT_GENDER_ID PATIENT_SSN PATIENT_ID PATIENT_CONTROL_NUMBER",
    person("PATIENT"),
    "RELATIONSHIP_TO_SUB PATIENT_DEATH_DATE PATIENT_WEIGHT PREGNANCY_INDICATOR_YN MED_REC_NO",
    "DIAGNOSIS_CODE_LIST DATE_RECEIVED_CLIENT ASSIGNMENT_OF_BENEFITS",
    prefixed("CLAIM", "BILLED_AMOUNT NONCOVERED_AMOUNT ALLOWED_AMOUNT PAID_AMOUNT PAID_DATE"),
    "CLAIM_ID_ORIG GROUP_ID RISK_POOL CLAIM_FILING_INDICATOR",
    person("SUB"),
    "SUB_ADDRESS_1 SUB_ADDDRESS_2",
    region("SUB"),
    "SUB_DOB SUB_GENDER_ID SUB_SSN",
    address("PATIENT"),
    "CLAIM_ATTACHMENT_TYPE_CODE CLAIM_ATTACHMENT_TRANSMIT_CODE CLAIM_ACN",
    "AUTH_EXCEPTION_CODE REFERRAL_ID AUTH_NO_A CLAIM_NOTE_REF_CODE CLAIM_NOTE_TEXT",
    "MEDICARE_CROSSOVER_INDICATOR_YN EPSDT_REFERRAL_YN",
    numbered(1, 3, "EPSDT_CONDITION_CODE_#"),
    "EPSDT_INDICATOR_YN",
    numbered(1, 2, "ANESTHESIA_RELATED_SURG_HCPCS_#"),
    "ONSET_CURRENT_ILLNESS INITIAL_TREATMENT_DATE LAST_SEEN_DATE ACUTE_MANISFESTATION_DATE",
    "ACCIDENT_DATE LMP_DATE ADMIT_DATE DISCHARGE_DATE ASSUMED_CARE_DATE RELINQUISHED_CARE_DATE",
    "CLAIM_FREQUENCY_CODE",
    adjustments("CLAIM_"),
    "CV_US_ONLY_YN",
    numbered(1, 3, "CLAIM_CDF_TEXT_#"),
    "GROUP_NAME CHIRO_LAST_XRAY_DATE FORM_ID_CODE FORM_ID SUB_MEDICARE_ID MEDICAID_ID",
    "BLUE_CARD_INDICATOR",
    prefixed("ITS", "HOME_STATE HOST_STATE SERIAL_NUM"),
    prefixed(
        "CLAIM",
        "COINSURANCE_AMOUNT COPAY_AMOUNT DEDUCTIBLE_AMOUNT DISALLOWED_AMOUNT "
        "PATIENT_LIABILITY_AMOUNT",
    ),
    prefixed(
        "CLAIM_COB",
        "AMOUNT ALLOWED_AMOUNT COINSURANCE_AMOUNT PAID_AMOUNT DEDUCT_AMOUNT",
    ),
    "CLAIM_CHECK_PAID_DATE PAID_TO_CODE PAYMENT_STATUS CLAIM_CAPITATION_INDICATOR",
    "CLAIM_FEE_SCHEDULE_CODE PATIENT_PLAN_CODE WHOLE_CLAIM_PRICING_LINE_YN",
    "OTHER_INSURANCE_INDICATOR COORDINATED_BENEFITS_YN RETIRED_INDICATOR",
    "DOCUMENT_CONTROL_NUMBER CLAIM_ADJUSTMENT_NUMBER CHECK_NUM PLATFORM_CODE DATA_SOURCE",
    "PAPER_INDICATOR CIT_RESTRICTED_ID ENDORSEMENT_EFF_TIME IS_ADJUSTED_CLAIM IS_VOIDED",
)

# Types by name ending; the longest ending that matches wins.
# A number is a text width, "p,s" is a decimal, "max" is unbounded text.
SUFFIX_TYPES = {
    # dates, times and money
    "_DATE": "date", "_DOB": "date", "_AMOUNT": "19,2", "_TIME_HH": "2,0", "_TIME_MM": "2,0",
    "_NPI": "10,0", "_LIST": "max",
    # people and places
    "_LAST_NAME": 60, "_FIRST_NAME": 35, "_MIDDLE_NAME": 25, "_NAME_SUFFIX": 10,
    "_ADDRESS_1": 55, "_ADDRESS_2": 55, "_CITY": 30, "_STATE": 2, "_ZIP": 5, "_ZIP_PLUS_4": 4,
    "_COUNTRY": 3, "_COUNTRY_SUBDIVISION": 3, "_PHONE_COUNTRY_CODE": 5, "_FAX_COUNTRY_CODE": 5,
    "_PHONE": 10, "_PHONE_EXT": 6, "_FAX": 10, "_GENDER_ID": 10, "_SSN": 9,
    # providers
    "_PROVIDER_ID": 25, "_TAXGROUP_ID": 9, "_STATE_LICENSE": 10, "_SUBSPEC_ID": 10,
    "_ENTITY_TYPE": 1, "_TAXONOMY_CODE": 50,
    # codes and flags
    "_YN": 1, "_INDICATOR": 1, "_QUAL": 1, "_DIAGNOSIS": 7, "_PROCEDURE": 7, "_POA": 1,
    "_TYPE_CODE": 2, "_TRANSMIT_CODE": 2, "_SEVERITY": 2, "_DRG": 5, "_NOTE_TEXT": 80, "_REF_CODE": 3,
}
# Types of single names; ``#`` stands for any number.
EXACT_TYPES = {
    "CLAIM_TYPE_NAME": 20, "CLAIM_ID": 25, "CLAIM_FACT_KEY": "19,0", "CLAIM_TYPE": 20,
    "PAYER_SHORT": 5, "SUB_ID": 25, "DEP_ID": 10, "PATIENT_ID": 20, "PATIENT_CONTROL_NUMBER": 24,
    "RELATIONSHIP_TO_SUB": 2, "PROVIDER_CLAIM_ID": 25, "MED_REC_NO": 24, "BILL_TYPE": 4,
    "CONDITION_CODE_#": 2, "VALUE_CODE_#": 2, "VALUE_AMOUNT_#": "19,2",
    "CLAIM_DOS_FROM": "date", "CLAIM_DOS_TO": "date", "ADMIT_TYPE": 1, "ADMIT_SOURCE_CODE": 1,
    "DISCHARGE_STATUS": 2, "GROUPER_ID": 30, "REGULATORY_STATE": 3,
    "AUTH_NO_A": 30, "AUTH_NO_B": 30, "AUTH_NO_C": 30, "BILLING_CURRENCY_CODE": 3,
    "BILLING_NAME": 255, "BILLING_ADDRESS_1": 255, "BILLING_ADDRESS_2": 255, "BILLING_CITY": 50,
    "BILLING_CONTACT": 60, "ASSIGNMENT_OF_BENEFITS": 1, "PRIOR_PAYMENTS": "19,2",
    "AUDIT_BYPASS_CODE": "20,0", "DATE_RECEIVED_CLIENT": "date", "DATE_ADJUDICATED": "date",
    "CLAIM_APPROVED_BY": 15, "LETTER_PLAN_CODE": 6, "CLAIM_ID_ORIG": 25, "GROUP_ID": 15,
    "GROUP_NAME": 60, "RISK_POOL": 60, "CLAIM_DENIAL_RSN_CD": 10, "MORTALITY_RISK": 2,
    "BIRTH_WEIGHT": "6,0", "ALC_DAYS": "4,0", "PAYER_NAME": 60, "PAYER_ZIP": 10,
    "CLAIM_FILING_INDICATOR": 2, "SUB_ADDDRESS_2": 55, "PATIENT_ZIP": 10, "PAY_TO_NAME": 60,
    "PATIENT_STATUS_CODE": 2, "CLAIM_ACN": 80, "AUTH_EXCEPTION_CODE": 4, "REFERRAL_ID": 30,
    "PRO_AUTH_ID": 24, "EPSDT_COND_INDICATOR_#": 3, "OCCUR_SPAN_CODE_#": 2,
    "OCCUR_SPAN_FROM_#": "date", "OCCUR_SPAN_TO_#": "date", "OCCUR_CODE_#": 2,
    "OCCUR_DATE_#": "date", "ATTACHMENT_TYPE_CODE_#": 2, "ATTACHMENT_TRANSMIT_CODE_#": 2,
    "ACN_#": 24, "CLAIM_ADJ_CODE_#": 10, "CLAIM_ADJ_TYPE_#": 2, "CLAIM_ADJUSTOR_ID_#": 20,
    "CLAIM_CDF_TEXT_#": 32, "CHECK_NUM": 25, "CLAIM_REIMBURSE_TYPE": 20, "PATIENT_PLAN_CODE": 20,
    "CLIENT_PLATFORM": 20, "PLATFORM_CODE": 20, "DATA_SOURCE": 20, "SUB_MEDICARE_ID": 25,
    "MEDICAID_ID": 25, "LENGTH_OF_STAY": "4,0", "GROUPER_VERSION": 5, "ITS_SERIAL_NUM": 20,
    "MEDICARE_PROVIDER_ID": 80, "MEDICAID_PROVIDER_ID": 80, "CLAIM_DISALLOWED_AMOUNT": "10,2",
    "CLAIM_PATIENT_LIABILITY_AMOUNT": "10,2", "PAID_TO_CODE": 1, "PAYMENT_STATUS": 20,
    "CLAIM_FEE_SCHEDULE_CODE": 25, "DOCUMENT_CONTROL_NUMBER": 20, "CLAIM_ADJUSTMENT_NUMBER": 1,
    "CIT_RESTRICTED_ID": 25, "ENDORSEMENT_EFF_TIME": "timestamp_ntz", "IS_ADJUSTED_CLAIM": 10,
    "IS_VOIDED": 10, "PATIENT_WEIGHT": "6,0", "EPSDT_CONDITION_CODE_#": 3,
    "ANESTHESIA_RELATED_SURG_HCPCS_#": 5, "ONSET_CURRENT_ILLNESS": "date",
    "CLAIM_FREQUENCY_CODE": 1, "FORM_ID_CODE": 3, "FORM_ID": 30,
}
# Where one table differs from the rules above.
INSTITUTIONAL_TYPES = {"CLAIM_CDF_TEXT_1": 31}
PROFESSIONAL_TYPES = {"CLAIM_TYPE": 1, "SUB_MEDICARE_ID": 50, "PATIENT_ZIP": 5}
# Unfilled text columns that hold NULL instead of an empty text.
NULL_TEXT = ("SUB_SEVERITY", "ALLOWED_SEVERITY")


@dataclass(frozen=True)
class LayoutColumn:
    """One column of a wide table. ``width`` is set for bounded text only."""

    name: str
    kind: str
    width: int | None = None

    @property
    def default(self) -> str | None:
        """Value of the column where the pipeline does not fill it."""
        return "" if self.kind == "string" and self.name not in NULL_TEXT else None

    @property
    def is_decimal(self) -> bool:
        return self.kind.startswith("decimal")


def _declared(name: str, special: dict[str, str | int]) -> str | int:
    shape = re.sub(r"_\d+$", "_#", name)
    for table in (special, EXACT_TYPES):
        if name in table or shape in table:
            return table.get(name, table.get(shape))
    ending = max((s for s in SUFFIX_TYPES if name.endswith(s)), key=len)
    return SUFFIX_TYPES[ending]


def _column(name: str, special: dict[str, str | int]) -> LayoutColumn:
    declared = _declared(name, special)
    if isinstance(declared, int):
        return LayoutColumn(name, "string", declared)
    if declared == "max":
        return LayoutColumn(name, "string")
    return LayoutColumn(name, f"decimal({declared})" if "," in declared else declared)


INSTITUTIONAL = tuple(_column(n, INSTITUTIONAL_TYPES) for n in INSTITUTIONAL_NAMES)
PROFESSIONAL = tuple(_column(n, PROFESSIONAL_TYPES) for n in PROFESSIONAL_NAMES)
LAYOUTS = {"INSTITUTIONAL": INSTITUTIONAL, "PROFESSIONAL": PROFESSIONAL}
