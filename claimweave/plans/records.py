"""Field order of the two pipe-delimited records.

Each record is a list of fields taken from the staged claim or the staged claim line. A mark after
the name gives the text form: ``:d`` is a date as ``yyyyMMdd``, ``:n`` a number as plain text.
"""

from __future__ import annotations

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


@dataclass(frozen=True)
class Field:
    """One record field: ``side`` is ``claim``, ``line`` or ``lookup``."""

    side: str
    name: str
    form: str = "text"


FORMS = {"": "text", "d": "date", "n": "number"}


def _fields(side: str, parts: tuple) -> list[Field]:
    split = (token.partition(":") for token in names(*parts))
    return [Field(side, name, FORMS[mark]) for name, _, mark in split]


def claim(*parts: str | list[str]) -> list[Field]:
    return _fields("claim", parts)


def line(*parts: str | list[str]) -> list[Field]:
    return _fields("line", parts)


def practitioner(role: str, taxgroup: str = "TAXGROUP_ID") -> list[str]:
    """A provider block; the NPI stands in the provider-id position as well."""
    return names(
        prefixed(
            role, f"NPI:n {taxgroup} NPI:n STATE_LICENSE SUBSPEC_ID TAXONOMY_CODE ENTITY_TYPE"
        ),
        person(role),
    )


def modifiers(prefix: str) -> list[str]:
    return numbered(1, 8, f"{prefix}_MOD#")


def cdf_texts() -> list[Field]:
    return line(numbered(1, 3, "CDF_TEXT_#")) + claim(numbered(1, 3, "CLAIM_CDF_TEXT_#"))


def all_adjustments() -> list[Field]:
    return (
        line("ADJUSTMENT_NUMBER", adjustments())
        + claim("CLAIM_ADJUSTMENT_NUMBER", adjustments("CLAIM_"))
    )


PATIENT_NAME = names(person("PATIENT"), "RELATIONSHIP_TO_SUB PATIENT_DEATH_DATE:d")
INSURANCE = "INSURANCE_ID INSURANCE_LOB_SUBTYPE"
BLUE_CARD = names("BLUE_CARD_INDICATOR", prefixed("ITS", "HOME_STATE HOST_STATE SERIAL_NUM"))
CONTRACT = prefixed("CONTRACT", "ID TYPE_CODE AMOUNT:n PCT:n CODE TERMS_DISC_PCT:n VERSION_ID")
NDC = "SUB_NDC SUB_NDC_UNITS:n SUB_NDC_UNITS_TYPE"
ALLOWED = names(
    "ALLOWED_HCPCS", modifiers("ALLOWED"),
    "ALLOWED_UNITS:n ALLOWED_AMOUNT:n COMPOUND_DRUG_YN ALLOWED_NDC ALLOWED_NDC_UNITS:n "
    "ALLOWED_NDC_UNITS_TYPE",
)
LINE_SHARES = names(
    "COPAY:n COINSURANCE:n DEDUCTIBLE:n COB:n",
    prefixed(
        "COB",
        "AMOUNT:n COINSURANCE_AMOUNT:n DEDUCTIBLE_AMOUNT:n PAID_AMOUNT:n ALLOWED_AMOUNT:n",
    ),
    "OTHER_REDUCTION:n PAID:n PAID_DATE:d PAID_UNITS:n LINE_CAPITATION_INDICATOR",
)
CLAIM_SHARES = names(
    "ASSIGNMENT_OF_BENEFITS",
    prefixed(
        "CLAIM",
        "BILLED_AMOUNT:n NONCOVERED_AMOUNT:n ALLOWED_AMOUNT:n PAID_AMOUNT:n COINSURANCE_AMOUNT:n "
        "COPAY_AMOUNT:n DEDUCTIBLE_AMOUNT:n DISALLOWED_AMOUNT:n PATIENT_LIABILITY_AMOUNT:n",
    ),
    prefixed(
        "CLAIM_COB",
        "AMOUNT:n ALLOWED_AMOUNT:n COINSURANCE_AMOUNT:n PAID_AMOUNT:n DEDUCT_AMOUNT:n",
    ),
)
PAYMENT = (
    "CLAIM_PAID_DATE:d CLAIM_CHECK_PAID_DATE:d PAID_TO_CODE PAYMENT_STATUS "
    "CLAIM_CAPITATION_INDICATOR"
)
OTHER_COVER = "WHOLE_CLAIM_PRICING_LINE_YN OTHER_INSURANCE_INDICATOR COORDINATED_BENEFITS_YN"
SUBSCRIBER = names(
    "CLAIM_FILING_INDICATOR", person("SUB"), "SUB_ADDRESS_1 SUB_ADDDRESS_2", region("SUB"),
    "SUB_DOB:d SUB_GENDER_ID SUB_SSN", address("PATIENT"), "RETIRED_INDICATOR",
)
CLAIM_NOTE = "CLAIM_NOTE_REF_CODE CLAIM_NOTE_TEXT"
BILLING_TAIL = "STATE_LICENSE SUBSPEC_ID TAXONOMY_CODE CURRENCY_CODE ENTITY_TYPE"

# Field order of the professional record.
PROFESSIONAL_RECORD = [
    *claim("PAYER_SHORT CLAIM_TYPE SUB_ID DEP_ID PATIENT_DOB:d PATIENT_GENDER_ID PATIENT_SSN"),
    *claim("SUB_MEDICARE_ID MEDICAID_ID PATIENT_ID PATIENT_CONTROL_NUMBER", PATIENT_NAME),
    *claim("PATIENT_WEIGHT:n CLAIM_ID PREGNANCY_INDICATOR_YN MED_REC_NO"),
    *claim(numbered(1, 24, "DIAGNOSIS_CODE_#_QUAL DIAGNOSIS_CODE_#")),
    *line(INSURANCE),
    *claim(BLUE_CARD),
    *line("MEDICARE_PROVIDER_ID MEDICAID_PROVIDER_ID", practitioner("RENDERING", "TAXGROUP_ID:n")),
    *line("RENDERING_STREET_ADDRESS_1 RENDERING_STREET_ADDRESS_2", region("RENDERING")),
    *line(phones("RENDERING")),
    *line(prefixed("BILLING", f"NPI:n TAXGROUP_ID NPI:n {BILLING_TAIL}"), person("BILLING")),
    *line(address("BILLING"), "BILLING_CONTACT", phones("BILLING", "PHONE_COUNTRY")),
    *line(CONTRACT, "LINE_SEQ:n DOS_FROM:d DOS_TO:d POS_ID TOS", numbered(1, 12, "DIAG_PTR#:n")),
    *line("SUB_HCPCS", modifiers("SUB"), "UNITS_TYPE SUB_UNITS:n SUB_AMOUNT:n"),
    *line("SUB_NONCOVERED_AMOUNT:n", NDC, ALLOWED, LINE_SHARES),
    *line("FEE_SERVICE_AMOUNT:n PATIENT_LIABILITY_AMOUNT:n DISALLOWED_AMOUNT:n"),
    *line("LINE_REIMBURSEMENT_TYPE"),
    *claim(CLAIM_SHARES, PAYMENT, "CLAIM_FEE_SCHEDULE_CODE PATIENT_PLAN_CODE", OTHER_COVER),
    *line("BYPASS_CODE:n PAYER_BYPASS_CODE:n PAR_YN EDIT_0_ALLOWED_YN"),
    *claim("DATE_RECEIVED_CLIENT:d CLAIM_ID_ORIG"),
    *line("LINE_SEQ_ORIG"),
    *claim("GROUP_ID GROUP_NAME RISK_POOL", SUBSCRIBER),
    *line("PAY_TO_ENTITY_TYPE", person("PAY_TO"), address("PAY_TO")),
    *line("REFERRING_PCP_YN", practitioner("REFERRING"), practitioner("SUPERVISING")),
    *line(practitioner("ORDERING", "TAXGROUP_ID:n")),
    *line("ORDERING_STREET_ADDRESS_1 ORDERING_STREET_ADDRESS_2", region("ORDERING")),
    *line("ORDERING_CONTACT", phones("ORDERING")),
    *claim("AUTH_EXCEPTION_CODE REFERRAL_ID AUTH_NO_A", CLAIM_NOTE),
    *claim("MEDICARE_CROSSOVER_INDICATOR_YN"),
    *line("CHIRO_CONDITION_CODE", numbered(1, 2, "CHIRO_CONDITION_DESC_#")),
    *claim("CHIRO_LAST_XRAY_DATE:d"),
    *line("VISION_CODE_CATEGORY", numbered(1, 5, "VISION_CONDITION_CODE_#")),
    *claim("EPSDT_REFERRAL_YN", numbered(1, 3, "EPSDT_CONDITION_CODE_#"), "EPSDT_INDICATOR_YN"),
    *claim(numbered(1, 2, "ANESTHESIA_RELATED_SURG_HCPCS_#")),
    *line("FAMILY_PLANNING_INDICATOR_YN"),
    *line(prefixed("DME", "HCPCS UNITS:n RENTAL_PRICE:n PURCHASE_PRICE:n RENTAL_FREQUENCY:n")),
    *line("DMERC_CMN_TRANSMIT_CODE DME_CERT_TYPE DME_DURATION:n"),
    *line(numbered(1, 2, "DME_CONDITION_CODE_#")),
    *line(prefixed("DME", "CERT_REVISION_DATE:d BEGIN_THERAPY_DATE:d LAST_CERT_DATE:d")),
    *claim("FORM_ID_CODE FORM_ID DOCUMENT_CONTROL_NUMBER"),
    *line(
        numbered(
            1, 10, "LINE_ATTACHMENT_TYPE_CODE_# LINE_ATTACHMENT_TRANSMIT_CODE_# LINE_ACN_#"
        )
    ),
    *claim(prefixed("CLAIM", "ATTACHMENT_TYPE_CODE ATTACHMENT_TRANSMIT_CODE ACN")),
    *line(numbered(1, 5, "LINE_AUTH_NO_# LINE_AUTH_NO_#_NPI:n")),
    *claim("ONSET_CURRENT_ILLNESS:d INITIAL_TREATMENT_DATE:d LAST_SEEN_DATE:d"),
    *claim("ACUTE_MANISFESTATION_DATE:d ACCIDENT_DATE:d LMP_DATE:d ADMIT_DATE:d"),
    *claim("DISCHARGE_DATE:d ASSUMED_CARE_DATE:d RELINQUISHED_CARE_DATE:d"),
    *line("LINE_NOTE_REF_CODE LINE_NOTE_TEXT"),
    *claim("CLAIM_FREQUENCY_CODE"),
    *all_adjustments(),
    *line("ANESTHESIA_TIME:n"),
    *claim("CHECK_NUM PLATFORM_CODE DATA_SOURCE"),
    *line("EMERGENCY_INDICATOR_YN"),
    *claim("PAPER_INDICATOR CIT_RESTRICTED_ID CV_US_ONLY_YN"),
    *cdf_texts(),
]

# Field order of the institutional record.
INSTITUTIONAL_RECORD = [
    *claim("PAYER_SHORT"),
    Field("lookup", "BILL_TYPE"),
    *claim("SUB_ID DEP_ID PATIENT_DOB:d PATIENT_GENDER_ID PATIENT_SSN SUB_MEDICARE_ID"),
    *claim("MEDICAID_ID PATIENT_ID PATIENT_CONTROL_NUMBER", PATIENT_NAME),
    *claim("CLAIM_ID PROVIDER_CLAIM_ID MED_REC_NO BILL_TYPE"),
    *claim(numbered(1, 24, "CONDITION_CODE_#"), numbered(1, 24, "VALUE_CODE_# VALUE_AMOUNT_#:n")),
    *claim("CLAIM_DOS_FROM:d CLAIM_DOS_TO:d LENGTH_OF_STAY:n"),
    *claim(prefixed("ADMIT", "DATE:d TIME_HH:n TIME_MM:n TYPE SOURCE_CODE")),
    *claim(prefixed("DISCHARGE", "DATE:d TIME_HH:n TIME_MM:n STATUS")),
    *claim("SUB_DRG SUB_SEVERITY ALLOWED_DRG ALLOWED_SEVERITY DRG_INLIER_AMOUNT:n"),
    *claim("DRG_OUTLIER_AMOUNT:n GROUPER_ID GROUPER_VERSION"),
    *line("APC_CODE:n APC_PAYMENT_WEIGHT:n APC_VERSION APG_CODE APG_VERSION"),
    *claim("REGULATORY_STATE"),
    *claim(prefixed("PRINCIPAL_DIAGNOSIS", "QUAL"), "PRINCIPAL_DIAGNOSIS PRINCIPAL_DIAGNOSIS_POA"),
    *claim(
        numbered(
            2, 25,
            "OTHER_DIAGNOSIS_CODE_#_QUAL OTHER_DIAGNOSIS_CODE_# OTHER_DIAGNOSIS_CODE_#_POA",
        )
    ),
    *claim("ADMITTING_DIAGNOSIS_QUAL ADMITTING_DIAGNOSIS"),
    *claim(
        numbered(
            1, 12,
            "EXTERNAL_CAUSE_OF_INJURY_#_QUAL EXTERNAL_CAUSE_OF_INJURY_# "
            "EXTERNAL_CAUSE_OF_INJURY_#_POA",
        )
    ),
    *claim(
        numbered(1, 3, "PATIENTS_REASON_FOR_VISIT_#_QUAL PATIENTS_REASON_FOR_VISIT_#")
    ),
    *claim("PRINCIPAL_PROCEDURE_QUAL PRINCIPAL_PROCEDURE PRINCIPAL_PROCEDURE_DATE:d"),
    *claim(numbered(2, 25, "OTHER_PROCEDURE_#_QUAL OTHER_PROCEDURE_# OTHER_PROCEDURE_#_DATE:d")),
    *line(INSURANCE),
    *claim(BLUE_CARD, "MEDICARE_PROVIDER_ID MEDICAID_PROVIDER_ID", practitioner("RENDERING")),
    *claim("RENDERING_STREET_ADDRESS_1 RENDERING_STREET_ADDRESS_2", region("RENDERING")),
    *claim(phones("RENDERING")),
    *line("BILLING_NPI:n"),
    *claim("BILLING_TAXGROUP_ID"),
    *line("BILLING_NPI:n"),
    *claim(prefixed("BILLING", f"{BILLING_TAIL} NAME ADDRESS_1 ADDRESS_2 CITY STATE")),
    *line("BILLING_ZIP BILLING_ZIP_PLUS_4"),
    *claim("BILLING_COUNTRY BILLING_COUNTRY_SUBDIVISION BILLING_CONTACT"),
    *claim(phones("BILLING")),
    *line(CONTRACT, "LINE_SEQ:n DOS_FROM:d DOS_TO:d SUB_REV_CODE SUB_HCPCS", modifiers("SUB")),
    *line("UNITS_TYPE SUB_UNITS:n SUB_AMOUNT:n SUB_NON_COVERED_AMOUNT:n", NDC),
    *line("ALLOWED_REV_CODE", ALLOWED, LINE_SHARES, "CLIENT_TYPE_OF_SERVICE"),
    *line("LINE_FEE_SERVICE_AMOUNT:n LINE_PATIENT_LIAB_AMOUNT:n DISALLOWED_AMOUNT:n"),
    *line("LINE_REIMBURSEMENT_TYPE"),
    *claim(CLAIM_SHARES, "PATIENT_RESP_AMOUNT:n", PAYMENT, "DRG_PAYABLE_YN PRIOR_PAYMENTS:n"),
    *claim("CLAIM_FEE_SCHEDULE_AMOUNT:n CLAIM_FEE_SCHEDULE_CODE CLAIM_REIMBURSE_TYPE"),
    *line("MEDICARE_SERVICE_FEE_AMOUNT:n"),
    *claim("PATIENT_PLAN_CODE PER_CASE_RATE_AMOUNT:n PER_DIEM_RATE_AMOUNT:n"),
    *claim("PER_DIEM_WEIGHTED_AMOUNT:n", OTHER_COVER),
    *line("BYPASS_CODE:n PAYER_BYPASS_CODE:n"),
    *claim("AUDIT_BYPASS_CODE:n"),
    *line("PAR_YN EDIT_0_ALLOWED_YN ZERO_CHG_LINE_SEQ ZERO_CHG_SCHED_AMOUNT:n"),
    *claim("DATE_RECEIVED_CLIENT:d DATE_ADJUDICATED:d CLAIM_APPROVED_BY LETTER_PLAN_CODE"),
    *claim("CLAIM_ID_ORIG"),
    *line("LINE_SEQ_ORIG"),
    *claim("GROUP_ID GROUP_NAME RISK_POOL CLAIM_DENIAL_RSN_CD MORTALITY_RISK BIRTH_WEIGHT:n"),
    *claim("ALC_DAYS:n ALC_AMOUNT:n PAYER_NAME", address("PAYER"), SUBSCRIBER),
    *claim("PAY_TO_ENTITY_TYPE PAY_TO_NAME", address("PAY_TO")),
    *claim(practitioner("ATTENDING"), practitioner("OPERATING"), practitioner("OTHER_OPERATING")),
    *claim("REFERRING_PCP_YN", practitioner("REFERRING")),
    *claim("AUTH_EXCEPTION_CODE REFERRAL_ID AUTH_NO_A AUTH_NO_B AUTH_NO_C PRO_AUTH_ID"),
    *claim(CLAIM_NOTE, "EPSDT_REFERRAL_YN", numbered(1, 3, "EPSDT_COND_INDICATOR_#")),
    *claim(numbered(1, 24, "OCCUR_SPAN_CODE_# OCCUR_SPAN_FROM_#:d OCCUR_SPAN_TO_#:d")),
    *claim(numbered(1, 24, "OCCUR_CODE_# OCCUR_DATE_#:d"), "DOCUMENT_CONTROL_NUMBER"),
    *claim(prefixed("CLAIM", "ATTACHMENT_TYPE_CODE ATTACHMENT_TRANSMIT_CODE ACN")),
    *claim(numbered(1, 10, "ATTACHMENT_TYPE_CODE_# ATTACHMENT_TRANSMIT_CODE_# ACN_#")),
    *all_adjustments(),
    *line("ANESTHESIA_TIME:n"),
    *claim("CHECK_NUM CLIENT_PLATFORM DATA_SOURCE"),
    *line("EMERGENCY_INDICATOR_YN"),
    *claim("PAPER_INDICATOR CIT_RESTRICTED_ID CV_US_ONLY_YN"),
    *cdf_texts(),
]

RECORDS = {"PROFESSIONAL": PROFESSIONAL_RECORD, "INSTITUTIONAL": INSTITUTIONAL_RECORD}
