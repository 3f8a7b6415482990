"""Text columns taken over from source tables: new name, source column, width."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions import left_n

Mapping = tuple[tuple[str, str, int | None], ...]

# Which source column fills which column, and how many characters are kept.
HEADER_TEXT: Mapping = (
    ("claim_id", "claim_hcc_id", 25),
    ("patient_control_number", "patient_account_number", 24),
    ("bill_type", "type_of_bill_code", 4),
    ("discharge_status", "discharge_status_code", None),
    ("principal_procedure", "principal_procedure_code", 7),
    ("assignment_of_benefits", "benefit_assignment", 1),
    ("is_adjusted_claim", "is_adjusted", None),
)
NAME_WIDTHS = {"last_name": 60, "first_name": 35, "middle_name": 25, "name_suffix": 10}
MEMBER_TEXT: Mapping = (
    ("sub_id", "subscription_hcc_id", 25),
    ("patient_gender_id", "member_gender_code", None),
    *(
        (f"{new}_{part}", f"{source}_{part}", width)
        for new, source in (("patient", "member"), ("sub", "subscriber"))
        for part, width in NAME_WIDTHS.items()
    ),
)
ACCOUNT_TEXT: Mapping = (("group_id", "account_hcc_id", 15), ("group_name", "account_name", 60))
ADDRESS_TEXT: Mapping = (
    ("address_1", "address_line", 55),
    ("address_2", "address_line_2", 55),
    ("city", "city_name", 30),
    ("state", "state_code", 2),
    ("zip", "zip_code", 5),
    ("zip_plus_4", "zip_4_code", None),
    ("country", "country_code", None),
)
SUPPLIER_TEXT: Mapping = (
    ("provider_id", "supplier_hcc_id", 25),
    ("npi", "supplier_npi", 10),
    ("last_name", "supplier_name", 60),
)
PRACTITIONER_TEXT: Mapping = (
    ("provider_id", "practitioner_hcc_id", 25),
    ("npi", "practitioner_npi", 10),
    *((part, f"practitioner_{part}", width) for part, width in NAME_WIDTHS.items()),
)
TAXONOMY_TEXT: Mapping = (("subspec_id", "provider_taxonomy_code", 10),)


def text_columns(mapping: Mapping, prefix: str = "") -> list[Column]:
    """The columns of a mapping, cut to width; ``prefix`` goes before the new names."""
    return [
        (F.col(source) if width is None else left_n(F.col(source), width)).alias(prefix + name)
        for name, source, width in mapping
    ]
