"""Column expressions: the null, text, date and number rules claims data relies on."""

from claimweave.functions.rules import (
    NEVER_DATE,
    bill_type_code,
    blank,
    claim_type_from_taxonomy,
    filled,
    folded,
    in_version,
    left_n,
    not_deleted,
    not_in_workbasket,
    number_or_null,
    number_text,
    one_of,
    or_empty,
    pad_bill_type,
    poa_code,
    presence_qualifier,
    same_text,
    strip_dashes,
    yyyymmdd,
)
from claimweave.functions.xml import element, xml_list

__all__ = [
    "NEVER_DATE",
    "bill_type_code",
    "blank",
    "claim_type_from_taxonomy",
    "element",
    "filled",
    "folded",
    "in_version",
    "left_n",
    "not_deleted",
    "not_in_workbasket",
    "number_or_null",
    "number_text",
    "one_of",
    "or_empty",
    "pad_bill_type",
    "poa_code",
    "presence_qualifier",
    "same_text",
    "strip_dashes",
    "xml_list",
    "yyyymmdd",
]
