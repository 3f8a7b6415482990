"""Scalar and predicate rules, all built from JVM-side column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes that decide results.
DELETED = "Y"
WORKBASKET_STATUSES = ("R", "V")
POA_NOT_STATED = ("N/S", "N/A")
AMBULATORY_TAXONOMY = "261QA1903X"
NEVER_DATE = dt.date(1900, 1, 1)


def not_deleted(flag: Column) -> Column:
    """Keep rows whose soft-delete flag is not ``Y`` in any case; a missing flag counts as live."""
    return or_empty(folded(flag)) != DELETED


def not_in_workbasket(status: Column) -> Column:
    """Keep settled records. A missing status stays unknown, so a filter rejects the row."""
    return ~one_of(status, WORKBASKET_STATUSES)


def in_version(as_of: Column, start: Column, end: Column) -> Column:
    """True when ``as_of`` lies in the half-open range ``[start, end)``."""
    return (start <= as_of) & (end > as_of)


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def blank(value: Column) -> Column:
    """Missing, empty or made of trailing blanks only."""
    return F.rtrim(or_empty(value)) == ""


def filled(value: Column) -> Column:
    return ~blank(value)


def folded(value: Column) -> Column:
    """The form in which texts are compared: upper case, without blanks at the end."""
    return F.rtrim(F.upper(value))


def same_text(value: Column, literal: str) -> Column:
    """Case-insensitive equality with a literal; blanks at the end do not count."""
    return folded(value) == literal.upper()


def one_of(value: Column, literals: tuple[str, ...]) -> Column:
    """The same equality with any literal of a list."""
    return folded(value).isin(*(text.upper() for text in literals))


def left_n(value: Column, width: int) -> Column:
    return F.substring(value, 1, width)


def strip_dashes(value: Column) -> Column:
    return F.replace(value, F.lit("-"), F.lit(""))


def yyyymmdd(value: Column) -> Column:
    """Eight-digit text of a date; arithmetic is about twice as fast as a date formatter."""
    number = F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)
    return F.lpad(number.cast("string"), 8, "0")


def number_text(value: Column) -> Column:
    """Plain text of an integer or decimal; decimals keep their scale."""
    return value.cast("string")


def number_or_null(value: Column, precision: int, scale: int = 0) -> Column:
    """Decimal value, or NULL where text is not a number or does not fit."""
    return value.try_cast(f"decimal({precision},{scale})")


def pad_bill_type(value: Column) -> Column:
    """Last four characters of the code after zero padding; a missing code becomes ``0000``."""
    return F.right(F.concat(F.lit("0000"), or_empty(value)), F.lit(4))


def bill_type_code(value: Column) -> Column:
    """Lookup key of a bill type: leading zeros off, then the first two characters.

    Blanks inside the code turn into zeros, as the crosswalk expects.
    """
    no_lead = F.ltrim(F.replace(value, F.lit("0"), F.lit(" ")))
    return left_n(F.replace(no_lead, F.lit(" "), F.lit("0")), 2)


def poa_code(value: Column) -> Column:
    """One-letter present-on-admission code; the two *not stated* codes become empty."""
    return F.when(one_of(value, POA_NOT_STATED), F.lit("")).otherwise(left_n(value, 1))


def presence_qualifier(value: Column) -> Column:
    return F.when(value.isNotNull(), F.lit("0")).otherwise(F.lit(""))


def claim_type_from_taxonomy(taxonomy: Column) -> Column:
    """``A`` for ambulatory surgery billing, ``P`` for every other or missing taxonomy."""
    return F.when(same_text(taxonomy, AMBULATORY_TAXONOMY), F.lit("A")).otherwise(F.lit("P"))
