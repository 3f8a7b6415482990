"""Field name builders shared by the wide layouts."""

from __future__ import annotations


def names(*parts: str | list[str]) -> list[str]:
    """Flatten space-separated names and ready lists, keeping their order."""
    flat: list[str] = []
    for part in parts:
        flat += part.split() if isinstance(part, str) else part
    return flat


def numbered(first: int, last: int, patterns: str) -> list[str]:
    """Every pattern once per number, number by number; ``#`` stands for the number."""
    return [p.replace("#", str(n)) for n in range(first, last + 1) for p in patterns.split()]


def prefixed(prefix: str, suffixes: str) -> list[str]:
    return [f"{prefix}_{s}" for s in suffixes.split()]


def person(role: str) -> list[str]:
    return prefixed(role, "LAST_NAME FIRST_NAME MIDDLE_NAME NAME_SUFFIX")


def place(role: str) -> list[str]:
    return prefixed(role, "CITY STATE ZIP ZIP_PLUS_4 COUNTRY")


def region(role: str) -> list[str]:
    return names(place(role), f"{role}_COUNTRY_SUBDIVISION")


def address(role: str) -> list[str]:
    return names(prefixed(role, "ADDRESS_1 ADDRESS_2"), region(role))


def phones(role: str, first: str = "PHONE_COUNTRY_CODE") -> list[str]:
    return prefixed(
        role,
        f"{first} PHONE PHONE_EXT ALT_PHONE_COUNTRY_CODE ALT_PHONE ALT_PHONE_EXT "
        "FAX_COUNTRY_CODE FAX",
    )


def adjustments(prefix: str = "") -> list[str]:
    return numbered(1, 10, f"{prefix}ADJ_CODE_# {prefix}ADJ_TYPE_# {prefix}ADJUSTOR_ID_#")
