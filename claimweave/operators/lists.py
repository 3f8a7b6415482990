"""Nested lists per claim, and the numbered slots the extract reads them from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITION = "SORT_ORDER"


def ordered_list(
    fields: Sequence[Column],
    names: Sequence[str],
    order: Column,
    only: Column | None = None,
    renumber: bool = False,
) -> Column:
    """Aggregate: the members of a group as an array of structs in list order.

    NULL order values come first and the member's own fields break ties, so the result does not
    depend on row order. ``renumber`` adds the position in the list as ``SORT_ORDER``; the array is
    sorted already, so that needs no window.
    """
    entry = F.struct(order.alias("_order"), *(f.alias(n) for f, n in zip(fields, names, strict=True)))
    if only is not None:
        entry = F.when(only, entry)
    entries = F.sort_array(F.collect_list(entry))

    def member(e: Column, i: Column) -> Column:
        kept = [e[n].alias(n) for n in names]
        return F.struct(*kept, (i + F.lit(1)).alias(POSITION)) if renumber else F.struct(*kept)

    return F.transform(entries, member)


def list_to_slots(entries: Column, parts: dict[str, str], first: int, last: int) -> list[Column]:
    """Columns ``NAME_first .. NAME_last`` from an array of structs; absent entries give NULL.

    ``parts`` maps a struct field to a slot name pattern in which ``#`` stands for the number.
    """
    return [
        F.get(entries, F.lit(n - first))[field].alias(pattern.replace("#", str(n)))
        for n in range(first, last + 1)
        for field, pattern in parts.items()
    ]
