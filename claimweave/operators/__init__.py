"""Relational building blocks: versioned joins, per-key picks, lists, records and staging."""

from claimweave.operators.gate import audit_passed, in_slice, in_window, of_type
from claimweave.operators.joins import asof_join, lookup_join, spread_null_join
from claimweave.operators.keys import only_keys
from claimweave.operators.lines import drop_superseded_lines
from claimweave.operators.lists import list_to_slots, ordered_list
from claimweave.operators.picks import first_non_null, latest_value
from claimweave.operators.records import join_runs, render_runs, unique_lookup
from claimweave.operators.skew import frequent_keys, salted_join
from claimweave.operators.stage import release, stage

__all__ = [
    "asof_join",
    "audit_passed",
    "drop_superseded_lines",
    "first_non_null",
    "frequent_keys",
    "in_slice",
    "in_window",
    "latest_value",
    "join_runs",
    "list_to_slots",
    "lookup_join",
    "of_type",
    "only_keys",
    "ordered_list",
    "release",
    "render_runs",
    "salted_join",
    "spread_null_join",
    "stage",
    "unique_lookup",
]
