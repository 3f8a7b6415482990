"""The layouts against the field lists of the fixtures document."""

import re
from pathlib import Path

import pytest

from claimweave.plans.layouts import INSTITUTIONAL, PROFESSIONAL
from claimweave.plans.records import INSTITUTIONAL_RECORD, PROFESSIONAL_RECORD

DOCUMENT = (Path(__file__).parents[1] / "FIXTURES.md").read_text()
PART = re.compile(r"\{([^}]*)\} for #=(\d+)\.\.(\d+)|([^;{}]+)")


def listed(head, separator):
    section = re.split(r"\n#{2,3} ", DOCUMENT.split(f"### {head} ", 1)[1], maxsplit=1)[0]
    fields = []
    for line in re.findall(r"^- \S+ — (.*)$", section, re.M):
        for group, first, last, single in PART.findall(line):
            if group:
                fields += [
                    part.strip().replace("#", str(n))
                    for n in range(int(first), int(last) + 1)
                    for part in re.split(separator, group)
                ]
            elif single.strip():
                fields.append(single.strip())
    return fields


def described(column):
    if column.kind == "string":
        kind = f"s({column.width or 'MAX'})"
    else:
        kind = {"date": "date", "timestamp_ntz": "ts"}.get(
            column.kind, column.kind.replace("decimal", "dec").replace(",0)", ")")
        )
    return f"{column.name} {kind}"


@pytest.mark.parametrize(
    ("head", "layout", "count"), [("3.3", INSTITUTIONAL, 532), ("3.4", PROFESSIONAL, 157)]
)
def test_wide_layouts(head, layout, count):
    wanted = listed(head, r", (?=[A-Z])")
    assert len(layout) == len(wanted) == count
    for text, column in zip(wanted, layout, strict=True):
        declared, _, default = text.rstrip("*").partition("=")
        assert declared.replace(",0)", ")") == described(column)
        if default:
            assert column.default == {"''": "", "NULL": None}[default]


@pytest.mark.parametrize(
    ("head", "record", "count"), [("3.1", PROFESSIONAL_RECORD, 502), ("3.2", INSTITUTIONAL_RECORD, 822)]
)
def test_records(head, record, count):
    side = {"claim": "C.", "line": "L."}
    mark = {"text": "", "date": ":d", "number": ":n"}
    mine = [
        "LOOKUP(C.BILL_TYPE)" if f.side == "lookup" else side[f.side] + f.name + mark[f.form]
        for f in record
    ]
    assert len(mine) == count
    assert mine == listed(head, ",")
