"""Expected results as plain SQL for DuckDB over the same sample views.

The parts restate the pipeline's joins and rules in SQL of their own. Only the fixed column mappings
and layouts are shared with the builders; the layouts are tested against the fixtures document.
"""

from __future__ import annotations

from claimweave.plans.columns import (
    ACCOUNT_TEXT,
    ADDRESS_TEXT,
    HEADER_TEXT,
    MEMBER_TEXT,
    PRACTITIONER_TEXT,
    SUPPLIER_TEXT,
    TAXONOMY_TEXT,
    Mapping,
)
from claimweave.plans.layouts import LAYOUTS
from claimweave.plans.records import RECORDS
from claimweave.sources.sample import with_views

AS_OF = "2020-01-01 00:00:00"
PAYER = "PAYER"
WINDOW = ("1996-02-29 00:00:00", "2000-12-31 00:00:00")
SLICE = (10, 1_000_000_000)


def live(alias: str) -> str:
    return f"coalesce(upper({alias}.deleted_flag), '') <> 'Y'"


def settled(column: str) -> str:
    return f"upper({column}) not in ('R', 'V')"


def in_force(alias: str, moment: str) -> str:
    return f"{alias}.version_eff_date_key <= {moment} and {alias}.version_exp_date_key > {moment}"


def effective(alias: str, moment: str) -> str:
    return (
        f"{alias}.effective_start_date_key <= {moment} and {alias}.effective_end_date_key > {moment}"
    )


def day(alias: str, key: str) -> str:
    """A left join of the date dimension for one role."""
    return f"left join date_dimension {alias} on {key} = {alias}.date_key and {live(alias)}"


def tag(name: str, value: str) -> str:
    escaped = f"replace(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"coalesce('<{name}>' || {escaped} || '</{name}>', '')"


POA = (
    "case when p.diagnosis_poa_indicator_code in ('N/S', 'N/A') then '' "
    "else left(p.diagnosis_poa_indicator_code, 1) end"
)


def cut(alias: str, mapping: Mapping, prefix: str = "", **other: str) -> str:
    """Select list of a column mapping; ``other`` replaces single expressions."""
    listed = []
    for name, source, width in mapping:
        value = f"{alias}.{source}" if width is None else f"left({alias}.{source}, {width})"
        listed.append(f"{other.get(name, value)} as {prefix}{name}")
    return ", ".join(listed)


def provider_address() -> str:
    """Address columns of a provider: street lines under their own prefix, zip+4 cut to four."""
    street, rest = ADDRESS_TEXT[:2], ADDRESS_TEXT[2:]
    return f"{cut('a', street, 'street_')}, {cut('a', rest, zip_plus_4='left(a.zip_4_code, 4)')}"


PARTS = {
    "want_header": f"""
        select c.claim_fact_key, c.claim_type_name, '{PAYER}' as payer_short,
            {cut("c", HEADER_TEXT)},
            pd.date_value as principal_procedure_date,
            case when c.is_adjusted = 'Y' then coalesce(left(v.claim_hcc_id, 25), '') else '' end
                as claim_id_orig,
            left(d.standardized_diagnosis_code, 7) as principal_diagnosis,
            {POA} as principal_diagnosis_poa,
            left(ad.standardized_diagnosis_code, 7) as admitting_diagnosis,
            sd.date_value as claim_dos_from, ed.date_value as claim_dos_to,
            md.date_value as admit_date, xd.date_value as discharge_date,
            rd.date_value as date_received_client, 'Y' as cv_us_only_yn,
            c.submitted_drg_key, c.calculated_drg_key, c.member_key, c.supplier_key, c.location_key,
            c.attending_practitioner_key, c.referring_practitioner_key, c.endorsement_eff_time,
            c.is_voided, c.statement_start_date_key,
            left(coalesce(m.mbi, m.hicn), 25) as sub_medicare_id, c.length_of_stay,
            jd.date_value as date_adjudicated
        from all_claim_fact c
        left join all_claim_fact v
            on c.previous_final_claim_fact_key = v.claim_fact_key and {live("v")}
        left join diagnosis d on c.primary_diagnosis_code = d.diagnosis_code and {live("d")}
        left join diagnosis_poa_indicator_code p
            on c.primary_diagnosis_poa_ind_key = p.diagnosis_poa_indicator_key and {live("p")}
        left join diagnosis ad on c.admit_diagnosis_code = ad.diagnosis_code and {live("ad")}
        {day("pd", "c.principal_procedure_date_key")}
        {day("sd", "c.statement_start_date_key")}
        {day("ed", "c.statement_end_date_key")}
        {day("md", "c.admission_date_key")}
        {day("xd", "c.discharge_date_key")}
        {day("rd", "c.receipt_date_key")}
        left join medicare_hicn_info_fact m on c.member_key = m.member_key
        left join date_dimension jd
            on c.most_recent_process_date_key = jd.date_key and {live("m")}
        where {live("c")}""",
    "want_member": f"""
        select h.claim_fact_key, h.statement_start_date_key as start_key, v.member_history_fact_key,
            {cut("v", MEMBER_TEXT)}, replace(v.tax_id, '-', '') as patient_ssn,
            {cut("g", ACCOUNT_TEXT)}, {cut("a", ADDRESS_TEXT, "patient_")},
            bd.date_value as patient_dob, dd.date_value as patient_death_date,
            '18' as relationship_to_sub
        from want_header h
        join all_member_version_hist_fact v on h.member_key = v.member_key
        left join all_account_history_fact g
            on v.account_key = g.account_key and {in_force("g", "h.statement_start_date_key")}
            and {settled("g.account_status")} and {live("g")}
        left join postal_address a
            on v.member_mailing_address_key = a.postal_address_key and {live("a")}
        {day("bd", "v.member_birth_date_key")}
        {day("dd", "v.member_death_date_key")}
        where v.endor_exp_date > timestamp '{AS_OF}' and {in_force("v", "h.statement_start_date_key")}
            and {settled("v.member_status")} and {live("v")}""",
    "want_member_id": f"""
        select m.claim_fact_key, m.member_history_fact_key,
            left(o.identification_number, 20) as patient_id
        from want_member m
        join member_other_id o on m.member_history_fact_key = o.member_history_fact_key
        join id_type_code t on o.id_type_key = t.id_type_key
        where {effective("o", "m.start_key")} and {live("o")} and t.id_type_code = '20'
            and {live("t")}""",
    "want_supplier_id": f"""
        select claim_fact_key, supplier_history_fact_key, medicare_provider_id from (
            select h.claim_fact_key, v.supplier_history_fact_key,
                o.identification_number as medicare_provider_id,
                row_number() over (partition by h.claim_fact_key, o.supplier_history_fact_key
                    order by o.supplier_other_id_key desc) as rn
            from want_header h
            join all_supplier_history_fact v on h.supplier_key = v.supplier_key
            join supplier_other_id o on v.supplier_history_fact_key = o.supplier_history_fact_key
            join id_type_code t on o.id_type_key = t.id_type_key
            where {effective("o", "h.statement_start_date_key")} and {live("o")}
                and t.id_type_code = '1C' and {live("t")}
                and {in_force("v", "h.statement_start_date_key")}
                and {settled("v.supplier_status")} and {live("v")}
        ) ranked where rn = 1""",
    "want_payment": f"""
        select claim_fact_key, claim_paid_date from (
            select l.claim_fact_key, dd.date_value as claim_paid_date,
                row_number() over (partition by l.claim_fact_key
                    order by l.payment_fact_key desc, dd.date_value desc nulls last) as rn
            from payment_fact_to_claim_fact l
            left join payment_fact f on l.payment_fact_key = f.payment_fact_key
                and f.payment_status_code in ('3', '7') and {live("f")}
            {day("dd", "f.payment_date_key")}
            where {live("l")}
        ) ranked where rn = 1""",
    "want_drg": f"""
        select h.claim_fact_key, s.drg_code as sub_drg, c.drg_code as allowed_drg
        from want_header h
        left join drg_history_fact s on h.submitted_drg_key = s.drg_key
            and {in_force("s", "h.statement_start_date_key")} and {settled("s.drg_status")}
            and {live("s")}
        left join drg_history_fact c on h.calculated_drg_key = c.drg_key
            and {in_force("c", "h.statement_start_date_key")} and {settled("c.drg_status")}
            and {live("c")}
        where coalesce(s.drg_code, '') <> '' or coalesce(c.drg_code, '') <> ''""",
    "want_diagnosis": f"""
        select f.claim_fact_key, f.diagnosis_code,
            left(d.standardized_diagnosis_code, 7) as standardized_diagnosis_code,
            {POA} as diagnosis_poa_indicator_code, cast(f.sort_order as varchar) as sort_order,
            f.claim_diagnosis_type
        from want_header h
        join claim_fact_to_diagnosis f on h.claim_fact_key = f.claim_fact_key
        join diagnosis d on f.diagnosis_code = d.diagnosis_code and {live("d")}
        left join diagnosis_poa_indicator_code p
            on f.poa_indicator = p.diagnosis_poa_indicator_key and {live("p")}
        where {live("f")}""",
    "want_procedure": f"""
        select f.claim_fact_key, left(f.procedure_code, 7) as procedure_code,
            strftime(coalesce(dd.date_value, date '1900-01-01'), '%Y%m%d') as procedure_code_date,
            cast(f.sort_order as varchar) as sort_order
        from want_header h
        join claim_fact_to_procedure_code f on h.claim_fact_key = f.claim_fact_key
        {day("dd", "f.procedure_date_key")}
        where {live("f")}""",
    "want_claim": f"""
        select claim_fact_key, claim_type_name, supplier_key, attending_practitioner_key,
            referring_practitioner_key, statement_start_date_key
        from all_claim_fact c where {live("c")}""",
    "want_billing": f"""
        select k.claim_fact_key, {cut("x", TAXONOMY_TEXT)}, {cut("v", SUPPLIER_TEXT)},
            '' as first_name, '' as middle_name, '' as name_suffix,
            replace(e.tax_id, '-', '') as taxgroup_id, 'P' as entity_type, {provider_address()}
        from want_claim k
        join all_supplier_history_fact v on k.supplier_key = v.supplier_key
        left join postal_address a
            on v.supplier_corr_address_key = a.postal_address_key and {live("a")}
        left join provider_taxonomy x
            on v.primary_classification_key = x.provider_taxonomy_key and {live("x")}
        left join tax_entity_history_fact e on v.tax_entity_key = e.tax_entity_key
            and {in_force("e", "k.statement_start_date_key")} and {settled("e.tax_entity_status")}
            and {live("e")}
        where {in_force("v", "k.statement_start_date_key")} and {settled("v.supplier_status")}
            and {live("v")}""",
    "want_referring": f"""
        select k.claim_fact_key, k.referring_practitioner_key,
            {cut("x", TAXONOMY_TEXT)}, {cut("v", PRACTITIONER_TEXT)}
        from want_claim k
        join all_practitioner_history_fact v on k.referring_practitioner_key = v.practitioner_key
        left join provider_taxonomy x
            on v.primary_specialty_key = x.provider_taxonomy_key and {live("x")}
        where upper(k.claim_type_name) = 'INSTITUTIONAL'
            and {in_force("v", "k.statement_start_date_key")} and {settled("v.practitioner_status")}
            and {live("v")}""",
    "want_first_line": f"""
        select claim_fact_key, practitioner_key from (
            select l.claim_fact_key, l.practitioner_key, row_number() over (
                partition by l.claim_fact_key order by l.claim_line_fact_key) as rn
            from all_claim_line_fact l where l.practitioner_key is not null and {live("l")}
        ) ranked where rn = 1""",
    "want_rendering_key": """
        select k.claim_fact_key, k.statement_start_date_key, k.supplier_key,
            case when upper(k.claim_type_name) = 'INSTITUTIONAL' then k.attending_practitioner_key
                 when upper(k.claim_type_name) = 'PROFESSIONAL' then f.practitioner_key end
                as rendering_key
        from want_claim k left join want_first_line f on k.claim_fact_key = f.claim_fact_key""",
    "want_rendering": f"""
        select k.claim_fact_key, {cut("x", TAXONOMY_TEXT)}, {cut("v", PRACTITIONER_TEXT)},
            replace(v.tax_id, '-', '') as taxgroup_id, 'P' as entity_type, {provider_address()}
        from want_rendering_key k
        join all_practitioner_history_fact v on k.rendering_key = v.practitioner_key
        left join postal_address a
            on v.practitioner_corr_addr_key = a.postal_address_key and {live("a")}
        left join provider_taxonomy x
            on v.primary_specialty_key = x.provider_taxonomy_key and {live("x")}
        where {in_force("v", "k.statement_start_date_key")} and {settled("v.practitioner_status")}
            and {live("v")}
        union all
        select b.* from want_billing b
        join want_rendering_key k on b.claim_fact_key = k.claim_fact_key
        where k.rendering_key is null and k.supplier_key is not null""",
    "want_lines": f"""
        select l.* from all_claim_line_fact l
        where {live("l")} and not exists (
            select 1 from all_claim_line_fact s
            where l.claim_fact_key = s.claim_fact_key
                and l.claim_line_fact_key <> s.claim_line_fact_key
                and l.claim_line_hcc_id = s.original_line_number
                and upper(s.is_split) = 'Y' and {live("s")})""",
    "want_amounts": """
        select l.claim_fact_key,
            cast(sum(l.billed_amount) as decimal(19,2)) as claim_billed_amount,
            cast(sum(l.base_non_covered_amount) as decimal(19,2)) as claim_noncovered_amount,
            cast(sum(l.base_allowed_amount) as decimal(19,2)) as claim_allowed_amount,
            cast(sum(l.base_paid_amount) as decimal(19,2)) as claim_paid_amount,
            cast(sum(l.base_coinsurance_amount) as decimal(19,2)) as claim_coinsurance_amount,
            cast(sum(l.base_copay_amount) as decimal(19,2)) as claim_copay_amount,
            cast(sum(l.base_deductible_amount) as decimal(19,2)) as claim_deductible_amount,
            cast(sum(coalesce(l.base_coinsurance_amount, 0) + coalesce(l.base_copay_amount, 0)
                + coalesce(l.base_deductible_amount, 0)) as decimal(19,2))
                as claim_patient_liability_amount
        from want_header h join want_lines l on h.claim_fact_key = l.claim_fact_key
        group by l.claim_fact_key""",
}


def diagnosis_items(where: str, number: str, poa: bool = True) -> str:
    """Diagnoses of one list with their position and their text."""
    poa_tag = tag("DIAGNOSIS_POA_INDICATOR_CODE", "diagnosis_poa_indicator_code") if poa else "''"
    order = "sort_order nulls first, standardized_diagnosis_code nulls first" + (
        ", diagnosis_poa_indicator_code nulls first" if poa else ""
    )
    return f"""
        select claim_fact_key, standardized_diagnosis_code as code,
            diagnosis_poa_indicator_code as poa, rn, '<DIAGNOSIS_QUAL>0</DIAGNOSIS_QUAL>'
            || {tag("STANDARDIZED_DIAGNOSIS_CODE", "standardized_diagnosis_code")} || {poa_tag}
            || {tag("SORT_ORDER", number)} as item
        from (select *, row_number() over (partition by claim_fact_key order by {order}) as rn
              from want_diagnosis where {where}) numbered"""


def list_of(items: str, name: str, row: str, root: str) -> str:
    return f"""
        select claim_fact_key, '<{root}>' || string_agg('<{row}>' || item || '</{row}>', ''
            order by rn) || '</{root}>' as {name}
        from {items} group by claim_fact_key"""


PARTS |= {
    "want_other_items": diagnosis_items("true", "sort_order"),
    "want_cause_items": diagnosis_items("upper(claim_diagnosis_type) = 'E'", "cast(rn as varchar)"),
    "want_reason_items": diagnosis_items("upper(claim_diagnosis_type) = 'R'", "cast(rn as varchar)"),
    "want_plain_items": diagnosis_items("true", "sort_order", poa=False),
    "want_procedure_items": f"""
        select claim_fact_key, procedure_code as code, procedure_code_date as day, rn,
            '<PROCEDURE_QUAL>0</PROCEDURE_QUAL>' || {tag("PROCEDURE_CODE", "procedure_code")}
            || {tag("PROCEDURE_CODE_DATE", "procedure_code_date")}
            || {tag("SORT_ORDER", "sort_order")} as item
        from (select *, row_number() over (partition by claim_fact_key order by
                sort_order nulls first, procedure_code nulls first, procedure_code_date) as rn
              from want_procedure) numbered""",
    "want_other_list": list_of(
        "want_other_items", "other_diagnosis_list", "OTHER_DIAGNOSIS", "OTHER_DIAGNOSIS_LIST"
    ),
    "want_cause_list": list_of(
        "want_cause_items", "external_cause_of_injury_list", "DIAGNOSIS",
        "EXTERNAL_CAUSE_OF_INJURY_LIST",
    ),
    "want_reason_list": list_of(
        "want_reason_items", "patients_reason_for_visit_list", "DIAGNOSIS",
        "PATIENTS_REASON_FOR_VISIT_LIST",
    ),
    "want_plain_list": list_of(
        "want_plain_items", "diagnosis_code_list", "DIAGNOSIS", "DIAGNOSIS_LIST"
    ),
    "want_procedure_list": list_of(
        "want_procedure_items", "other_procedure_list", "PROCEDURE", "OTHER_PROCEDURE_LIST"
    ),
}

MEMBER_TEXT = (
    "sub_id patient_gender_id patient_last_name patient_first_name patient_middle_name "
    "patient_name_suffix relationship_to_sub group_id group_name sub_last_name sub_first_name "
    "sub_middle_name sub_name_suffix patient_address_1 patient_address_2 patient_city "
    "patient_state patient_zip patient_zip_plus_4 patient_country"
).split()
HEADER_TEXT = (
    "claim_id patient_control_number sub_medicare_id assignment_of_benefits claim_id_orig"
).split()
HEADER_PLAIN = (
    "claim_fact_key payer_short admit_date discharge_date date_received_client cv_us_only_yn "
    "endorsement_eff_time is_adjusted_claim is_voided"
).split()
AMOUNTS = (
    "billed noncovered allowed paid coinsurance copay deductible patient_liability"
).split()


def shared_expressions() -> dict[str, str]:
    sub = {"sub_address_1": "address_1", "sub_adddress_2": "address_2"} | {
        f"sub_{c}": c for c in ("city", "state", "zip", "zip_plus_4", "country", "gender_id")
    }
    ssn = "replace(coalesce(m.patient_ssn, ''), '-', '')"
    return (
        {c: f"coalesce(m.{c}, '')" for c in MEMBER_TEXT}
        | {c: f"coalesce(h.{c}, '')" for c in HEADER_TEXT}
        | {c: f"h.{c}" for c in HEADER_PLAIN}
        | {c: f"coalesce(m.patient_{s}, '')" for c, s in sub.items()}
        | {f"claim_{a}_amount": f"t.claim_{a}_amount" for a in AMOUNTS}
        | {
            "claim_type_name": "coalesce(upper(h.claim_type_name), '')",
            "patient_id": "coalesce(i.patient_id, '')",
            "patient_ssn": ssn, "sub_ssn": ssn,
            "patient_dob": "m.patient_dob", "sub_dob": "m.patient_dob",
            "patient_death_date": "m.patient_death_date",
        }
    )


def institutional_expressions() -> dict[str, str]:
    rendered = (
        "provider_id subspec_id entity_type last_name first_name middle_name name_suffix "
        "street_address_1 street_address_2 city state zip zip_plus_4 country"
    ).split()
    billed = "entity_type city state zip zip_plus_4 country".split()
    referred = "provider_id npi subspec_id last_name first_name middle_name name_suffix".split()
    return (
        shared_expressions()
        | {f"rendering_{c}": f"coalesce(r.{c}, '')" for c in rendered}
        | {f"billing_{c}": f"b.{c}" for c in billed}
        | {f"referring_{c}": f"f.{c}" for c in referred}
        | {
            "claim_type": "h.bill_type",
            "bill_type": "right('0000' || coalesce(h.bill_type, ''), 4)",
            "claim_dos_from": "coalesce(h.claim_dos_from, date '1900-01-01')",
            "claim_dos_to": "coalesce(h.claim_dos_to, date '1900-01-01')",
            "discharge_status": "coalesce(h.discharge_status, '')",
            "sub_drg": "coalesce(g.sub_drg, '')", "allowed_drg": "coalesce(g.allowed_drg, '')",
            "principal_diagnosis_qual": "case when h.principal_diagnosis is null then '' else '0' end",
            "principal_diagnosis": "coalesce(h.principal_diagnosis, '')",
            "principal_diagnosis_poa": "h.principal_diagnosis_poa",
            "admitting_diagnosis_qual": "case when h.admitting_diagnosis is null then '' else '0' end",
            "admitting_diagnosis": "coalesce(h.admitting_diagnosis, '')",
            "principal_procedure_qual": "case when h.principal_procedure is null then '' else '0' end",
            "principal_procedure": "coalesce(h.principal_procedure, '')",
            "principal_procedure_date": "h.principal_procedure_date",
            "other_diagnosis_list": "l1.other_diagnosis_list",
            "external_cause_of_injury_list": "l2.external_cause_of_injury_list",
            "patients_reason_for_visit_list": "l3.patients_reason_for_visit_list",
            "other_procedure_list": "l4.other_procedure_list",
            "rendering_taxgroup_id": "coalesce(r.taxgroup_id, b.taxgroup_id)",
            "rendering_npi": "r.npi",
            "rendering_taxonomy_code": "coalesce(r.subspec_id, '')",
            "billing_provider_id": "coalesce(b.provider_id, '')",
            "billing_taxgroup_id": "replace(coalesce(b.taxgroup_id, ''), '-', '')",
            "billing_subspec_id": "coalesce(b.subspec_id, '')",
            "billing_taxonomy_code": "coalesce(b.subspec_id, '')",
            "billing_name": "b.last_name",
            "billing_address_1": "b.street_address_1", "billing_address_2": "b.street_address_2",
            "length_of_stay": "h.length_of_stay",
            "medicare_provider_id": "coalesce(s.medicare_provider_id, '')",
            "date_adjudicated": "h.date_adjudicated",
            "referring_taxonomy_code": "f.subspec_id",
        }
    )


def professional_expressions() -> dict[str, str]:
    return shared_expressions() | {
        "claim_type": "case when b.subspec_id = '261QA1903X' then 'A' else 'P' end",
        "diagnosis_code_list": "l1.diagnosis_code_list",
        "claim_paid_date": "y.claim_paid_date",
    }


def wide_select(kind: str, expressions: dict[str, str]) -> str:
    """Every column of a wide table: cast and cut where filled, the default where not."""
    columns = []
    for column in LAYOUTS[kind]:
        value = expressions.get(column.name.lower())
        sql_type = {"string": "varchar", "timestamp_ntz": "timestamp"}.get(column.kind, column.kind)
        if value is None:
            value = "''" if column.default == "" else f"cast(null as {sql_type})"
        elif column.is_decimal:
            value = f"try_cast({value} as {sql_type})"
        elif column.width is not None:
            value = f"left({value}, {column.width})"
        columns.append(f'{value} as "{column.name}"')
    return "select " + ",\n".join(columns)


def joined(*parts: tuple[str, str]) -> str:
    return "\n".join(
        f"left join {table} {alias} on h.claim_fact_key = {alias}.claim_fact_key"
        for table, alias in parts
    )


def number_ok(value: str, kind: str) -> str:
    return f"({value} is null or try_cast({value} as {kind}) is not null)"


SHARED_JOINS = (
    ("want_member", "m"), ("want_member_id", "i"), ("want_billing", "b"), ("want_rendering", "r"),
    ("want_drg", "g"), ("want_amounts", "t"),
)
INSTITUTIONAL_JOINS = joined(
    *SHARED_JOINS, ("want_supplier_id", "s"), ("want_referring", "f"),
    ("want_other_list", "l1"), ("want_cause_list", "l2"), ("want_reason_list", "l3"),
    ("want_procedure_list", "l4"),
)
LIABILITY_OK = number_ok("t.claim_patient_liability_amount", "decimal(10,2)")
BAD_NUMBER = (
    f"not ({number_ok('r.npi', 'decimal(10,0)')} and {number_ok('f.npi', 'decimal(10,0)')} and {LIABILITY_OK})"
)
INSTITUTIONAL_FROM = (
    f"from want_header h\n{INSTITUTIONAL_JOINS}\n"
    "where upper(h.claim_type_name) = 'INSTITUTIONAL'"
)
CDS_INSTITUTIONAL = (
    wide_select("INSTITUTIONAL", institutional_expressions())
    + f"\n{INSTITUTIONAL_FROM} and not ({BAD_NUMBER})"
)
REJECTED_INSTITUTIONAL = f"""
    select cast(h.claim_fact_key as decimal(19,0)) as "CLAIM_FACT_KEY", h.claim_id as "CLAIM_ID",
        upper(h.claim_type_name) as "CLAIM_TYPE_NAME", concat_ws(',',
        case when not {number_ok("r.npi", "decimal(10,0)")} then 'RENDERING_NPI' end,
        case when not {number_ok("f.npi", "decimal(10,0)")} then 'REFERRING_NPI' end,
        case when not {LIABILITY_OK} then 'CLAIM_PATIENT_LIABILITY_AMOUNT' end)
        as reject_reason
    {INSTITUTIONAL_FROM} and {BAD_NUMBER}"""
PROFESSIONAL_FROM = (
    "from want_header h\n"
    + joined(*SHARED_JOINS, ("want_payment", "y"), ("want_plain_list", "l1"))
    + "\nwhere upper(h.claim_type_name) = 'PROFESSIONAL'"
)
CDS_PROFESSIONAL = (
    wide_select("PROFESSIONAL", professional_expressions())
    + f"\n{PROFESSIONAL_FROM} and {LIABILITY_OK}"
)
REJECTED_PROFESSIONAL = f"""
    select cast(h.claim_fact_key as decimal(19,0)) as "CLAIM_FACT_KEY", h.claim_id as "CLAIM_ID",
        upper(h.claim_type_name) as "CLAIM_TYPE_NAME",
        'CLAIM_PATIENT_LIABILITY_AMOUNT' as reject_reason
    {PROFESSIONAL_FROM} and not {LIABILITY_OK}"""


def overflow_sql(lists: list[tuple[str, str, int]]) -> str:
    """Claims with more list entries than slots; lists are (table, list name, slots)."""
    return " union all ".join(
        f"select claim_fact_key, '{name}' as list, count(*) as entries, count(*) - {slots} as without_slot "
        f"from {table} group by claim_fact_key having count(*) > {slots}"
        for table, name, slots in lists
    )



BILL_CODE = "left(replace(ltrim(replace(c.\"BILL_TYPE\", '0', ' ')), ' ', '0'), 2)"
CROSSWALK = (
    "(select coalesce(k.value, '') from lookup k where k.int_id = 'INT005' "
    f"and k.type = 'BILL_TYPE' and k.code = {BILL_CODE})"
)


def field_sql(field) -> str:
    if field.side == "lookup":
        return CROSSWALK
    column = f'{"c" if field.side == "claim" else "l"}."{field.name}"'
    if field.form == "date":
        column = f"strftime({column}, '%Y%m%d')"
    elif field.form == "number":
        column = f"cast({column} as varchar)"
    return f"coalesce({column}, '')"


def extract_sql(
    kind: str,
    window: tuple[str, str] | None = None,
    numbers: tuple[int, int] | None = None,
    claims: str | None = None,
) -> str:
    """The record of each due line; no lookup row for the bill type leaves no record at all."""
    record = f"concat_ws('|', {', '.join(field_sql(f) for f in RECORDS[kind])})"
    if any(f.side == "lookup" for f in RECORDS[kind]):
        record = f"case when {CROSSWALK} is not null then {record} end"
    bounds = ""
    if window:
        bounds += f" and c.created_date between timestamp '{window[0]}' and timestamp '{window[1]}'"
    if numbers:
        bounds += f" and c.seq_no between {numbers[0]} and {numbers[1]}"
    return f"""
        select c.claim_fact_key as claim_fact_key, l.claim_line_fact_key, {record} as claim_data
        from audit a
        join {claims or f"claims_{kind.lower()}"} c on a.claim_number = c.claim_fact_key
        join lines_{kind.lower()} l on c.claim_fact_key = l.claim_fact_key
        where upper(a.insert_status) = 'SUCCESS' and rtrim(coalesce(a.extract_status, '')) = ''{bounds}"""


def pipe_count_sql(kind: str) -> str:
    """Rows whose text holds a pipe per text field, over the claims and lines that extracts read."""
    counted = []
    for side, source in (("claim", "claims"), ("line", "lines")):
        fields = sorted({f.name for f in RECORDS[kind] if f.side == side and f.form == "text"})
        counts = ", ".join(f"""sum(case when "{n}" like '%|%' then 1 else 0 end) as "{n}" """ for n in fields)
        # DuckDB's unpivot takes columns by name only.
        listed = ", ".join(f'"{n}"' for n in fields)
        bound = f"and claim_fact_key in (select claim_fact_key from claims_{kind.lower()})"
        counted.append(f"""
            select '{kind}' as kind, '{side}' as side, field, rows, cast(with_pipe as bigint) as with_pipe
            from (unpivot (
                select count(*) as rows, {counts} from {source}_{kind.lower()}
                where claim_fact_key in (select claim_number from audit
                    where upper(insert_status) = 'SUCCESS' and rtrim(coalesce(extract_status, '')) = '')
                    {bound if side == "line" else ""}
            ) on {listed} into name field value with_pipe)""")
    return " union all ".join(counted)


def slots_sql(groups: list[tuple[str, str, int, int, list[tuple[str, str]]]]) -> str:
    """Numbered slots by conditional maximum, for every claim that has any list entry."""
    columns, tables = [], []
    for number, (table, name, first, last, extra) in enumerate(groups):
        alias = f"s{number}"
        picks = []
        for n in range(first, last + 1):
            parts = [(f"{name}_{n}_QUAL", "'0'"), (f"{name}_{n}", "code")]
            parts += [(f"{name}_{n}_{suffix}", value) for suffix, value in extra]
            for column, value in parts:
                picks.append(
                    f'max(case when rn = {n - first + 1} then {value} end) as "{column}"'
                )
                columns.append(f'{alias}."{column}"')
        tables.append(
            f"left join (select claim_fact_key, {', '.join(picks)} from {table} "
            f"group by claim_fact_key) {alias} on k.claim_fact_key = {alias}.claim_fact_key"
        )
    return columns, tables


def institutional_slots() -> str:
    columns, tables = slots_sql(
        [
            ("want_other_items", "OTHER_DIAGNOSIS_CODE", 2, 25, [("POA", "poa")]),
            ("want_cause_items", "EXTERNAL_CAUSE_OF_INJURY", 1, 12, [("POA", "poa")]),
            ("want_reason_items", "PATIENTS_REASON_FOR_VISIT", 1, 3, []),
            (
                "want_procedure_items", "OTHER_PROCEDURE", 2, 25,
                [("DATE", "cast(strptime(day, '%Y%m%d') as date)")],
            ),
        ]
    )
    return (
        f"select k.claim_fact_key, {', '.join(columns)} from (select claim_fact_key from "
        "want_diagnosis union select claim_fact_key from want_procedure) k\n" + "\n".join(tables)
    )


def professional_slots() -> str:
    columns, tables = slots_sql([("want_plain_items", "DIAGNOSIS_CODE", 1, 24, [])])
    return (
        f"select k.claim_fact_key, {', '.join(columns)} from (select distinct claim_fact_key from "
        "want_diagnosis) k\n" + "\n".join(tables)
    )


def built_sql(wide: str, slots: str) -> str:
    """Staged claims made from a wide table and its slots."""
    return f"""
        select w.* replace (cast(w."CLAIM_FACT_KEY" as bigint) as "CLAIM_FACT_KEY"),
            k.* exclude (claim_fact_key), timestamp '{AS_OF}' as created_date,
            cast(w."CLAIM_FACT_KEY" as bigint) as seq_no
        from ({wide}) w left join ({slots}) k on w."CLAIM_FACT_KEY" = k.claim_fact_key"""


PARTS |= {
    "built_professional": built_sql(CDS_PROFESSIONAL, professional_slots()),
    "built_institutional": built_sql(CDS_INSTITUTIONAL, institutional_slots()),
}

FINAL = {
    "soft_delete_filter": f"select claim_fact_key, deleted_flag from all_claim_fact c where {live('c')}",
    "status_not_in": f"""select member_history_fact_key, member_status
        from all_member_version_hist_fact where {settled("member_status")}""",
    "audit_gate": """select claim_number, extract_status from audit
        where upper(insert_status) = 'SUCCESS' and rtrim(coalesce(extract_status, '')) = ''""",
    "extract_window": f"""select claim_fact_key, seq_no, created_date from claims_professional
        where created_date between timestamp '{WINDOW[0]}' and timestamp '{WINDOW[1]}'
            and seq_no between {SLICE[0]} and {SLICE[1]}""",
    "claim_type_filter": """select claim_fact_key, upper(claim_type_name) as claim_type_name
        from all_claim_fact where upper(claim_type_name) = 'PROFESSIONAL'""",
    "null_default": """select member_history_fact_key,
        coalesce(member_middle_name, '') as middle_name,
        coalesce(subscriber_middle_name, '') as subscriber_middle_name,
        coalesce(member_gender_code, '') as gender from all_member_version_hist_fact""",
    "coalesce_ids": """select member_key, hicn, coalesce(mbi, hicn) as medicare_id
        from medicare_hicn_info_fact""",
    "fixed_width_trim": """select claim_fact_key, left(patient_account_number, 24) as control_number,
        left(type_of_bill_code, 2) as bill_prefix, left(benefit_assignment, 1) as assignment
        from all_claim_fact""",
    "strip_dashes": """select member_history_fact_key, replace(tax_id, '-', '') as ssn
        from all_member_version_hist_fact""",
    "date_112": """select claim_fact_key, strftime(endorsement_eff_time, '%Y%m%d') as day_text
        from all_claim_fact""",
    "number_to_text": """select claim_line_fact_key, cast(billed_amount as varchar) as billed_text,
        cast(claim_fact_key as varchar) as key_text, cast(base_copay_amount as varchar) as copay_text
        from all_claim_line_fact""",
    "npi_cast": """select practitioner_key, version_eff_date_key,
        try_cast(left(practitioner_npi, 10) as decimal(10,0)) as npi,
        case when practitioner_npi is not null
             and try_cast(left(practitioner_npi, 10) as decimal(10,0)) is null
             then 'not a number' end as fault
        from all_practitioner_history_fact""",
    "bill_type_pad": """select claim_fact_key, right('0000' || coalesce(type_of_bill_code, ''), 4)
        as bill_type from all_claim_fact""",
    "poa_normalise": f"""select c.claim_fact_key, {POA} as poa from all_claim_fact c
        left join diagnosis_poa_indicator_code p
            on c.primary_diagnosis_poa_ind_key = p.diagnosis_poa_indicator_key""",
    "presence_qualifier": """select claim_fact_key,
        case when principal_procedure_code is null then '' else '0' end as procedure_qual
        from all_claim_fact""",
    "claim_type_from_taxonomy": """select claim_fact_key, case when subspec_id = '261QA1903X' then 'A'
        else 'P' end as claim_type from want_billing""",
    "filtered_left_join": f"""select c.claim_fact_key, d.standardized_diagnosis_code
        from all_claim_fact c
        left join diagnosis d on c.primary_diagnosis_code = d.diagnosis_code and {live("d")}""",
    "date_roles": """select claim_fact_key, principal_procedure_date, claim_dos_from, claim_dos_to,
        admit_date, discharge_date, date_received_client from (select distinct claim_fact_key,
        principal_procedure_date, claim_dos_from, claim_dos_to, admit_date, discharge_date,
        date_received_client from want_header) h""",
    "prior_claim_id": f"""select c.claim_fact_key, v.claim_hcc_id as prior_id
        from all_claim_fact c left join all_claim_fact v
            on c.previous_final_claim_fact_key = v.claim_fact_key and {live("v")}
        where {live("c")}""",
    "conditional_date_join": """select claim_fact_key, sub_medicare_id, date_adjudicated
        from want_header""",
    "asof_left_join": f"""select c.claim_fact_key, s.drg_code from all_claim_fact c
        left join drg_history_fact s on c.submitted_drg_key = s.drg_key
            and {in_force("s", "c.statement_start_date_key")} and {settled("s.drg_status")}
            and {live("s")}""",
    "asof_inner_join": f"""select c.claim_fact_key, v.member_history_fact_key from all_claim_fact c
        join all_member_version_hist_fact v on c.member_key = v.member_key
        where {in_force("v", "c.statement_start_date_key")} and {settled("v.member_status")}
            and {live("v")}""",
    "claim_drg": "select * from want_drg",
    "split_line_anti_join": "select claim_fact_key, claim_line_fact_key from want_lines",
    "claim_amounts": "select * from want_amounts",
    "latest_payment": "select * from want_payment",
    "first_line_practitioner": "select * from want_first_line",
    "supplier_other_id": "select * from want_supplier_id",
    "member_other_id": "select * from want_member_id",
    "billing_provider": "select * from want_billing",
    "referring_provider": "select * from want_referring",
    "rendering_provider": "select * from want_rendering",
    "claim_diagnosis": "select * from want_diagnosis",
    "claim_procedure": "select * from want_procedure",
    "other_diagnosis_list": "select * from want_other_list",
    "external_cause_list": "select * from want_cause_list",
    "reason_for_visit_list": "select * from want_reason_list",
    "procedure_list": "select * from want_procedure_list",
    "professional_diagnosis_list": "select * from want_plain_list",
    "list_renumber": """select claim_fact_key, cast(rn as integer) as position, code, poa
        from want_cause_items""",
    "slots_institutional": institutional_slots(),
    "slots_professional": professional_slots(),
    "bill_type_crosswalk": f"""select c.claim_fact_key, c."BILL_TYPE" as bill_type,
        {CROSSWALK} as translated from claims_institutional c""",
    "claim_details": "select * from want_header",
    "member_details": "select * exclude (start_key) from want_member",
    "cds_institutional": CDS_INSTITUTIONAL,
    "cds_professional": CDS_PROFESSIONAL,
    "cds_rejected": REJECTED_INSTITUTIONAL,
    "cds_rejected_professional": REJECTED_PROFESSIONAL,
    "cds_selected": f"""select * from ({CDS_PROFESSIONAL}) w where w."CLAIM_FACT_KEY" in
        (select previous_final_claim_fact_key from all_claim_fact)""",
    "claim_copies": """select claim_fact_key, count(*) as copies from want_header
        group by claim_fact_key having count(*) > 1""",
    "slot_overflow": overflow_sql(
        [
            ("want_other_items", "other_diagnosis", 24), ("want_cause_items", "external_cause", 12),
            ("want_reason_items", "reason_for_visit", 3), ("want_procedure_items", "other_procedure", 24),
        ]
    ),
    "slot_overflow_by_kind": "select *, 'INSTITUTIONAL' as kind from ("
    + overflow_sql(
        [
            ("want_other_items", "other_diagnosis", 24), ("want_cause_items", "external_cause", 12),
            ("want_reason_items", "reason_for_visit", 3), ("want_procedure_items", "other_procedure", 24),
        ]
    )
    + ") union all select *, 'PROFESSIONAL' as kind from ("
    + overflow_sql([("want_plain_items", "diagnosis", 24)])
    + ")",
    "lookup_copies": """select code, count(*) as copies from lookup
        where int_id = 'INT005' and type = 'BILL_TYPE' group by code""",
    "pipe_record": """select c.claim_fact_key, concat_ws('|', coalesce(c."PAYER_SHORT", ''),
        coalesce(c."CLAIM_TYPE", ''), coalesce(strftime(c."PATIENT_DOB", '%Y%m%d'), ''),
        coalesce(cast(c."PATIENT_WEIGHT" as varchar), ''), coalesce(c."CLAIM_ID", '')) as record
        from claims_professional c""",
    "extract_professional": extract_sql("PROFESSIONAL"),
    "extract_institutional": extract_sql("INSTITUTIONAL"),
    "record_pipe_count": f"{pipe_count_sql('INSTITUTIONAL')} union all {pipe_count_sql('PROFESSIONAL')}",
    "built_records_professional": extract_sql("PROFESSIONAL", claims="built_professional"),
    "built_records_institutional": extract_sql("INSTITUTIONAL", claims="built_institutional"),
    "extract_slice": extract_sql("PROFESSIONAL", WINDOW, SLICE),
    "cds_outcomes": f"""select "CLAIM_FACT_KEY", 'accepted' as outcome, cast(null as varchar) as reject_reason
        from ({CDS_PROFESSIONAL}) w union all
        select "CLAIM_FACT_KEY", 'rejected' as outcome, reject_reason from ({REJECTED_PROFESSIONAL}) r""",
    "extract_laid_out": extract_sql("PROFESSIONAL", WINDOW, SLICE),
    "published_slice": f"select claim_data from ({extract_sql('PROFESSIONAL', WINDOW, SLICE)}) s",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, PARTS) for name, sql in FINAL.items()}
