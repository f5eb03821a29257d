"""Definitions of the census tables in SQL that Spark and DuckDB share."""

from __future__ import annotations

from datetime import date, timedelta

YEAR_SHIFT = 28  # ship and order years 1995–2001 become academic years 2023–2029

# offset of the source id, unit type, offset of the parent (None: no parent)
LEVELS = [
    (0, "District", None), (100, "County", 0), (200, "Municipality", 0), (300, "City", 0),
    (400, "Sub County", 100), (500, "Town Council", 200), (600, "Parish", 400), (700, "Ward", 500),
    (800, "Village", 600),
]


def _units(select_extra: str, changed: bool) -> str:
    """One SELECT per level. City 7 shares County 7's source id and belongs to district 8;
    Ward 9 is no longer current."""
    parts = []
    for offset, kind, parent in LEVELS:
        up = "CAST(NULL AS BIGINT)" if parent is None else f"CAST(n_nationkey + {parent} AS BIGINT)"
        source = f"n_nationkey + {offset}"
        if kind == "City":
            up = "CAST(CASE WHEN n_nationkey = 7 THEN 8 ELSE n_nationkey END AS BIGINT)"
            source = "CASE WHEN n_nationkey = 7 THEN 107 ELSE n_nationkey + 300 END"
        name = f"'{kind} ' || n_name"
        if changed:
            name = f"CASE WHEN n_regionkey = 2 THEN 'New {kind} ' || n_name ELSE {name} END"
        live = "n_nationkey <> 9" if kind == "Ward" else "TRUE"
        parts.append(
            f"SELECT CAST(n_nationkey + {10000 + offset} AS BIGINT) AS id, {up} AS parent, "
            f"'{kind}' AS admin_unit_type, {name} AS name, "
            f"'{kind[:2]}' || CAST(n_nationkey AS STRING) AS admin_unit_code, "
            f"CAST(n_regionkey AS STRING) AS voting_code, {live} AS live, "
            f"CAST({source} AS BIGINT) AS source_id FROM {{nation}}"
        )
    return f"SELECT {select_extra} FROM (" + " UNION ALL ".join(parts) + ") AS u"


def _choose(expr: str, *labels: str | None) -> str:
    """CASE over 0, 1, 2 … ; ``None`` leaves the value NULL."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(labels) if v is not None)
    return f"CASE {expr} {whens} END"


def _known(test: str, key: str) -> str:
    """The key where the test holds, elsewhere one that no other table has."""
    return f"CASE WHEN {test} THEN {key} ELSE -1 - {key} END"


def _flag(expr: str) -> str:
    """Three-valued flag of an integer expression: 0 true, 1 false, else unknown."""
    return f"CASE ({expr}) % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END"


def _md5(columns: dict[str, str]) -> str:
    inner = ", ".join(f"coalesce(CAST({c} AS STRING), '{d}')" for c, d in columns.items())
    return f"md5(concat_ws('|', {inner}))"


def _setting(name_expr: str, table: str = "region", extra: str = "") -> str:
    key = f"{table[0]}_{table}key"
    return f"SELECT CAST({key} AS BIGINT) AS id, {name_expr} AS name{extra} FROM {{{table}}}"


def _versions(columns: dict[str, str], tail: str, base: str, ident: str, changed: str, hashed: dict[str, str],
              later: dict[str, str], from_date: str = "2022-01-01", change_date: str = "2024-06-01") -> str:
    """A dimension with one version per row and a second one where ``changed`` holds."""
    first = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    second = ", ".join(f"{later.get(c, e)} AS {c}" for c, e in columns.items())
    names = ", ".join(columns)
    last_day = date.fromisoformat(change_date) - timedelta(days=1)
    return (
        f"SELECT id, {names}, effective_date, expiration_date, is_current, {_md5(hashed)} AS change_hash, "
        f"'INITIAL_LOAD' AS change_reason, 'INITIAL_LOAD' AS changed_fields{tail} FROM ("
        f"SELECT {ident} AS id, {first}, DATE '{from_date}' AS effective_date, "
        f"CASE WHEN {changed} THEN DATE '{last_day}' ELSE DATE '9999-12-31' END AS expiration_date, "
        f"NOT ({changed}) AS is_current FROM {{{base}}} "
        f"UNION ALL SELECT {ident} + 1 AS id, {second}, DATE '{change_date}', DATE '9999-12-31', TRUE "
        f"FROM {{{base}}} WHERE {changed}) AS v"
    )


TERM_BY_MONTH = (
    "CASE WHEN month({d}) >= 9 THEN 'TERM 3' WHEN month({d}) >= 6 THEN 'TERM 2' ELSE 'TERM 1' END"
)


def _term(day: str) -> str:
    return TERM_BY_MONTH.format(d=day)


def _year(day: str) -> str:
    return f"CAST(year({day}) + {YEAR_SHIFT} AS INT)"


DISABILITY_FLAGS = [
    "is_visual_yn", "is_hearing_yn", "is_walking_yn", "is_self_care_yn", "is_remembering_yn", "is_communication_yn",
]
SCHOOL_TYPE = _choose("r_regionkey", "PRE-PRIMARY", "PRIMARY", "SECONDARY", "CERTIFICATE", "DIPLOMA")

SCHOOL_COLUMNS = {
    "source_id": "s_suppkey",
    "name": "s_name",
    "admin_unit_id": "CAST(10000 + (s_suppkey % 9) * 100 + s_nationkey AS BIGINT)",
    "emis_number": "CASE WHEN s_acctbal < 300 THEN NULL WHEN s_acctbal < 900 THEN 'E' "
                   "ELSE 'E' || CAST(s_suppkey AS STRING) END",
    "school_type": _choose("s_suppkey % 5", "PRE-PRIMARY", "PRIMARY", "SECONDARY", "primary ", None),
    "operational_status": _choose("s_suppkey % 3", "OPERATIONAL", "SUSPENDED", None),
    "ownership_status": _choose("s_nationkey % 3", "GOVT AIDED", "PRIVATE", None),
    "funding_type": "CAST(s_nationkey % 4 AS STRING)",
    "sex_composition": _choose("s_suppkey % 4", "MIXED", "FEMALES ONLY", "MALES ONLY", None),
    "boarding_status": _choose("s_nationkey % 4", "DAY SCHOOL", "FULLY BOARDING", "DAY AND BOARDING", None),
    "founding_body_type": "CASE WHEN s_acctbal > 5000 THEN 'CHURCH' END",
}
SCHOOL_HASHED = dict.fromkeys([c for c in SCHOOL_COLUMNS if c != "source_id"], "")

TEACHER_HASHED = {
    "gender": "", "qualification": "", "qualification_category": "", "teacher_type": "", "designation": "",
    "highest_education_level": "", "is_on_government_payroll": "false", "discipline": "",
}
TEACHER_COLUMNS = {
    "source_id": "c_custkey * 4 + 1",
    "employee_id": "c_custkey * 10",
    "ipps_number": "CASE WHEN c_acctbal > 1000 THEN 'IPPS' || CAST(c_custkey AS STRING) END",
    "gender": _choose("c_custkey % 5", "M", "F", "M", "F", None),
    "teacher_type": _choose("c_nationkey % 4", "QUALIFIED", "TRAINED", "LICENSED", None),
    "qualification": "CASE WHEN c_nationkey < 20 THEN 'Q-' || c_mktsegment END",
    "qualification_category": "c_mktsegment",
    "designation": _choose("c_custkey % 3", "HEAD", "DEPUTY", None),
    "highest_education_level": _choose("c_nationkey % 3", "DEGREE", "DIPLOMA", None),
    "discipline": _choose("c_custkey % 4", "SCIENCE", "ARTS", "BOTH", None),
    "is_on_government_payroll": _flag("c_custkey"),
}

STAFF_HASHED = {
    "gender": "", "category": "", "role": "", "highest_education_level": "", "employment_status": "",
    "is_on_government_payroll": "false",
}
STAFF_COLUMNS = {
    "source_id": "p_partkey * 4 + 2",
    "gender": _choose("p_partkey % 5", "F", "M", "F", "M", None),
    "category": _choose("p_size % 3", "ADMINISTRATIVE", "SUPPORT", None),
    "role": "CASE WHEN p_size > 10 THEN 'ROLE ' || p_type END",
    "highest_education_level": _choose("p_size % 4", "CERTIFICATE", "DIPLOMA", "DEGREE", None),
    "employment_status": "CASE WHEN p_retailprice > 950 THEN 'PERMANENT' ELSE 'CONTRACT' END",
    "is_on_government_payroll": _flag("p_partkey"),
}

LEARNER_HASHED = {
    "gender": "", "nationality": "", "nin": "", "orphan_status": "",
    **dict.fromkeys([*DISABILITY_FLAGS, "has_multiple_disabilities_yn"], "false"),
}
LEARNER_COLUMNS = {
    "source_id": "o_orderkey * 4",
    "lin": "'LIN' || CAST(o_orderkey AS STRING)",
    "gender": _choose("o_orderkey % 7", "M", "F", "Male", "female", "M", "F", None),
    "age_at_load": "CAST(6 + o_orderkey % 12 AS INT)",
    "nationality": "CASE WHEN o_orderstatus = 'P' THEN 'KENYA' ELSE 'UGANDA' END",
    "orphan_status": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'BOTH DECEASED' ELSE 'NOT APPLICABLE' END",
    "nin": "CASE WHEN o_totalprice > 100000 THEN 'NIN' || CAST(o_orderkey AS STRING) END",
    **{f: f"(o_orderkey + {i}) % 23 = 0" for i, f in enumerate(DISABILITY_FLAGS)},
    "has_multiple_disabilities_yn": "FALSE",
}

PERIOD_MONTH = "CASE p WHEN 0 THEN 2 WHEN 1 THEN 6 WHEN 2 THEN 9 WHEN 3 THEN 5 ELSE 1 END"
INDICATOR_KEYS = "school_source_id, academic_year, term"

VIEWS: dict[str, str] = {
    # --- lookups ---------------------------------------------------------------------------
    "src_setting_school_types": _setting(
        SCHOOL_TYPE, extra=", CASE WHEN r_regionkey < 2 THEN lower(" + SCHOOL_TYPE + ") || ' school' END AS display_name"),
    "src_setting_operational_statuses": _setting("'OPERATING LIKE IN ' || r_name"),
    "src_setting_ownership_statuses": _setting("'OWNED IN ' || r_name"),
    "src_setting_founding_bodies": _setting("'FOUNDED IN ' || r_name"),
    "src_setting_funding_sources": _setting("'FUND ' || r_name"),
    "src_setting_education_levels": _setting(
        "'Level ' || r_name", extra=", CASE WHEN r_regionkey < 4 THEN CAST(r_regionkey AS BIGINT) END AS school_type_id"),
    "src_setting_education_grades": _setting(
        "CASE WHEN n_nationkey < 7 THEN 'P' || CAST(n_nationkey + 1 AS STRING) WHEN n_nationkey < 13 "
        "THEN 'S' || CAST(n_nationkey - 6 AS STRING) WHEN n_nationkey = 13 THEN 'BC' "
        "ELSE 'X' || CAST(n_nationkey AS STRING) END", "nation",
        ", CAST(n_regionkey AS BIGINT) AS education_level_id"),
    "src_setting_familiar_languages": _setting("'Language ' || r_name"),
    "src_setting_promotion_statuses": _setting("'Promoted ' || r_name"),
    "src_setting_enrolment_types": _setting(
        _choose("r_regionkey", "baseline", "New", "continuing", "Transfer", "mystery")),
    "src_setting_disability_types": _setting(
        _choose("n_nationkey % 9", "Visual impairment", "Hearing", "SELF CARE", "self_care", "Walking", "Mobility",
                "Remembering", "Communication", "Other"), "nation"),
    "src_admin_unit_countries": _setting("n_name", "nation"),
    "src_setting_identity_document_types": _setting(
        _choose("r_regionkey", "National ID", "passport", "Student Pass", "Work Permit", "Refugee Card")),
    "src_setting_teacher_types": _setting(_choose("n_nationkey % 4", "QUALIFIED", "TRAINED", "LICENSED", "OTHER"), "nation"),
    "src_setting_teacher_professional_qualifications": _setting(
        "'Qualification ' || CAST(n_nationkey % 10 AS STRING)", "nation",
        ", 'CAT ' || CAST(n_regionkey AS STRING) AS qualification_category, " + ", ".join(
            f"n_nationkey % {i + 2} = 0 AS is_for_{x}" for i, x in enumerate(
                ("pre_primary", "primary", "secondary", "certificate", "diploma", "degree")))
        + ", CASE WHEN n_nationkey = 24 THEN NULL ELSE n_nationkey > 20 END AS is_archived"),
    "src_setting_teaching_staff_designations": _setting(
        "'Designation ' || CAST(n_nationkey % 12 AS STRING)", "nation", ", CAST(n_nationkey % 7 AS BIGINT) AS school_type_id"),
    "src_setting_employment_statuses": _setting("'Employed ' || r_name"),
    "src_setting_non_teaching_staff_categories": _setting(
        _choose("r_regionkey", "ADMINISTRATIVE", "SUPPORT", "ADMINISTRATIVE", "OTHER", "SUPPORT")),
    "src_setting_non_teaching_staff_roles": _setting(
        "'Role ' || CAST(n_nationkey % 15 AS STRING)", "nation",
        ", CAST(n_regionkey AS BIGINT) AS non_teaching_staff_category_id"),
    "src_setting_school_item_categories": _setting("'Items ' || r_name"),
    "src_setting_academic_years":
        "SELECT DISTINCT CAST(year(o_orderdate) - 1994 AS BIGINT) AS id, CASE WHEN year(o_orderdate) = 2001 "
        f"THEN 'CURRENT YEAR' ELSE 'ACADEMIC YEAR ' || CAST(year(o_orderdate) + {YEAR_SHIFT} AS STRING) END AS name "
        "FROM {orders}",
    "src_setting_teaching_periods": _setting(_choose("r_regionkey", "1", "2", "3", "Term 2", "X")),
    "src_academic_year_teaching_periods":
        "SELECT CAST(y * 100 + p * 10 + s AS BIGINT) AS id, CAST(y AS BIGINT) AS academic_year_id, "
        "CAST(p AS BIGINT) AS teaching_period_id, CASE WHEN s = 2 THEN CAST(y AS BIGINT) END AS school_id, "
        "CAST(2 - s AS BIGINT) AS school_type_id, "
        f"make_date(CAST(y + 1994 + {YEAR_SHIFT} AS INT), CAST({PERIOD_MONTH} AS INT), CAST(s + 1 AS INT)) AS start_date, "
        "CASE WHEN p = 1 AND y = 3 THEN 'closed' ELSE 'active' END AS status FROM ("
        "SELECT DISTINCT year(o_orderdate) - 1994 AS y, CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS p, "
        "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS s FROM {orders}) AS t",
    # --- units and schools -------------------------------------------------------------------
    "dw_admin_units_dim": _units(
        "id, parent AS child_id, admin_unit_type, name, admin_unit_code, voting_code, "
        "DATE '2022-01-01' AS effective_date, CASE WHEN live THEN DATE '9999-12-31' ELSE DATE '2023-12-31' END "
        "AS expiration_date, live AS current_status, source_id", False),
    "stg_admin_units_raw": _units("parent AS parent_id, admin_unit_type, name, admin_unit_code, voting_code, source_id", True),
    "src_admin_unit_districts": "SELECT CAST(n_nationkey AS BIGINT) AS id, '  district ' || lower(n_name) AS name, "
                                "n_nationkey = 3 AS is_archived_yn FROM {nation}",
    "src_admin_unit_upper_local_governments":
        "SELECT CAST(n_nationkey + 50 AS BIGINT) AS id, CAST(n_nationkey AS BIGINT) AS district_id FROM {nation}",
    "src_schools":
        "SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_acctbal < 300 THEN NULL WHEN s_acctbal < 1500 "
        "THEN 'E' || CAST(s_nationkey AS STRING) ELSE 'E-' || CAST(s_suppkey AS STRING) END AS emis_number, "
        "s_suppkey % 6 AS school_type_id, " + _flag("s_suppkey") + " AS is_government_owned_yn, "
        + _flag("s_nationkey") + " AS has_male_students, " + _flag("s_suppkey + s_nationkey") + " AS has_female_students, "
        "CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_nationkey % 5 AS BIGINT) END AS school_ownership_status_id, "
        "CAST(s_nationkey % 6 AS BIGINT) AS funding_source_id, s_suppkey % 7 AS operational_status_id, "
        "CAST(s_nationkey % 8 AS BIGINT) AS founding_body_id, "
        "CASE s_suppkey % 5 WHEN 0 THEN CAST(600 + s_nationkey AS BIGINT) WHEN 1 THEN CAST(99999 AS BIGINT) END AS parish_id, "
        "CASE WHEN s_suppkey % 3 = 0 THEN CAST(400 + s_nationkey AS BIGINT) END AS sub_county_id, "
        "CASE WHEN s_suppkey % 4 = 0 THEN CAST(100 + s_nationkey AS BIGINT) END AS county_id, "
        "CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_nationkey AS BIGINT) END AS district_id, "
        "CAST(900 + s_nationkey % 5 AS BIGINT) AS region_id, "
        "CASE WHEN s_suppkey % 14 = 0 THEN CAST(700 + s_nationkey AS BIGINT) END AS admin_unit_id FROM {supplier}",
    "stg_schools_raw": "SELECT * FROM {src_schools}",
    **{
        f"src_{kind}": f"SELECT s_suppkey AS school_id, {_flag(f's_suppkey + s_nationkey + {i}')} AS admits_day_scholars_yn, "
                       f"{_flag(f's_suppkey * 2 + {i}')} AS admits_boarders_yn FROM {{supplier}} WHERE {where}"
        for i, (kind, where) in enumerate({
            "pre_primary_schools": "s_acctbal < 2500", "primary_schools": "s_acctbal BETWEEN 1500 AND 4500",
            "secondary_schools": "s_acctbal BETWEEN 4000 AND 6000",
            "international_schools": "s_acctbal BETWEEN 5500 AND 6500",
            "diploma_awarding_schools": "s_acctbal > 6000", "certificate_awarding_schools": "s_acctbal > 7500",
        }.items())
    },
    "dw_schools_dim": _versions(
        SCHOOL_COLUMNS, "", "supplier", "s_suppkey * 10", "s_acctbal < 3000", SCHOOL_HASHED,
        {"name": "s_name || ' (renamed)'"}),
    "stg_schools_flat":
        "SELECT source_id, CASE WHEN sex_composition = 'MIXED' THEN name || ' New' ELSE name END AS name, "
        "CASE WHEN source_id % 11 = 0 THEN CAST(10007 AS BIGINT) ELSE admin_unit_id END AS admin_unit_id, emis_number, "
        "school_type, CASE WHEN operational_status IS NULL THEN 'CLOSED' ELSE operational_status END AS operational_status, "
        "ownership_status, funding_type, sex_composition, "
        "CASE WHEN boarding_status = 'DAY SCHOOL' THEN 'FULLY BOARDING' ELSE boarding_status END AS boarding_status, "
        "founding_body_type, DATE '2025-01-15' AS effective_date FROM {dw_schools_dim} WHERE is_current "
        "UNION ALL SELECT s_suppkey + 1000000, s_name, CAST(10000 + s_nationkey AS BIGINT), "
        "'N' || CAST(s_suppkey AS STRING), 'PRIMARY', NULL, NULL, NULL, NULL, NULL, NULL, DATE '2025-01-15' "
        "FROM {supplier} WHERE s_acctbal > 9000",
    "dw_school_location_details_dim":
        "SELECT s_suppkey AS id, " + _known("s_acctbal > 500", "s_suppkey") + " AS school_id, 'Plot ' || CAST(s_nationkey AS STRING) AS physical_address, "
        "CAST(NULL AS STRING) AS postal_address, CAST(10000 + s_nationkey AS BIGINT) AS admin_unit_id, "
        "CAST(s_nationkey AS DOUBLE) AS latitude, CAST(s_suppkey AS DOUBLE) AS longitude, "
        "DATE '2022-01-01' AS effective_date, DATE '9999-12-31' AS expiration_date, TRUE AS is_current, "
        "DATE '2021-12-01' AS date_created FROM {supplier}",
    "stg_school_location_details_raw":
        "SELECT s_suppkey + 7 AS id, s_suppkey AS school_id, CASE WHEN s_acctbal < 4000 THEN 'Road ' ELSE 'Plot ' END "
        "|| CAST(s_nationkey AS STRING) AS physical_address, CAST(NULL AS STRING) AS postal_address, "
        "CAST(10000 + s_nationkey AS BIGINT) AS admin_unit_id, CAST(s_nationkey AS DOUBLE) AS latitude, "
        "CAST(s_suppkey AS DOUBLE) AS longitude, DATE '2024-01-01' AS effective_date, "
        "DATE '9999-12-31' AS expiration_date, s_acctbal > 100 AS is_current, DATE '2023-12-01' AS date_created FROM {supplier}",
    "dw_date_dim":
        "SELECT DISTINCT CAST(y * 10000 + m * 100 + dd AS BIGINT) AS id, make_date(y, m, dd) AS system_date FROM ("
        f"SELECT CAST(year(l_shipdate) + {YEAR_SHIFT} - CASE WHEN year(l_shipdate) + {YEAR_SHIFT} < 2029 THEN 0 ELSE 100 END AS INT) AS y, CAST(month(l_shipdate) AS INT) AS m, "
        "CAST(CASE WHEN day(l_shipdate) > 28 THEN 1 ELSE day(l_shipdate) END AS INT) AS dd FROM {lineitem}) AS t",
    "dw_school_fact":
        "SELECT " + _known("s_acctbal > 200", "(s_suppkey * 10 + CASE WHEN s_acctbal < 3000 THEN 1 ELSE 0 END)") + " AS school_id, "
        "CAST(20250115 AS BIGINT) AS date_id FROM {supplier} "
        "UNION ALL SELECT s_suppkey * 10, CAST(20240115 AS BIGINT) FROM {supplier} "
        "UNION ALL SELECT s_suppkey * 10 + 5, CAST(20240116 AS BIGINT) FROM {supplier} WHERE s_acctbal > 9000",
    "dw_school_district_map":
        "SELECT v.id AS school_dim_id, CAST(10000 + n_nationkey AS BIGINT) AS district_id, 'District ' || n_name AS district_name "
        "FROM {dw_schools_dim} v JOIN {supplier} s ON s.s_suppkey = v.source_id JOIN {nation} n ON n.n_nationkey = s.s_nationkey "
        "UNION ALL SELECT v.id, CAST(10008 AS BIGINT), 'District NATION_8' FROM {dw_schools_dim} v "
        "JOIN {supplier} s ON s.s_suppkey = v.source_id WHERE s.s_nationkey = 7",
    # --- people ------------------------------------------------------------------------------
    "lines":
        "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS ln, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey, "
        "min(l_shipdate) AS shipdate, CAST(min(l_quantity) AS BIGINT) AS qty, min(l_extendedprice) AS price, "
        "min(l_discount) AS discount, min(l_tax) AS tax "
        "FROM {lineitem} GROUP BY l_orderkey, l_linenumber",
    "src_persons":
        "SELECT o_orderkey * 4 AS id, 'S' || CAST(o_custkey AS STRING) AS surname, "
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS first_name, "
        "CASE WHEN o_orderpriority > '3' THEN o_orderpriority END AS other_names, "
        "CASE WHEN o_totalprice > 20000 THEN CAST(o_orderdate AS DATE) END AS birth_date, "
        + LEARNER_COLUMNS["gender"] + " AS gender, o_custkey % 30 AS country_id, 'ID' || CAST(o_orderkey AS STRING) AS id_number, "
        "CAST(NULL AS DATE) AS deleted_at FROM {orders} "
        "UNION ALL SELECT c_custkey * 4 + 1, c_name, 'T', NULL, DATE '1980-03-05', " + TEACHER_COLUMNS["gender"] + ", "
        "CAST(c_nationkey + 5 AS BIGINT), NULL, CASE WHEN c_acctbal < 100 THEN DATE '2024-01-01' END FROM {customer} "
        "UNION ALL SELECT p_partkey * 4 + 2, p_brand, NULL, p_type, DATE '1975-07-01', " + STAFF_COLUMNS["gender"] + ", "
        "CAST(p_size AS BIGINT), 'NIN' || CAST(p_partkey AS STRING), "
        "CASE WHEN p_retailprice < 905 THEN DATE '2024-01-01' END FROM {part}",
    "src_learners":
        "SELECT o_orderkey * 4 AS person_id, 'LIN' || CAST(o_orderkey AS STRING) AS lin, o_custkey % 25 AS district_of_birth_id, "
        "o_orderstatus = 'F' AS is_flagged_yn, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_father_dead, "
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN TRUE WHEN '2' THEN FALSE WHEN '3' THEN TRUE END AS is_mother_dead, "
        "CASE WHEN o_totalprice < 10000 THEN DATE '2024-02-02' END AS deleted_at, CAST(o_orderdate AS DATE) AS date_created, "
        "CAST(o_orderdate AS DATE) AS date_updated FROM {orders}",
    "src_identity_documents":
        "SELECT l_orderkey * 4 AS person_id, ln % 6 AS identity_type_id, 'D' || CAST(partkey AS STRING) AS document_id FROM {lines} "
        "UNION ALL SELECT c_custkey * 4 + 1, CAST(c_nationkey % 5 AS BIGINT), 'T' || CAST(c_custkey AS STRING) FROM {customer}",
    "src_learner_disabilities":
        "SELECT l_orderkey * 10 + ln AS id, " + _known("discount > 0.06", "l_orderkey * 4") + " AS learner_id, partkey % 27 AS disability_type_id, "
        "CAST(shipdate AS DATE) AS date_created, CAST(shipdate AS DATE) AS date_updated FROM {lines}",
    "src_learner_enrolments":
        "SELECT l_orderkey * 10 + ln AS id, l_orderkey * 4 AS learner_id, suppkey AS school_id, "
        "CAST(year(shipdate) - 1994 AS BIGINT) AS academic_year_id, "
        "CAST((year(shipdate) - 1994) * 100 + (ln % 5) * 10 + ln % 3 AS BIGINT) AS teaching_period_id, "
        "partkey % 3 AS reporting_status_id, partkey % 6 AS promotion_status_id, partkey % 26 AS education_grade_id, "
        "suppkey % 7 AS familiar_language_id, (partkey + suppkey) % 6 AS enrolment_type_id, tax > 0.02 AS is_returning_yn, "
        "CASE WHEN tax = 0 THEN NULL ELSE discount < 0.09 END AS is_enrolment_active_yn, CAST(shipdate AS DATE) AS date_created, "
        "CAST(shipdate AS DATE) AS date_updated FROM {lines}",
    "src_learner_promotions":
        "SELECT l_orderkey AS enrolment_id, l_orderkey * 4 AS learner_id, min(suppkey) AS school_id, "
        "CAST(year(shipdate) - 1994 AS BIGINT) AS academic_year_id, max(partkey) % 26 AS education_grade_id, "
        "min(partkey) % 6 AS promotion_status_id, CAST(shipdate AS DATE) AS date_created, CAST(shipdate AS DATE) AS date_updated "
        "FROM {lines} GROUP BY l_orderkey, shipdate",
    "src_learner_transitions": "SELECT * FROM {src_learner_promotions}",
    "src_school_employees":
        "SELECT c_custkey * 10 AS id, c_custkey * 4 + 1 AS person_id, CAST(c_nationkey AS BIGINT) AS school_id, "
        + _flag("c_nationkey") + " AS is_teaching_staff, 'J' || CAST(c_custkey AS STRING) AS ipps_number, "
        + _flag("c_custkey + 1") + " AS is_on_government_payroll, CAST(c_nationkey % 6 AS BIGINT) AS highest_education_level_id, "
        "CAST(c_nationkey % 7 AS BIGINT) AS employment_status_id, 'H' || CAST(c_custkey AS STRING) AS hrin, "
        "CAST(NULL AS STRING) AS hcm_employee_number, DATE '2015-01-01' AS date_started, CAST(NULL AS DATE) AS date_ended, "
        "CAST(c_nationkey AS SMALLINT) AS weekly_teaching_periods, FALSE AS is_undergoing_training, DATE '2015-01-01' AS date_created, "
        "CASE WHEN c_acctbal > 800 THEN DATE '2023-01-01' END AS date_updated FROM {customer} "
        "UNION ALL SELECT c_custkey * 10 + 1, c_custkey * 4 + 1, CAST(c_nationkey + 1 AS BIGINT), TRUE, NULL, TRUE, NULL, NULL, NULL, "
        "NULL, DATE '2020-01-01', NULL, CAST(5 AS SMALLINT), TRUE, DATE '2020-01-01', "
        "CASE WHEN c_acctbal > 4000 THEN DATE '2023-06-01' END FROM {customer} WHERE c_mktsegment < 'F' "
        "UNION ALL SELECT p_partkey * 10 + 5, p_partkey * 4 + 2, CASE WHEN p_size > 5 THEN CAST(p_size AS BIGINT) END, FALSE, "
        "'P' || CAST(p_partkey AS STRING), " + _flag("p_partkey") + ", CAST(p_size % 6 AS BIGINT), CAST(p_size % 7 AS BIGINT), NULL, "
        "'HCM' || CAST(p_partkey AS STRING), DATE '2012-02-02', NULL, NULL, TRUE, DATE '2012-02-02', DATE '2022-05-05' FROM {part}",
    "src_teachers":
        "SELECT c_custkey * 4 + 1 AS person_id, CAST(c_nationkey % 26 AS BIGINT) AS teacher_type_id, "
        "CAST(c_custkey % 27 AS BIGINT) AS qualification_id, CAST(c_custkey % 28 AS BIGINT) AS designation_id, "
        "CASE WHEN c_acctbal > 3000 THEN 'T' || CAST(c_custkey AS STRING) END AS ipps_number, "
        "'TM' || CAST(c_custkey AS STRING) AS tmis_number, CAST(NULL AS STRING) AS moes_license_number, "
        + _flag("c_custkey + 2") + " AS is_on_government_payroll, DATE '2010-01-01' AS first_appointment_date, "
        "DATE '2011-01-01' AS posting_date, 'S' AS subject_category, CAST(c_nationkey AS BIGINT) AS current_school_id, "
        "CASE WHEN c_custkey % 3 > 0 THEN CAST(c_nationkey + c_custkey % 4 AS BIGINT) END AS trained_subject_1_id, "
        "CASE WHEN c_custkey % 5 > 0 THEN CAST(c_nationkey AS BIGINT) END AS trained_subject_2_id, DATE '2010-01-01' AS date_created, "
        "CASE WHEN c_acctbal < 5000 THEN DATE '2023-03-03' END AS date_updated FROM {customer}",
    "src_teacher_subjects":
        "SELECT l_orderkey * 10 + ln AS id, partkey * 10 AS employee_id, suppkey AS subject_id, CAST(shipdate AS DATE) AS date_created, "
        "CAST(shipdate AS DATE) AS date_updated FROM {lines}",
    "src_teaching_staff":
        "SELECT partkey * 10 AS employee_id, partkey * 4 + 1 AS person_id, CASE WHEN tax > 0 THEN suppkey END AS school_id, "
        "suppkey % 2 = 0 AS is_transfer_appointment, CAST(shipdate AS DATE) AS appointment_date, "
        "'CAT ' || CAST(suppkey % 3 AS STRING) AS staff_category, CAST(shipdate AS DATE) AS date_created, "
        "CASE WHEN year(shipdate) < 1997 THEN NULL ELSE CAST(shipdate AS DATE) END AS date_updated FROM ("
        "SELECT partkey, suppkey, tax, max(shipdate) AS shipdate FROM {lines} GROUP BY partkey, suppkey, tax) AS g "
        "WHERE NOT (year(shipdate) < 1997 AND tax > 0.04)",
    "src_setting_secondary_school_subjects":
        "SELECT s_suppkey AS id, 'Subject ' || CAST(s_suppkey AS STRING) AS name, " + ", ".join(
            f"{_flag(e)} AS {c}" for c, e in {
                "is_language_subject": "s_nationkey", "is_science_subject": "s_suppkey", "is_principal_subject": "s_suppkey + 1",
                "is_olevel_subject": "s_suppkey + s_nationkey", "is_alevel_subject": "s_nationkey + 1",
                "is_mandatory": "s_suppkey + 2", "is_examinable": "s_nationkey + 2", "has_lab_yn": "s_suppkey * 2"}.items())
        + ", CASE WHEN s_acctbal < 800 THEN NULL ELSE s_acctbal < 8500 END AS is_active_yn, FALSE AS is_archived_yn, "
        "CASE WHEN s_acctbal > 9500 THEN DATE '2024-01-01' END AS deleted_at, DATE '2020-01-01' AS date_created, "
        "DATE '2020-01-02' AS date_updated FROM {supplier}",
    "src_setting_primary_school_subjects":
        "SELECT CAST(n_nationkey AS BIGINT) AS id, 'Primary ' || n_name AS name, " + _flag("n_nationkey") + " AS is_language_subject, "
        "TRUE AS is_active_yn, FALSE AS is_archived_yn, CASE WHEN n_nationkey = 11 THEN DATE '2024-01-01' END AS deleted_at, "
        "DATE '2020-01-01' AS date_created, DATE '2020-01-02' AS date_updated FROM {nation}",
    "src_non_teaching_staff":
        "SELECT p_partkey * 4 + 2 AS person_id, CASE WHEN p_size < 45 THEN p_partkey * 10 + 5 END AS employee_id, "
        "CAST(p_size % 6 AS BIGINT) AS non_teaching_staff_category_id, CAST(p_partkey % 26 AS BIGINT) AS non_teaching_staff_role_id, "
        "FALSE AS is_transfer_appointment, DATE '2013-01-01' AS appointment_date, DATE '2014-01-01' AS posting_date, "
        "CAST(p_size % 9 AS BIGINT) AS current_school_id, DATE '2013-01-01' AS date_created, "
        "CASE WHEN p_size > 20 THEN DATE '2024-04-04' END AS date_updated FROM {part}",
    # --- buildings and transfers -------------------------------------------------------------
    "src_setting_school_building_types":
        "SELECT p_partkey AS id, " + _choose("p_size % 7", "Classroom", "Pit Latrine", "Science Laboratory", "Library",
                                             "COMPUTER LAB", "Dormitory", "Kitchen")
        + " || ' ' || p_type AS name, CAST(p_size % 6 AS BIGINT) AS item_category_id, "
        "CASE WHEN p_size > 40 THEN NULL ELSE p_size > 3 END AS is_active_yn, "
        "CASE WHEN p_size = 50 THEN NULL ELSE p_size = 49 END AS is_archived_yn, "
        "CASE WHEN p_size = 48 THEN DATE '2024-01-01' END AS deleted_at FROM {part}",
    "src_setting_school_infrastructure_types":
        "SELECT " + _known("p_retailprice < 970", "p_partkey") + " AS id, 'Kind ' || p_brand AS name, " + ", ".join(
            f"{_flag(f'p_size + {i}')} AS {c}" for i, c in enumerate(
                ("is_lab_yn", "is_sanitation_yn", "is_area_captured_yn", "gender_usage_yn", "user_category_yn",
                 "is_for_pre_primary", "is_for_primary", "is_for_secondary")))
        + " FROM {part}",
    "src_school_building_status_updates":
        "SELECT l_orderkey * 10 + ln AS id, suppkey AS school_id, partkey AS building_id, "
        "CAST(CASE WHEN tax > 0.07 THEN 99 ELSE year(shipdate) - 1994 END AS BIGINT) AS academic_year_id, ln % 6 AS teaching_period_id, "
        "CASE WHEN discount = 0 THEN NULL ELSE CAST(qty - 5 AS INT) END AS total_number, "
        "CASE WHEN qty = 10 THEN CAST(-1 AS DOUBLE) WHEN qty = 11 THEN CAST(1e15 AS DOUBLE) WHEN qty = 12 THEN NULL "
        "ELSE CAST(qty AS DOUBLE) + 0.125 END AS area, CAST(qty % 6 AS SMALLINT) AS completion_status, CAST(ln % 5 AS SMALLINT) AS usage_mode, "
        "CAST(partkey % 6 AS SMALLINT) AS condition, CAST(suppkey % 6 AS SMALLINT) AS gender_usage, "
        "CAST(qty % 5 AS SMALLINT) AS user_category, CAST(shipdate AS DATE) AS date_created, CAST(shipdate AS DATE) AS date_updated FROM {lines}",
    "src_teacher_transfers":
        "SELECT o_orderkey AS id, o_custkey * 4 + 1 AS person_id, o_custkey * 10 AS employee_id, CAST(NULL AS BIGINT) AS outgoing_employee_id, "
        "CASE o_orderstatus WHEN 'F' THEN o_custkey % 10 WHEN 'O' THEN (o_custkey + 1) % 10 END AS outgoing_school_id, "
        "o_orderkey % 200 AS incoming_school_id, o_custkey % 25 + 50 AS outgoing_local_government_id, "
        "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey % 30 + 50 END AS incoming_local_government_id, "
        "CAST(o_orderdate AS DATE) AS posting_date, CASE WHEN o_totalprice > 30000 THEN CAST(o_orderdate AS DATE) + "
        "CAST(o_orderkey % 40 - 5 AS INT) END AS reporting_date, CAST(o_orderkey % 5 AS SMALLINT) AS status, "
        "'M' || CAST(o_orderkey AS STRING) AS appointment_minute_number, o_orderkey % 4 AS category_id, "
        "CAST(o_orderdate AS DATE) AS date_created, CAST(o_orderdate AS DATE) AS date_updated FROM {orders}",
    "src_teacher_postings":
        "SELECT o_custkey * 4 + 1 AS person_id, (o_custkey + o_orderkey % 2) % 10 AS school_id, CAST(o_orderdate AS DATE) AS posting_date, "
        "CAST(substr(o_orderpriority, 1, 1) AS INT) AS status FROM {orders}",
    "src_population":
        "SELECT 'DISTRICT ' || n_name AS district_name, " + _year("o_orderdate") + " AS year, "
        "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'TOTAL' END AS sex, "
        "CASE WHEN n_nationkey = 5 THEN NULL ELSE CAST(count(*) * 157 + 13 AS BIGINT) END AS total_population, 'census' AS data_source "
        "FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey JOIN {nation} n ON n.n_nationkey = c.c_nationkey "
        "GROUP BY n_name, n_nationkey, " + _year("o_orderdate") + ", "
        "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'TOTAL' END",
    # --- staging tables that later steps read ----------------------------------------------------
    "stg_learners_raw":
        "SELECT o_orderkey * 4 AS person_id, 'LIN' || CAST(o_orderkey AS STRING) AS lin, " + LEARNER_COLUMNS["gender"] + " AS gender, "
        "CASE WHEN o_totalprice > 20000 THEN CAST(o_orderdate AS DATE) END AS date_of_birth, "
        + LEARNER_COLUMNS["nationality"] + " AS nationality, " + LEARNER_COLUMNS["nin"] + " AS nin, CAST(NULL AS STRING) AS passport_no, "
        "'SP' || CAST(o_custkey AS STRING) AS student_pass_no, CAST(NULL AS STRING) AS work_permit_no, CAST(NULL AS STRING) AS refugee_id, "
        "CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_father_dead, "
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN TRUE WHEN '2' THEN FALSE WHEN '3' THEN TRUE END AS is_mother_dead "
        "FROM {orders} WHERE o_totalprice >= 10000",
    "stg_learner_disabilities_raw":
        "SELECT d.id, d.learner_id, s.name AS disability_type FROM {src_learner_disabilities} d "
        "JOIN {src_setting_disability_types} s ON s.id = d.disability_type_id",
    "stg_enrolments_raw":
        "SELECT id, learner_id, school_id, academic_year_id, teaching_period_id, enrolment_type_id, is_enrolment_active_yn FROM {src_learner_enrolments} "
        "WHERE is_enrolment_active_yn",
    "stg_enrolments_subtype_raw":
        "SELECT id AS enrolment_id, 'LEVEL ' || CAST(familiar_language_id AS STRING) AS school_level, "
        "'P' || CAST(education_grade_id AS STRING) AS education_class_name FROM {src_learner_enrolments} WHERE is_enrolment_active_yn",
    "stg_enrolments_flat":
        "SELECT l_orderkey * 10 + ln AS enrolment_source_id, l_orderkey * 4 AS learner_source_id, suppkey AS school_source_id, "
        + _year("shipdate") + " AS academic_year, " + _term("shipdate") + " AS term, "
        "'LIN' || CAST(l_orderkey AS STRING) AS lin, " + _choose("l_orderkey % 7", "M", "F", "Male", "female", "M", "M", None) + " AS gender, "
        "CAST(CASE WHEN ln > 5 THEN NULL ELSE 6 + l_orderkey % 12 END AS INT) AS age, "
        "CASE WHEN qty > 40 THEN 'KENYA' ELSE 'UGANDA' END AS nationality, "
        "CASE WHEN l_orderkey % 3 = 0 THEN 'NIN' || CAST(l_orderkey AS STRING) END AS nin, CAST(NULL AS STRING) AS passport_no, "
        "CAST(NULL AS STRING) AS student_pass_no, CAST(NULL AS STRING) AS work_permit_no, CAST(NULL AS STRING) AS refugee_id, "
        "'NOT APPLICABLE' AS orphan_status, " + ", ".join(f"(l_orderkey + {i}) % 23 = 0 AS {f}" for i, f in enumerate(DISABILITY_FLAGS))
        + ", FALSE AS has_multiple_disabilities_yn, "
        "CASE WHEN partkey % 26 < 7 THEN 'P' || CAST(partkey % 26 + 1 AS STRING) WHEN partkey % 26 < 20 THEN 'BC' ELSE 'Z' END AS grade, "
        + _choose("partkey % 5", "BASELINE", "NEW", "CONTINUING", "TRANSFER", "OTHER") + " AS enrolment_type, "
        "CASE WHEN tax = 0 THEN NULL ELSE discount < 0.09 END AS is_active FROM {lines}",
    "stg_teachers_raw":
        "SELECT c_custkey * 4 + 1 AS person_id, c_custkey * 10 AS employee_id, c_name AS surname, 'T' AS given_name, "
        + TEACHER_COLUMNS["gender"] + " AS gender, DATE '1980-03-05' AS date_of_birth, 'UGANDA' AS nationality, "
        "CAST(NULL AS STRING) AS nin, CAST(NULL AS STRING) AS passport_no, " + TEACHER_COLUMNS["teacher_type"] + " AS teacher_type, "
        + TEACHER_COLUMNS["qualification"] + " AS qualification, c_mktsegment AS qualification_category, "
        + TEACHER_COLUMNS["designation"] + " AS designation, 'I' || CAST(c_custkey AS STRING) AS ipps_number, "
        "CAST(NULL AS STRING) AS tmis_number, CAST(NULL AS STRING) AS moes_license_number, "
        + _flag("c_custkey") + " AS is_on_government_payroll, DATE '2010-01-01' AS first_appointment_date, DATE '2011-01-01' AS posting_date, "
        + TEACHER_COLUMNS["highest_education_level"] + " AS highest_education_level, 'ACTIVE' AS employment_status, "
        "CAST(NULL AS STRING) AS hrin, CAST(NULL AS STRING) AS hcm_employee_number, CAST(4 AS SMALLINT) AS weekly_teaching_periods, "
        "FALSE AS is_undergoing_training FROM {customer}",
    "stg_teacher_subjects_raw":
        "SELECT l_orderkey * 10 + ln AS id, " + _known("discount > 0.08", "partkey * 10") + " AS employee_id, "
        + _known("discount > 0.08", "(partkey * 4 + 1)") + " AS person_id, suppkey AS subject_id, "
        "'Subject ' || CAST(suppkey AS STRING) AS subject_name, " + _flag("partkey + suppkey % 2") + " AS is_science_subject, "
        "suppkey % 4 = 0 AS is_language_subject, CAST(shipdate AS DATE) AS date_created, CAST(shipdate AS DATE) AS date_updated "
        "FROM {lines}",
    "stg_teacher_school_raw":
        "SELECT partkey * 10 AS employee_id, partkey * 4 + 1 AS person_id, CASE WHEN min(tax) = 0 THEN NULL ELSE min(suppkey) END AS school_id "
        "FROM {lines} GROUP BY partkey UNION ALL "
        "SELECT c_custkey * 10 + 1, c_custkey * 4 + 1, CAST(c_nationkey AS BIGINT) FROM {customer} WHERE c_acctbal > 5000",
    "stg_teachers_flat":
        "SELECT c_custkey * 4 + 1 AS person_id, suppkey AS school_id, " + _year("shipdate") + " AS academic_year, "
        + _term("shipdate") + " AS term, CASE WHEN ln = 7 THEN NULL ELSE make_date(" + _year("shipdate") + ", "
        "CAST(CASE WHEN month(shipdate) >= 9 THEN 9 WHEN month(shipdate) >= 6 THEN 6 ELSE 2 END AS INT), CAST(1 + ln % 3 AS INT)) END AS term_start_date, "
        "c_custkey * 10 AS employee_id, c_name AS surname, " + TEACHER_COLUMNS["gender"] + " AS gender, "
        "CASE WHEN c_acctbal > 7000 THEN 'LICENSED' ELSE " + TEACHER_COLUMNS["teacher_type"] + " END AS teacher_type, "
        + TEACHER_COLUMNS["qualification"] + " AS qualification, c_mktsegment AS qualification_category, "
        + TEACHER_COLUMNS["designation"] + " AS designation, 'DEGREE' AS highest_education_level, "
        + TEACHER_COLUMNS["discipline"] + " AS discipline, " + _flag("c_custkey") + " AS is_on_government_payroll, "
        + TEACHER_COLUMNS["ipps_number"] + " AS ipps_number FROM {lines} JOIN {customer} ON c_custkey = partkey",
    "stg_non_teaching_staff_raw":
        "SELECT p_partkey * 4 + 2 AS person_id, p_partkey * 10 + 5 AS employee_id, p_brand AS surname, 'N' AS given_name, "
        + STAFF_COLUMNS["gender"] + " AS gender, CASE WHEN p_size > 3 THEN DATE '1975-07-01' END AS date_of_birth, 'UGANDA' AS nationality, "
        "CAST(NULL AS STRING) AS nin, " + STAFF_COLUMNS["category"] + " AS category, " + STAFF_COLUMNS["role"] + " AS role, "
        "DATE '2014-01-01' AS posting_date, CASE WHEN p_size < 45 THEN CAST(p_size AS BIGINT) END AS current_school_id, "
        + STAFF_COLUMNS["highest_education_level"] + " AS highest_education_level, " + STAFF_COLUMNS["employment_status"] + " AS employment_status, "
        "TRUE AS is_on_government_payroll, CAST(NULL AS STRING) AS ipps_number, CAST(NULL AS STRING) AS hrin, "
        "CAST(NULL AS STRING) AS hcm_employee_number, FALSE AS is_undergoing_training FROM {part}",
    "stg_non_teaching_staff_flat":
        "SELECT p_partkey * 4 + 2 AS person_id, suppkey AS school_id, " + _year("shipdate") + " AS academic_year, "
        + _term("shipdate") + " AS term, CASE WHEN ln = 7 THEN NULL ELSE make_date(" + _year("shipdate") + ", "
        "CAST(CASE WHEN month(shipdate) >= 9 THEN 9 WHEN month(shipdate) >= 6 THEN 6 ELSE 2 END AS INT), CAST(1 AS INT)) END AS term_start_date, "
        + STAFF_COLUMNS["gender"] + " AS gender, CASE WHEN p_retailprice > 960 THEN 'SUPPORT' ELSE " + STAFF_COLUMNS["category"]
        + " END AS category, " + STAFF_COLUMNS["role"] + " AS role, " + STAFF_COLUMNS["highest_education_level"] + " AS highest_education_level, "
        + STAFF_COLUMNS["employment_status"] + " AS employment_status, " + _flag("p_partkey") + " AS is_on_government_payroll, "
        "TRUE AS is_primary_school FROM {lines} JOIN {part} ON p_partkey = partkey",
    "stg_infrastructure_raw":
        "SELECT l_orderkey * 10 + ln AS building_status_id, CASE WHEN tax = 0 THEN NULL ELSE suppkey END AS school_id, partkey % 60 AS building_id, "
        "CASE WHEN discount = 0 THEN NULL ELSE " + _year("shipdate") + " END AS academic_year, " + _term("shipdate") + " AS term, "
        "CAST(qty - 5 AS INT) AS total_number, CAST(price AS DECIMAL(15,2)) AS area, "
        + _choose("qty % 4", "COMPLETE", "INCOMPLETE", "PLANNED", None) + " AS completion_status, "
        + _choose("ln % 3", "PERMANENT", "TEMPORARY", None) + " AS usage_mode, "
        + _choose("partkey % 5", "GOOD", "FAIR", "POOR", "DILAPIDATED", None) + " AS structure_condition, "
        "'BOTH' AS gender_usage, CAST(NULL AS STRING) AS user_category FROM {lines}",
    "stg_subject_dim_raw":
        "SELECT id AS source_id, 'SECONDARY' AS subject_level, name AS subject_name, is_language_subject, is_science_subject, "
        "is_principal_subject, is_olevel_subject, is_alevel_subject, is_mandatory, is_examinable, has_lab_yn, is_active_yn "
        "FROM {src_setting_secondary_school_subjects}",
    "stg_teaching_subject_flat":
        "SELECT partkey * 4 + 1 AS person_id, suppkey AS subject_id, CASE WHEN suppkey < 30 THEN 'PRIMARY' ELSE 'SECONDARY' END AS subject_level, "
        "CASE WHEN min(tax) = 0 THEN NULL ELSE min(l_orderkey) % 120 END AS school_id FROM {lines} GROUP BY partkey, suppkey",
    "stg_teacher_transfers_raw":
        "SELECT o_orderkey AS transfer_id, CASE WHEN o_totalprice < 2000 THEN NULL ELSE o_custkey * 4 + 1 END AS person_id, "
        "o_custkey % 130 AS outgoing_school_id, o_orderkey % 150 AS incoming_school_id, o_custkey % 30 AS outgoing_district_id, "
        "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey % 30 END AS incoming_district_id, "
        + _choose("o_orderkey % 4", "PENDING", "APPROVED", "REJECTED", "APPROVED") + " AS transfer_status, "
        "'M' || CAST(o_orderkey AS STRING) AS appointment_minute_number, o_custkey % 30 <> o_orderkey % 30 AS is_inter_district, "
        "CAST(o_orderkey % 9000 - 100 AS INT) AS days_at_outgoing_station, "
        "make_date(" + _year("o_orderdate") + ", CAST(month(o_orderdate) AS INT), CAST(1 AS INT)) AS posting_date, "
        "CASE WHEN o_totalprice > 30000 THEN make_date(" + _year("o_orderdate") + ", CAST(month(o_orderdate) AS INT), "
        "CAST(1 + o_orderkey % 20 AS INT)) END AS reporting_date FROM {orders}",
    "stg_population_raw":
        "SELECT district_name, CASE WHEN sex = 'M' AND year = 2024 THEN NULL ELSE CAST(substr(district_name, 17) AS BIGINT) END AS district_source_id, "
        "year, sex, total_population, total_population * 2 AS pop_age_3_5, total_population * 3 AS pop_age_6_12, "
        "total_population * 4 AS pop_age_13_16, total_population * 5 AS pop_age_17_18, total_population * 6 AS pop_age_6, data_source FROM {src_population}",
    # --- warehouse tables that reports and later steps read ------------------------------------------
    "dw_learner_dim": _versions(
        LEARNER_COLUMNS, "", "orders", "o_orderkey * 10", "o_totalprice < 100000", LEARNER_HASHED,
        {"nationality": "'RWANDA'"}),
    "dw_teacher_dim": _versions(
        TEACHER_COLUMNS, "", "customer", "c_custkey * 10", "c_acctbal < 2000", TEACHER_HASHED,
        {"teacher_type": "'QUALIFIED'", "highest_education_level": "'MASTERS'"}),
    "dw_non_teaching_staff_dim": _versions(
        STAFF_COLUMNS, "", "part", "p_partkey * 10", "p_retailprice < 930", STAFF_HASHED, {"category": "'SUPPORT'"}),
    "dw_grade_dim":
        "SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_nationkey < 7 THEN 'P' || CAST(n_nationkey + 1 AS STRING) "
        "WHEN n_nationkey = 7 THEN 'BC' ELSE 'S' || CAST(n_nationkey AS STRING) END AS grade_code, "
        "CASE WHEN n_nationkey = 7 THEN 'Baby Class' WHEN n_nationkey = 2 THEN 'Entry P1' ELSE n_name END AS grade_name FROM {nation}",
    "dw_enrolment_type_dim":
        "SELECT CAST(r_regionkey AS BIGINT) AS id, " + _choose("r_regionkey", "BASELINE", "NEW", "CONTINUING", "TRANSFER", "REPEATER")
        + " AS enrolment_type FROM {region}",
    "dw_enrolment_fact":
        "SELECT l_orderkey * 10 + ln AS id, l_orderkey * 10 + CASE WHEN qty > 25 THEN 1 ELSE 0 END AS learner_id, "
        "suppkey * 10 + CASE WHEN ln = 1 THEN 1 ELSE 0 END AS school_id, CASE WHEN partkey % 26 < 25 THEN partkey % 26 END AS grade_id, "
        "CASE WHEN partkey % 7 < 5 THEN partkey % 7 END AS enrolment_type_id, l_orderkey * 4 AS learner_source_id, "
        "suppkey AS school_source_id, l_orderkey * 10 + ln AS enrolment_source_id, " + _year("shipdate") + " AS academic_year, "
        + _term("shipdate") + " AS term, CAST(year(shipdate) * 10000 + 280000 + month(shipdate) * 100 + 1 AS BIGINT) AS date_id FROM {lines}",
    "dw_hr_fact":
        "SELECT l_orderkey * 10 + ln AS id, partkey * 10 + CASE WHEN qty > 30 THEN 1 ELSE 0 END AS teacher_id, "
        "suppkey * 10 + CASE WHEN ln = 2 THEN 1 ELSE 0 END AS school_id, partkey * 4 + 1 AS person_id, suppkey AS school_source_id, "
        + _year("shipdate") + " AS academic_year, " + _term("shipdate") + " AS term, "
        "CAST(year(shipdate) * 10000 + 280000 + month(shipdate) * 100 + 1 AS BIGINT) AS date_id FROM {lines}",
    "dw_non_teaching_staff_fact":
        "SELECT l_orderkey * 10 + ln AS id, partkey * 10 + CASE WHEN qty > 30 THEN 1 ELSE 0 END AS staff_id, suppkey * 10 AS school_id, "
        "partkey * 4 + 2 AS person_id, suppkey AS school_source_id, " + _year("shipdate") + " AS academic_year, " + _term("shipdate") + " AS term, "
        "CAST(year(shipdate) * 10000 + 280000 + month(shipdate) * 100 + 1 AS BIGINT) AS date_id FROM {lines}",
    "dw_infrastructure_type_dim":
        "SELECT " + _known("p_size < 47", "p_partkey") + " AS id, p_partkey AS source_id, " + _choose(
            "p_size % 7", "Classroom block", "VIP latrine", "Science room", "Main Library", "Computer Lab", "Dormitory", "Kitchen")
        + " || ' ' || p_type AS type_name, 'Items' AS item_category, " + _flag("p_size") + " AS is_lab_yn, FALSE AS is_sanitation_yn, "
        "FALSE AS is_area_captured_yn, FALSE AS gender_usage_yn, FALSE AS user_category_yn, FALSE AS is_for_pre_primary, "
        "TRUE AS is_for_primary, TRUE AS is_for_secondary, TRUE AS is_active_yn FROM {part}",
    "dw_infrastructure_fact":
        "SELECT l_orderkey * 10 + ln AS id, suppkey * 10 AS school_id, partkey AS infra_type_id, suppkey AS school_source_id, "
        "partkey % 60 AS building_source_id, " + _year("shipdate") + " AS academic_year, " + _term("shipdate") + " AS term, "
        "CASE WHEN discount = 0 THEN NULL ELSE CAST(qty - 5 AS INT) END AS total_number, "
        + _choose("qty % 5", "COMPLETE", "complete", "INCOMPLETE", "PLANNED", None) + " AS completion_status, "
        + _choose("ln % 4", "PERMANENT", "permanent", "TEMPORARY", None) + " AS usage_mode, "
        + _choose("partkey % 5", "GOOD", "FAIR", "POOR", "DILAPIDATED", None) + " AS structure_condition FROM {lines}",
    "dw_subject_dim":
        "SELECT s.*, CASE WHEN is_language_subject THEN 'LANGUAGE' WHEN is_science_subject THEN 'SCIENCE' ELSE 'ARTS' END AS subject_category "
        "FROM (SELECT p_partkey AS id, p_partkey AS source_id, CASE WHEN p_size < 15 THEN 'PRIMARY' ELSE 'SECONDARY' END AS subject_level, "
        "p_name AS subject_name, " + ", ".join(f"{_flag(f'p_partkey + {i} * p_size')} AS {c}" for i, c in enumerate(
            ("is_language_subject", "is_science_subject", "is_principal_subject", "is_olevel_subject", "is_alevel_subject",
             "is_mandatory", "is_examinable", "has_lab_yn"))) + ", p_size < 40 AS is_active_yn FROM {part}) AS s",
    "dw_teaching_subject_fact":
        "SELECT l_orderkey * 10 + ln AS id, l_orderkey * 10 AS teacher_id, suppkey * 10 AS school_id, partkey AS subject_id, "
        "l_orderkey * 4 + 1 AS person_id, suppkey AS school_source_id, partkey AS subject_source_id, 'SECONDARY' AS subject_level FROM {lines}",
    "dw_teacher_transfer_fact":
        "SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '2-HIGH' THEN -1 ELSE 1 END * o_custkey * 10 + CASE WHEN o_totalprice > 400000 THEN 7 ELSE 0 END AS teacher_id, "
        "CASE WHEN o_totalprice > 50000 THEN o_custkey % 100 * 10 END AS out_school_id, "
        "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey % 25 + 10000 END AS out_district_id, "
        "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey % 25 + 10000 END AS in_district_id, o_orderkey AS transfer_source_id, "
        "o_orderstatus = 'P' AS is_inter_district, CASE WHEN o_totalprice > 20000 THEN CAST(o_orderkey % 9000 - 50 AS INT) END AS days_at_outgoing_station, "
        "CAST(o_orderdate AS DATE) AS posting_date, CASE WHEN o_totalprice > 30000 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 5 AS INT) END "
        "AS reporting_date FROM {orders}",
    "dw_population_fact":
        "SELECT CAST(10000 + n_nationkey AS BIGINT) AS district_id, p.district_name, p.year, p.sex, p.total_population, "
        "CAST(p.total_population * 2 AS BIGINT) AS pop_age_3_5, p.total_population AS pop_age_6_12, CAST(p.total_population * 3 AS BIGINT) AS pop_age_13_16, "
        "CASE WHEN n_regionkey = 1 THEN CAST(0 AS BIGINT) ELSE p.total_population END AS pop_age_17_18, "
        "CASE WHEN n_regionkey = 3 THEN CAST(0 AS BIGINT) ELSE p.total_population END AS pop_age_6, p.data_source "
        "FROM {src_population} p JOIN {nation} ON 'DISTRICT ' || n_name = p.district_name WHERE n_nationkey <> 12",
    "indicator_counts":
        "SELECT suppkey AS school_source_id, " + _year("shipdate") + " AS academic_year, " + _term("shipdate") + " AS term, "
        "count(*) AS n, CAST(sum(qty) AS BIGINT) AS q, count(DISTINCT partkey) AS d FROM {lines} "
        "GROUP BY suppkey, " + _year("shipdate") + ", " + _term("shipdate"),
    "dw_school_indicator_fact":
        "SELECT school_source_id * 10 AS school_id, school_source_id, academic_year, term, q AS total_learners, "
        "CASE WHEN q % 17 = 0 THEN CAST(0 AS BIGINT) ELSE n END AS total_teachers, "
        "CASE WHEN n % 13 = 0 THEN NULL ELSE CAST(CAST(q * (n % 9) * 7 % 60000 AS BIGINT) * 0.01 AS DECIMAL(8,2)) END AS ptr, "
        "CAST(CAST(q * 37 % 10001 AS BIGINT) * 0.01 AS DECIMAL(8,2)) AS qualified_teacher_ratio, "
        "CASE WHEN d % 11 = 0 THEN NULL ELSE CAST(CAST(q * 53 % 10500 AS BIGINT) * 0.01 AS DECIMAL(8,2)) END AS pct_female_teachers "
        "FROM {indicator_counts}",
    "stg_school_indicator_raw":
        "SELECT school_source_id, 'S' AS school_name, academic_year, term, q AS total_learners, n AS male_learners, d AS female_learners, "
        "n AS total_teachers, d AS male_teachers, n - d AS female_teachers, d AS qualified_teachers, n AS trained_teachers, "
        "CAST(CAST(q % 9000 AS BIGINT) * 0.01 AS DECIMAL(8,2)) AS ptr, CAST(CAST(q % 9001 AS BIGINT) * 0.01 AS DECIMAL(8,2)) AS qualified_teacher_ratio, "
        "CAST(CAST(q % 9002 AS BIGINT) * 0.01 AS DECIMAL(8,2)) AS trained_teacher_ratio, CAST(CAST(q % 9003 AS BIGINT) * 0.01 AS DECIMAL(8,2)) "
        "AS pct_female_teachers, CAST(CAST(q % 9004 AS BIGINT) * 0.0001 AS DECIMAL(8,4)) AS gpi_ptr FROM {indicator_counts}",
    "district_enrolment":
        "SELECT CAST(10000 + c_nationkey AS BIGINT) AS district_id, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Primary' WHEN 'HOUSEHOLD' THEN 'primary ' "
        "WHEN 'FURNITURE' THEN NULL ELSE 'SECONDARY' END AS school_level, " + _year("o_orderdate") + " AS academic_year, "
        "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'TOTAL' END AS gender, count(*) AS n, "
        "count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS u FROM {orders} JOIN {customer} ON c_custkey = o_custkey "
        "GROUP BY c_nationkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Primary' WHEN 'HOUSEHOLD' THEN 'primary ' "
        "WHEN 'FURNITURE' THEN NULL ELSE 'SECONDARY' END, " + _year("o_orderdate") + ", "
        "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'TOTAL' END",
    "dw_enrolment_indicator_fact":
        "SELECT district_id, school_level, academic_year, gender, n AS total_enrolment, u AS learners_with_disability, "
        "CASE WHEN n % 5 = 0 THEN NULL ELSE CAST(CAST(n * 1234 % 25000 AS BIGINT) * 0.01 AS DECIMAL(8,2)) END AS ger, "
        "CAST(CAST(u * 321 % 4000 AS BIGINT) * 0.01 AS DECIMAL(8,2)) AS repetition_rate, "
        "CASE WHEN gender = 'TOTAL' AND n % 4 > 0 THEN CAST(CAST(n * 777 % 20000 AS BIGINT) * 0.0001 AS DECIMAL(8,4)) END AS gpi_ger, "
        "CAST(NULL AS DECIMAL(8,4)) AS gpi_ner FROM {district_enrolment}",
    "stg_enrolment_indicator_raw":
        "SELECT CASE WHEN n = 1 THEN NULL ELSE district_id END AS district_id, coalesce(school_level, 'NONE') AS school_level, academic_year, gender, "
        "n AS total_enrolment, CAST(0 AS BIGINT) AS official_age_enrolment, u AS new_entrants_p1, CAST(0 AS BIGINT) AS new_entrants_p1_official_age, "
        "CAST(0 AS BIGINT) AS repeaters, u AS learners_with_disability, n * 3 AS school_age_population, n * 2 AS population_age_6, "
        "CASE WHEN u = 0 THEN CAST(0 AS DECIMAL(8,2)) ELSE CAST(CAST(n * 1234 % 25000 AS BIGINT) * 0.01 AS DECIMAL(8,2)) END AS ger, "
        "CAST(NULL AS DECIMAL(8,2)) AS ner, CAST(NULL AS DECIMAL(8,2)) AS gir, CAST(0 AS DECIMAL(8,2)) AS repetition_rate, "
        "CAST(CAST(u * 10 AS BIGINT) * 0.01 AS DECIMAL(8,2)) AS sne_inclusion_rate FROM {district_enrolment}",
    # --- two snapshots of the customers, and versions on the time line of the orders ----------------
    "snap1":
        "SELECT c_custkey AS source_id, CASE WHEN c_acctbal BETWEEN 2000 AND 2500 THEN NULL ELSE c_name END AS name, "
        "CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, c_acctbal > 5000 AS premium FROM {customer} WHERE c_acctbal < 9000",
    "snap2":
        "SELECT c_custkey AS source_id, CASE WHEN c_acctbal BETWEEN 2600 AND 2900 THEN NULL ELSE c_name END AS name, "
        "CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_nationkey < 5 THEN c_nationkey + 1 ELSE c_nationkey END AS BIGINT) AS nation, "
        "CASE WHEN c_acctbal BETWEEN 3000 AND 5000 THEN 'MACHINERY' ELSE c_mktsegment END AS segment, "
        "CASE WHEN c_acctbal > 8000 THEN NULL ELSE c_acctbal > 5000 END AS premium FROM {customer} WHERE c_acctbal > 100",
    "customer_versions":
        "SELECT c_custkey * 10 AS id, c_custkey AS source_id, DATE '1995-06-01' AS effective_date, CASE WHEN c_acctbal < 4000 "
        "THEN DATE '1998-03-31' ELSE DATE '9999-12-31' END AS expiration_date, c_acctbal >= 4000 AS is_current FROM {customer} "
        "UNION ALL SELECT c_custkey * 10 + 1, c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN DATE '1998-06-01' ELSE DATE '1998-04-01' END, "
        "DATE '9999-12-31', TRUE FROM {customer} WHERE c_acctbal < 4000",
    "supplier_versions":
        "SELECT s_suppkey * 10 AS id, s_suppkey AS source_id, DATE '1996-01-01' AS effective_date, CASE WHEN s_acctbal < 5000 "
        "THEN DATE '1999-12-31' ELSE DATE '9999-12-31' END AS expiration_date FROM {supplier} "
        "UNION ALL SELECT s_suppkey * 10 + 1, s_suppkey, DATE '2000-01-01', DATE '9999-12-31' FROM {supplier} WHERE s_acctbal < 5000",
    "order_terms":
        "SELECT o_orderkey, o_custkey, o_orderkey % 120 AS suppkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INT) AS academic_year, "
        + _term("o_orderdate") + " AS term, o_orderstatus, o_orderpriority, o_totalprice FROM {orders}",
    "runs":
        "SELECT o_orderkey AS run_id, o_orderdate AS start_ts, o_orderdate + INTERVAL 90 SECOND AS end_ts, o_orderstatus AS status FROM {orders}",
}
