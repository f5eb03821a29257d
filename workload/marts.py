"""Each step of the marts on the derived census tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import functions as F

from censusmart.functions.labels import (
    COMPLETION, CONDITION, GENDER_USAGE, TRANSFER_STATUS, USAGE_MODE, USER_CATEGORY,
)
from censusmart.operators import quality
from censusmart.plans import (
    enrolment, indicators, infrastructure, lookups, schools, staff, subjects, teachers, transfers,
)
from censusmart.session import cut_lineage
from censusmart.sources.files import empty
from censusmart.sources.schemas import schema
from workload.definitions import DISABILITY_FLAGS, LEARNER_HASHED, SCHOOL_HASHED, STAFF_HASHED, TEACHER_HASHED
from workload.operators import CLIMB_SQL
from workload.registry import TODAY, pct, plain, query, register

AS_OF = f"DATE '{TODAY}'"
YESTERDAY = f"DATE '{date.fromordinal(TODAY.toordinal() - 1)}'"


# ----------------------------------------------------------------------------- SQL fragments

def case(expr: str, mapping: Mapping[int, str], default: str = "NULL") -> str:
    """SQL: a code's label through a literal map."""
    entries = ", ".join(f"{k}: '{v}'" for k, v in mapping.items())
    return f"coalesce(map {{{{{entries}}}}}[CAST({expr} AS INTEGER)], {default})"


def residence_sql(day: str, board: str, labels: Sequence[str] = ("DAY SCHOOL", "FULLY BOARDING", "DAY AND BOARDING")) -> str:
    return f"CASE WHEN {day} IS NULL OR {board} IS NULL THEN NULL WHEN {day} AND {board} THEN '{labels[2]}' WHEN {day} THEN '{labels[0]}' WHEN {board} THEN '{labels[1]}' END"


def year_sql(name: str, fallback: str) -> str:
    return f"CAST(coalesce(TRY_CAST(nullif(regexp_replace({name}, '[^0-9]', '', 'g'), '') AS INTEGER), year({fallback})) AS INTEGER)"


def term_sql(name: str) -> str:
    return f"CASE WHEN {name} IN ('1', '2', '3') THEN 'TERM ' || {name} WHEN {name} ILIKE 'term%' THEN upper({name}) ELSE 'TERM 1' END"


def sex_sql(male: str, female: str) -> str:
    return f"CASE WHEN {male} IS TRUE THEN CASE WHEN {female} IS TRUE THEN 'MIXED' ELSE 'MALES ONLY' END WHEN {female} IS TRUE THEN 'FEMALES ONLY' END"


def hash_sql(columns: Mapping[str, str], prefix: str = "") -> str:
    inner = ", ".join(f"coalesce(CAST({prefix}{c} AS VARCHAR), '{d}')" for c, d in columns.items())
    return f"md5(concat_ws('|', {inner}))"


def merge_sql(dim: str, staged: str, key: str, hashed: Mapping[str, str], others: Sequence[str] = (),
              reasons: Sequence[tuple[str, str]] = (), default: str = "ATTRIBUTE_CHANGE", first: str = "INITIAL_LOAD",
              safe: bool = True, named: Sequence[str] | None = None, initial: bool = False) -> str:
    """SQL: history, kept, expired and inserted versions as separate branches.

    ``staged`` is a SELECT with one row per key and the hashed and other columns.
    """
    cols = [key, *hashed, *others]
    old = ", ".join(f"d.{c}" for c in cols)
    new = ", ".join(f"s.{c}" for c in cols)
    diff = "{o} IS DISTINCT FROM {n}" if safe else "{o} <> {n}"
    tests = {c: diff.format(o=f"x.{c}", n=f"s.{c}") for c in hashed}
    whens = " ".join(f"WHEN {tests[c]} THEN '{text}'" for c, text in reasons)
    reason = f"CASE {whens} ELSE '{default}' END" if reasons else f"'{default}'"
    fields = ", ".join(f"CASE WHEN {tests[c]} THEN '{c}' END" for c in (named or hashed))
    known = "FALSE" if initial else "x.source_id IS NOT NULL"
    return f"""
WITH s AS (SELECT *, {hash_sql(hashed)} AS h FROM ({staged}) AS raw), d AS (SELECT * FROM {{{dim}}}),
changed AS (SELECT d.* FROM d JOIN s ON s.{key} = d.{key} WHERE d.is_current AND d.change_hash <> s.h)
SELECT {old}, d.effective_date, d.expiration_date, d.is_current, d.change_hash, d.change_reason, d.changed_fields FROM d WHERE NOT EXISTS (
   SELECT 1 FROM changed c WHERE c.id = d.id)
UNION ALL SELECT {old}, d.effective_date, {YESTERDAY}, FALSE, d.change_hash, d.change_reason, d.changed_fields FROM changed d
UNION ALL SELECT {new}, {AS_OF}, DATE '9999-12-31', TRUE, s.h, CASE WHEN {known} THEN {reason} ELSE 'INITIAL_LOAD' END,
   CASE WHEN {known} THEN concat_ws(',', {fields}) ELSE '{first}' END
FROM s LEFT JOIN changed x ON x.{key} = s.{key} WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.is_current AND d.{key} = s.{key} AND d.change_hash = s.h)"""


def merged(df, columns):
    return plain(df.select(*columns, "effective_date", "expiration_date", "is_current", "change_hash", "change_reason", "changed_fields"))


SCHOOL_NAMES = "LEFT JOIN {src_setting_school_types} st ON st.id = s.school_type_id LEFT JOIN {src_setting_ownership_statuses} ow ON ow.id = s.school_ownership_status_id"
PLACE = "coalesce(s.parish_id, s.sub_county_id, s.county_id, s.district_id, s.region_id)"
OWNED = "coalesce(ow.name, CASE WHEN s.is_government_owned_yn THEN 'GOVT AIDED' ELSE 'PRIVATE' END)"
PERIODS = f"""SELECT p.*, {year_sql('y.name', 'p.start_date')} AS academic_year, {term_sql('n.name')} AS term, n.name AS period_name
FROM {{src_academic_year_teaching_periods}} p JOIN {{src_setting_academic_years}} y ON y.id = p.academic_year_id JOIN {{src_setting_teaching_periods}} n ON n.id = p.teaching_period_id"""
GENERAL = f"""SELECT * FROM ({PERIODS}) AS pp WHERE status = 'active' AND school_id IS NULL
QUALIFY row_number() OVER (PARTITION BY academic_year, term ORDER BY school_type_id, start_date) = 1"""


# ----------------------------------------------------------------------------- schools

UNIT_OF = "(SELECT min(a.id) FROM {{dw_admin_units_dim}} a WHERE a.current_status AND a.source_id = r.{})"


def _first_known(kinds: Sequence[str], flag: str) -> str:
    picks = ", ".join(f"(SELECT k.{flag} FROM {{src_{kind}}} k WHERE k.school_id = r.id)" for kind in kinds)
    return f"coalesce({picks})"


def _in_any(kinds: Sequence[str]) -> str:
    return " OR ".join(f"r.id IN (SELECT school_id FROM {{src_{kind}}})" for kind in kinds)


DAY, BOARD = "admits_day_scholars_yn", "admits_boarders_yn"


@query(f"""
SELECT r.id AS source_id, r.name, coalesce({', '.join(UNIT_OF.format(c).replace('{{', '{').replace('}}', '}') for c in schools.UNIT_LEVELS)}) AS admin_unit_id, r.emis_number,
 substr(coalesce(st.display_name, st.name), 1, 50) AS school_type, substr(op.name, 1, 20) AS operational_status,
 coalesce(ow.name, CASE WHEN r.is_government_owned_yn THEN 'GOVT AIDED' WHEN NOT r.is_government_owned_yn THEN 'PRIVATE' END) AS ownership_status,
 CAST(r.funding_source_id AS VARCHAR) AS funding_type, {sex_sql('r.has_male_students', 'r.has_female_students')} AS sex_composition,
 CASE WHEN {_in_any(schools.SCHOOL_KINDS)} THEN {residence_sql(_first_known(schools.SCHOOL_KINDS, DAY), _first_known(schools.SCHOOL_KINDS, BOARD))}
      WHEN {_in_any(schools.INSTITUTION_KINDS)} THEN {residence_sql(_first_known(schools.INSTITUTION_KINDS, DAY), _first_known(schools.INSTITUTION_KINDS, BOARD), ('NON RESIDENTIAL', 'RESIDENTIAL', 'BOTH RES/NON'))}
 END AS boarding_status, fb.name AS founding_body_type
FROM {{stg_schools_raw}} r LEFT JOIN {{src_setting_school_types}} st ON st.id = r.school_type_id LEFT JOIN {{src_setting_operational_statuses}} op ON op.id = r.operational_status_id
LEFT JOIN {{src_setting_ownership_statuses}} ow ON ow.id = r.school_ownership_status_id LEFT JOIN {{src_setting_founding_bodies}} fb ON fb.id = r.founding_body_id
WHERE r.emis_number IS NULL OR r.emis_number IN (SELECT emis_number FROM {{stg_schools_raw}} WHERE emis_number IS NOT NULL GROUP BY 1 HAVING count(*) = 1)""")
def schools_flatten(t):
    return schools.flatten_schools(t, TODAY).drop("effective_date", "expiration_date", "is_current", "change_reason")


PLACED = "SELECT f.* FROM {stg_schools_flat} f JOIN {dw_admin_units_dim} a ON a.id = f.admin_unit_id AND a.current_status"


@query(merge_sql("dw_schools_dim", PLACED, "source_id", SCHOOL_HASHED, reasons=schools.REASONS, default="Attribute update", first="ALL"))
def schools_merge(t):
    return merged(schools.merge_schools(t, TODAY), ["source_id", *SCHOOL_HASHED])


@query(merge_sql("dw_schools_dim", PLACED, "source_id", SCHOOL_HASHED, reasons=schools.REASONS, default="Attribute update", first="ALL",
                 safe=False, named=[c for c, _ in schools.REASONS]))
def schools_merge_literal(t):
    return merged(schools.merge_schools(t, TODAY, compat=True), ["source_id", *SCHOOL_HASHED])


@query("SELECT source_id, admin_unit_id FROM {stg_schools_flat} WHERE admin_unit_id IS NULL OR admin_unit_id NOT IN (SELECT id FROM {dw_admin_units_dim} WHERE current_status)")
def schools_rejected(t):
    return schools.rejected_schools(t["stg.schools_flat"], t["dw.admin_units_dim"]).select("source_id", "admin_unit_id")


UNIT_COLUMNS = ["source_id", "admin_unit_type", "child_id", "name", "admin_unit_code", "voting_code"]


@query("""
WITH s AS (SELECT *, md5(concat_ws('|', name, admin_unit_type, admin_unit_code, voting_code, coalesce(CAST(parent_id AS VARCHAR), ''))) AS h FROM {stg_admin_units_raw}),
d AS (SELECT *, md5(concat_ws('|', name, admin_unit_type, admin_unit_code, voting_code, coalesce(CAST(child_id AS VARCHAR), ''))) AS h FROM {dw_admin_units_dim})
SELECT d.source_id, d.admin_unit_type, d.child_id, d.name, d.admin_unit_code, d.voting_code, d.effective_date,
  CASE WHEN d.current_status AND s.h <> d.h THEN @yesterday ELSE d.expiration_date END AS expiration_date, d.current_status AND coalesce(s.h = d.h, TRUE) AS current_status
FROM d LEFT JOIN s ON s.source_id = d.source_id AND s.admin_unit_type = d.admin_unit_type
UNION ALL SELECT s.source_id, s.admin_unit_type, s.parent_id, s.name, s.admin_unit_code, s.voting_code, @today, DATE '9999-12-31', TRUE
FROM s WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.source_id = s.source_id AND d.admin_unit_type = s.admin_unit_type AND d.current_status AND d.h = s.h)
""".replace("@yesterday", YESTERDAY).replace("@today", AS_OF), name="scd2_composite_key")
def admin_units_merge(t):
    return schools.merge_admin_units(t, TODAY).select(*UNIT_COLUMNS, "effective_date", "expiration_date", "current_status")


@query(f"""
WITH s AS (SELECT * FROM {{stg_school_location_details_raw}} WHERE is_current), d AS (SELECT * FROM {{dw_school_location_details_dim}}),
m AS (SELECT d.school_id, s.physical_address <> d.physical_address AS changed FROM d JOIN s USING (school_id))
SELECT d.school_id, d.physical_address, d.effective_date, CASE WHEN m.changed THEN {YESTERDAY} ELSE d.expiration_date END AS expiration_date, NOT coalesce(m.changed, FALSE) AS is_current
FROM d LEFT JOIN m USING (school_id)
UNION ALL SELECT s.school_id, s.physical_address, {AS_OF}, DATE '9999-12-31', TRUE FROM s LEFT JOIN m USING (school_id) WHERE m.school_id IS NULL OR m.changed""")
def locations_merge(t):
    return schools.merge_locations(t, TODAY).select("school_id", "physical_address", "effective_date", "expiration_date", "is_current")


@query("SELECT v.id AS school_id, d.id AS date_id FROM {dw_schools_dim} v, {dw_date_dim} d WHERE v.is_current AND d.system_date = DATE '2025-01-15'")
def snapshot_fact(t):
    return schools.school_snapshot(t, TODAY).select("school_id", "date_id")


@query("""SELECT operational_status, count(*) AS school_count FROM {dw_school_fact} f JOIN {dw_schools_dim} v ON v.id = f.school_id JOIN {dw_date_dim} d ON d.id = f.date_id
WHERE system_date = DATE '2025-01-15' GROUP BY operational_status""")
def schools_by_operational_status(t):
    return schools.by_operational_status(t, TODAY)


@query("""SELECT a.name AS district, sex_composition, count(*) AS total FROM {dw_school_fact} f JOIN {dw_schools_dim} v ON v.id = f.school_id JOIN {dw_date_dim} d ON d.id = f.date_id
JOIN {dw_admin_units_dim} a ON a.id = v.admin_unit_id WHERE system_date = DATE '2025-01-15' AND a.admin_unit_type = 'District' AND a.current_status GROUP BY 1, 2""")
def schools_by_district_and_sex(t):
    return schools.by_district_and_sex(t, TODAY)


@query("""WITH s AS (SELECT * FROM {stg_schools_raw} WHERE emis_number IS NULL OR emis_number IN (SELECT emis_number FROM {stg_schools_raw} GROUP BY 1 HAVING count(*) = 1)),
p AS (SELECT s.id, substr(op.name, 1, 20) AS status FROM s LEFT JOIN {src_setting_operational_statuses} op ON op.id = s.operational_status_id WHERE EXISTS (
  SELECT 1 FROM {dw_admin_units_dim} a WHERE a.current_status AND a.source_id IN (s.parish_id, s.sub_county_id, s.county_id, s.district_id, s.admin_unit_id))),
live AS (SELECT id, status FROM p UNION ALL SELECT source_id, operational_status FROM {dw_schools_dim} v WHERE is_current AND source_id NOT IN (SELECT id FROM p))
SELECT status AS operational_status, count(*) AS school_count FROM live GROUP BY 1""")
def schools_status_end_to_end(t):
    """Raw schools → flat → versions → snapshot → report; the merged dimension is written in between.

    Every staged school differs from its version in the old dimension (the names and units do), so
    the day's current rows are the staged ones plus the schools that staging no longer holds.
    """
    world = type(t)(t.spark, t.sf_dir, **{k: v for k, v in t.items()})
    world["stg.schools_flat"] = schools.flatten_schools(world, TODAY)
    world["dw.schools_dim"] = cut_lineage(schools.merge_schools(world, TODAY))
    world["dw.school_fact"] = schools.school_snapshot(world, TODAY)
    return schools.by_operational_status(world, TODAY)


# ----------------------------------------------------------------------------- enrolment

@query("""
WITH i AS (SELECT d.person_id, upper(k.name) AS kind, d.document_id FROM {src_identity_documents} d JOIN {src_setting_identity_document_types} k ON k.id = d.identity_type_id)
SELECT l.person_id, l.lin, p.surname, trim(coalesce(p.first_name, '') || ' ' || coalesce(p.other_names, '')) AS given_name, p.birth_date AS date_of_birth, p.gender,
 coalesce(c.name, 'UGANDA') AS nationality, l.district_of_birth_id,
 (SELECT max(document_id) FROM i WHERE i.person_id = l.person_id AND (contains(kind, 'NATIONAL') OR contains(kind, 'NIN'))) AS nin,
 (SELECT max(document_id) FROM i WHERE i.person_id = l.person_id AND contains(kind, 'PASSPORT')) AS passport_no,
 (SELECT max(document_id) FROM i WHERE i.person_id = l.person_id AND kind LIKE '%STUDENT%PASS%') AS student_pass_no,
 (SELECT max(document_id) FROM i WHERE i.person_id = l.person_id AND kind LIKE '%WORK%PERMIT%') AS work_permit_no,
 (SELECT max(document_id) FROM i WHERE i.person_id = l.person_id AND contains(kind, 'REFUGEE')) AS refugee_id, l.is_flagged_yn, l.is_father_dead, l.is_mother_dead, l.date_created
FROM {src_learners} l JOIN {src_persons} p ON p.id = l.person_id LEFT JOIN {src_admin_unit_countries} c ON c.id = p.country_id WHERE l.deleted_at IS NULL""")
def learners_extract(t):
    return enrolment.extract_learners(t).drop("deleted_at", "date_updated")


@query("SELECT d.id, d.learner_id, s.name AS disability_type, d.date_created FROM {src_learner_disabilities} d JOIN {src_setting_disability_types} s ON s.id = d.disability_type_id")
def disabilities_extract(t):
    return enrolment.extract_disabilities(t).drop("severity", "date_updated")


@query("""SELECT id, learner_id, school_id, academic_year_id, teaching_period_id, reporting_status_id, promotion_status_id AS learner_promotion_status_id, enrolment_type_id, is_enrolment_active_yn, date_created
FROM {src_learner_enrolments} WHERE is_enrolment_active_yn IS TRUE""")
def enrolments_extract(t):
    return enrolment.extract_enrolments(t).drop("date_updated")


@query("""SELECT e.id AS enrolment_id, upper(coalesce(st.name, el.name, 'UNKNOWN')) AS school_level, e.education_grade_id AS education_class_id, g.name AS education_class_name,
 e.familiar_language_id, f.name AS familiar_language_name FROM {src_learner_enrolments} e LEFT JOIN {src_setting_education_grades} g ON g.id = e.education_grade_id
 LEFT JOIN {src_setting_education_levels} el ON el.id = g.education_level_id LEFT JOIN {src_setting_school_types} st ON st.id = el.school_type_id
 LEFT JOIN {src_setting_familiar_languages} f ON f.id = e.familiar_language_id WHERE e.is_enrolment_active_yn IS TRUE""")
def enrolment_subtypes_extract(t):
    return enrolment.extract_subtypes(t).drop("date_created")


EVENTS = """SELECT enrolment_id, learner_id, school_id, academic_year_id, education_grade_id, promotion_status_id, s.name AS status_name FROM {@} e
LEFT JOIN {src_setting_promotion_statuses} s ON s.id = e.promotion_status_id QUALIFY row_number() OVER (PARTITION BY enrolment_id ORDER BY date_created, learner_id, school_id) = 1"""


@query(f"SELECT enrolment_id AS id, learner_id, school_id, academic_year_id, education_grade_id AS from_class_id, promotion_status_id, status_name AS promotion_status_name FROM ({EVENTS.replace('@', 'src_learner_promotions')}) AS e")
def promotions_extract(t):
    return enrolment.extract_promotions(t).drop("to_class_id", "date_created", "date_updated")


@query(f"SELECT enrolment_id AS id, learner_id, school_id AS to_school_id, academic_year_id, promotion_status_id AS transition_status_id, status_name AS transition_status_name FROM ({EVENTS.replace('@', 'src_learner_transitions')}) AS e")
def transitions_extract(t):
    return enrolment.extract_transitions(t).drop("from_school_id", "date_created", "date_updated")


def _any_word(words: Sequence[str]) -> str:
    tests = " OR ".join(f"upper(disability_type) LIKE '{w}'" for w in words)
    return f"coalesce(bool_or({tests}), FALSE)"


FLAT_FLAGS = ", ".join(f"{_any_word(words)} AS {flag}" for flag, words in enrolment.DISABILITY_WORDS.items())
KIND3 = ("pre_primary_schools", "primary_schools", "secondary_schools")


def _coalesced(flag: str) -> str:
    return "coalesce(" + ", ".join(f"k{i}.{flag}" for i in range(3)) + ")"


@query(f"""
WITH dis AS (SELECT learner_id, {FLAT_FLAGS} FROM {{stg_learner_disabilities_raw}} GROUP BY learner_id), per AS ({PERIODS}),
sch AS (SELECT s.id, s.emis_number, s.name, {OWNED} AS owned, coalesce(fu.name, '') AS funding, {sex_sql('s.has_male_students', 's.has_female_students')} AS sex,
  {residence_sql(_coalesced(DAY), _coalesced(BOARD))} AS lodging, coalesce(st.name, '') AS kind, {PLACE} AS place FROM {{src_schools}} s {SCHOOL_NAMES}
  LEFT JOIN {{src_setting_funding_sources}} fu ON fu.id = s.funding_source_id {' '.join(f'LEFT JOIN {{src_{k}}} k{i} ON k{i}.school_id = s.id' for i, k in enumerate(KIND3))})
SELECT e.id AS enrolment_source_id, e.learner_id AS learner_source_id, e.school_id AS school_source_id, per.academic_year, per.term, l.lin, l.gender,
 CAST(2025 - year(l.date_of_birth) AS INTEGER) AS age, l.nationality, l.nin, l.student_pass_no,
 CASE WHEN pa.is_father_dead AND pa.is_mother_dead THEN 'BOTH DECEASED' WHEN pa.is_mother_dead THEN 'MOTHER DECEASED' WHEN pa.is_father_dead THEN 'FATHER DECEASED' ELSE 'NOT APPLICABLE' END AS orphan_status,
 {', '.join(f'coalesce(dis.{f}, FALSE) AS {f}' for f in DISABILITY_FLAGS)}, ({' + '.join(f'coalesce(CAST(dis.{f} AS INTEGER), 0)' for f in DISABILITY_FLAGS)}) > 1 AS has_multiple_disabilities_yn,
 c.education_class_name AS grade, c.school_level, coalesce(upper(et.name), 'CONTINUING') AS enrolment_type, e.is_enrolment_active_yn AS is_active, sch.emis_number AS school_emis_number, sch.name AS school_name,
 sch.owned AS school_ownership, sch.funding AS school_funding_type, sch.sex AS school_sex_composition, sch.lodging AS school_boarding_status, sch.kind AS school_type, sch.place AS admin_unit_source_id
FROM {{stg_enrolments_raw}} e JOIN per ON per.id = e.teaching_period_id JOIN {{src_learner_enrolments}} le ON le.id = e.id JOIN {{stg_learners_raw}} l ON l.person_id = e.learner_id
JOIN {{src_learners}} pa ON pa.person_id = e.learner_id LEFT JOIN dis ON dis.learner_id = e.learner_id LEFT JOIN {{stg_enrolments_subtype_raw}} c ON c.enrolment_id = e.id
LEFT JOIN {{src_setting_enrolment_types}} et ON et.id = le.enrolment_type_id JOIN sch ON sch.id = e.school_id""")
def enrolments_flatten(t):
    return enrolment.flatten_enrolments(t, TODAY).drop("passport_no", "work_permit_no", "refugee_id")


ONE_LEARNER = """SELECT learner_source_id AS source_id, age AS age_at_load, * FROM {stg_enrolments_flat}
QUALIFY row_number() OVER (PARTITION BY learner_source_id ORDER BY age DESC NULLS LAST, enrolment_source_id DESC) = 1"""


@query(merge_sql("dw_learner_dim", ONE_LEARNER, "source_id", LEARNER_HASHED, ["lin", "age_at_load"]))
def learners_merge(t):
    return merged(enrolment.merge_learners(t, TODAY), ["source_id", *LEARNER_HASHED, "lin", "age_at_load"])


@query(merge_sql("dw_learner_dim", ONE_LEARNER, "source_id", LEARNER_HASHED, ["lin", "age_at_load"], initial=True))
def learners_merge_literal(t):
    return merged(enrolment.merge_learners(t, TODAY, compat=True), ["source_id", *LEARNER_HASHED, "lin", "age_at_load"])


def fact_sql(flat: str, person: str, person_dim: str, person_id: str, extra: str, joins: str, order: str) -> str:
    """SQL: load by valid versions first, then the missing natural keys by the earliest versions."""
    key = f"{person}, school, academic_year, term"
    rank = f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"
    same = " AND ".join(f"f.{k.strip()} = r.{k.strip()}" for k in key.split(","))
    out = f"{person}, school AS school_source_id, academic_year, term, {person_id}, school_id, date_id{extra}"
    return f"""
WITH r AS ({flat}),
f AS (SELECT r.*, p.id AS {person_id}, s.id AS school_id FROM r JOIN {{{person_dim}}} p ON p.source_id = r.{person} AND r.start >= p.effective_date AND r.start < p.expiration_date
  JOIN {{dw_schools_dim}} s ON s.source_id = r.school AND r.start >= s.effective_date AND r.start < s.expiration_date {rank}),
p1 AS (SELECT source_id, min_by(id, effective_date) AS id FROM {{{person_dim}}} GROUP BY 1), s1 AS (SELECT source_id, min_by(id, effective_date) AS id FROM {{dw_schools_dim}} GROUP BY 1),
g AS (SELECT r.*, p1.id AS {person_id}, s1.id AS school_id FROM r JOIN p1 ON p1.source_id = r.{person} JOIN s1 ON s1.source_id = r.school
  WHERE NOT EXISTS (SELECT 1 FROM f WHERE {same}) {rank})
SELECT {out}, CAST(1 AS INTEGER) AS load_phase FROM f UNION ALL SELECT {out}, CAST(2 AS INTEGER) FROM g"""


@query(fact_sql("""SELECT e.learner_source_id, e.school_source_id AS school, e.academic_year, e.term, e.enrolment_source_id, g.id AS grade_id, k.id AS enrolment_type_id, d.id AS date_id,
 d.system_date AS start FROM {stg_enrolments_flat} e JOIN {dw_date_dim} d ON d.system_date = make_date(e.academic_year, CASE e.term WHEN 'TERM 2' THEN 6 WHEN 'TERM 3' THEN 9 ELSE 2 END, 1)
 LEFT JOIN {dw_grade_dim} g ON g.grade_code = e.grade LEFT JOIN {dw_enrolment_type_dim} k ON k.enrolment_type = e.enrolment_type WHERE e.is_active""",
                "learner_source_id", "dw_learner_dim", "learner_id", ", grade_id, enrolment_type_id, enrolment_source_id", "", "enrolment_source_id"))
def enrolment_fact(t):
    return enrolment.enrolment_fact(t).drop("id")


# ----------------------------------------------------------------------------- teachers

@query("""
WITH j AS (SELECT * FROM {src_school_employees} WHERE is_teaching_staff IS TRUE QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY date_updated DESC NULLS LAST, id) = 1),
i AS (SELECT d.person_id, max(CASE WHEN k.name ILIKE '%national%' OR k.name ILIKE '%nin%' THEN document_id END) AS nin, max(CASE WHEN k.name ILIKE '%passport%' THEN document_id END) AS passport_no
  FROM {src_identity_documents} d JOIN {src_setting_identity_document_types} k ON k.id = d.identity_type_id GROUP BY 1)
SELECT x.person_id, j.id AS employee_id, p.surname, trim(coalesce(p.first_name, '') || ' ' || coalesce(p.other_names, '')) AS given_name, p.gender, coalesce(c.name, 'UGANDA') AS nationality,
 i.nin, i.passport_no, tt.name AS teacher_type, q.name AS qualification, q.qualification_category, ds.name AS designation, coalesce(x.ipps_number, j.ipps_number) AS ipps_number, x.tmis_number,
 coalesce(x.is_on_government_payroll, j.is_on_government_payroll) AS is_on_government_payroll, el.name AS highest_education_level, es.name AS employment_status, j.hrin, j.date_started,
 j.is_undergoing_training, x.current_school_id, greatest(x.date_updated, j.date_updated) AS date_updated
FROM {src_teachers} x JOIN {src_persons} p ON p.id = x.person_id LEFT JOIN {src_admin_unit_countries} c ON c.id = p.country_id LEFT JOIN i ON i.person_id = x.person_id LEFT JOIN j ON j.person_id = x.person_id
LEFT JOIN {src_setting_teacher_types} tt ON tt.id = x.teacher_type_id LEFT JOIN {src_setting_teacher_professional_qualifications} q ON q.id = x.qualification_id
LEFT JOIN {src_setting_teaching_staff_designations} ds ON ds.id = x.designation_id LEFT JOIN {src_setting_education_levels} el ON el.id = j.highest_education_level_id
LEFT JOIN {src_setting_employment_statuses} es ON es.id = j.employment_status_id WHERE p.deleted_at IS NULL""")
def teachers_extract(t):
    return teachers.extract_teachers(t).drop(
        "date_of_birth", "moes_license_number", "first_appointment_date", "posting_date", "subject_category", "hcm_employee_number", "date_ended",
        "weekly_teaching_periods", "date_created")


@query("""SELECT ts.id, ts.employee_id, j.person_id, ts.subject_id, s.name AS subject_name, s.is_science_subject, s.is_language_subject FROM {src_teacher_subjects} ts
JOIN {src_school_employees} j ON j.id = ts.employee_id JOIN {src_setting_secondary_school_subjects} s ON s.id = ts.subject_id WHERE s.deleted_at IS NULL AND s.is_active_yn""")
def teacher_subjects_extract(t):
    return teachers.extract_teacher_subjects(t).drop("date_created", "date_updated")


@query("""SELECT employee_id, person_id, school_id, is_transfer_appointment, staff_category, date_updated FROM {src_teaching_staff} WHERE school_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY date_updated DESC NULLS LAST, school_id, person_id) = 1""")
def deployments_extract(t):
    return teachers.extract_deployments(t).drop("appointment_date", "date_created")


@query(f"""
WITH pp AS ({PERIODS}), gen AS ({GENERAL}),
own AS (SELECT * FROM pp WHERE status = 'active' AND school_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM gen WHERE gen.academic_year = pp.academic_year AND gen.term = pp.term)
  QUALIFY row_number() OVER (PARTITION BY school_id, academic_year, term ORDER BY school_type_id, start_date) = 1),
allp AS (SELECT academic_year, term, start_date, school_id FROM gen UNION ALL SELECT academic_year, term, start_date, school_id FROM own),
n AS (SELECT person_id, count(*) AS total, count(*) FILTER (WHERE is_science_subject) AS science FROM {{stg_teacher_subjects_raw}} GROUP BY 1)
SELECT x.person_id, x.employee_id, d.school_id, allp.academic_year, allp.term, allp.start_date AS term_start_date, x.gender, CAST(2025 - year(x.date_of_birth) AS INTEGER) AS age, x.teacher_type,
 CASE WHEN n.total IS NULL THEN NULL WHEN n.science = n.total THEN 'SCIENCE' WHEN n.science = 0 THEN 'ARTS' ELSE 'BOTH' END AS discipline, x.highest_education_level, s.emis_number AS school_emis_number,
 s.name AS school_name, st.name AS school_type, {OWNED} AS school_ownership, el.name AS school_level, {PLACE} AS admin_unit_source_id
FROM {{stg_teachers_raw}} x JOIN {{stg_teacher_school_raw}} d ON d.person_id = x.person_id JOIN {{src_schools}} s ON s.id = d.school_id {SCHOOL_NAMES}
LEFT JOIN {{src_setting_education_levels}} el ON el.id = s.school_type_id LEFT JOIN n ON n.person_id = x.person_id JOIN allp ON allp.school_id IS NULL OR allp.school_id = d.school_id""")
def teachers_flatten(t):
    return teachers.flatten_teachers(t, TODAY).select(
        "person_id", "employee_id", "school_id", "academic_year", "term", "term_start_date", "gender", "age", "teacher_type", "discipline", "highest_education_level",
        "school_emis_number", "school_name", "school_type", "school_ownership", "school_level", "admin_unit_source_id")


ONE_PERSON = """SELECT person_id AS source_id, * FROM {@}
QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY term_start_date DESC NULLS LAST, school_id, term) = 1"""


@query(merge_sql("dw_teacher_dim", ONE_PERSON.replace("@", "stg_teachers_flat"), "source_id", TEACHER_HASHED, ["employee_id", "ipps_number"]))
def teachers_merge(t):
    return merged(teachers.merge_teachers(t, TODAY), ["source_id", *TEACHER_HASHED, "employee_id", "ipps_number"])


PERSON_FLAT = """SELECT x.person_id, x.school_id AS school, x.academic_year, x.term, x.term_start_date AS start, d.id AS date_id{} FROM {{{{{}}}}} x JOIN {{{{dw_date_dim}}}} d ON d.system_date = x.term_start_date"""


def person_flat(table: str, extra: str = "") -> str:
    return PERSON_FLAT.format(extra, table).replace("{{", "{").replace("}}", "}")


@query(fact_sql(person_flat("stg_teachers_flat"), "person_id", "dw_teacher_dim", "teacher_id", "", "", "start"))
def hr_fact(t):
    return teachers.hr_fact(t).drop("id")


# ----------------------------------------------------------------------------- staff

@query("""
SELECT n.person_id, j.id AS employee_id, n.employee_id AS nts_employee_id, p.surname, trim(coalesce(p.first_name, '') || ' ' || coalesce(p.other_names, '')) AS given_name, p.gender,
 coalesce(c.name, 'UGANDA') AS nationality, p.id_number AS nin, ca.name AS category, ro.name AS role, coalesce(j.school_id, n.current_school_id) AS current_school_id, el.name AS highest_education_level,
 es.name AS employment_status, coalesce(j.is_on_government_payroll, FALSE) AS is_on_government_payroll, j.ipps_number, j.hcm_employee_number, j.is_undergoing_training,
 greatest(coalesce(n.date_updated, n.date_created), coalesce(j.date_updated, j.date_created)) AS date_updated
FROM {src_non_teaching_staff} n JOIN {src_persons} p ON p.id = n.person_id LEFT JOIN {src_admin_unit_countries} c ON c.id = p.country_id LEFT JOIN {src_school_employees} j ON j.id = n.employee_id
LEFT JOIN {src_setting_non_teaching_staff_categories} ca ON ca.id = n.non_teaching_staff_category_id LEFT JOIN {src_setting_non_teaching_staff_roles} ro ON ro.id = n.non_teaching_staff_role_id
LEFT JOIN {src_setting_education_levels} el ON el.id = j.highest_education_level_id LEFT JOIN {src_setting_employment_statuses} es ON es.id = j.employment_status_id WHERE p.deleted_at IS NULL""")
def staff_extract(t):
    return staff.extract_staff(t).drop(
        "date_of_birth", "is_transfer_appointment", "appointment_date", "posting_date", "hrin", "date_started", "date_ended", "date_created")


@query(f"""
WITH pp AS ({PERIODS}), one AS (SELECT * FROM pp WHERE status = 'active' AND school_id IS NULL QUALIFY row_number() OVER (PARTITION BY academic_year_id, teaching_period_id ORDER BY school_type_id, start_date) = 1)
SELECT n.person_id, n.employee_id, n.current_school_id AS school_id, one.academic_year, one.term, one.start_date AS term_start_date, n.gender, CAST(2025 - year(n.date_of_birth) AS INTEGER) AS age, n.category, n.role,
 n.employment_status, s.emis_number AS school_emis_number, s.name AS school_name, st.name AS school_type, {OWNED} AS school_ownership, {PLACE} AS admin_unit_source_id, TRUE AS is_primary_school
FROM {{stg_non_teaching_staff_raw}} n JOIN {{src_schools}} s ON s.id = n.current_school_id {SCHOOL_NAMES}, one""")
def staff_flatten(t):
    return staff.flatten_staff(t, TODAY).select(
        "person_id", "employee_id", "school_id", "academic_year", "term", "term_start_date", "gender", "age", "category", "role", "employment_status", "school_emis_number",
        "school_name", "school_type", "school_ownership", "admin_unit_source_id", "is_primary_school")


@query(merge_sql("dw_non_teaching_staff_dim", ONE_PERSON.replace("@", "stg_non_teaching_staff_flat"), "source_id", STAFF_HASHED))
def staff_merge(t):
    return merged(staff.merge_staff(t, TODAY), ["source_id", *STAFF_HASHED])


@query(f"""
WITH r AS ({person_flat('stg_non_teaching_staff_flat', ', x.is_on_government_payroll, x.is_primary_school')}), p1 AS (SELECT source_id, min_by(id, effective_date) AS id FROM {{dw_non_teaching_staff_dim}} GROUP BY 1),
s1 AS (SELECT source_id, min_by(id, effective_date) AS id FROM {{dw_schools_dim}} GROUP BY 1)
SELECT p1.id AS staff_id, s1.id AS school_id, date_id, person_id, school AS school_source_id, academic_year, term, is_primary_school, is_on_government_payroll FROM r JOIN p1 ON p1.source_id = r.person_id
JOIN s1 ON s1.source_id = r.school QUALIFY row_number() OVER (PARTITION BY person_id, school, academic_year, term ORDER BY start) = 1""")
def staff_fact(t):
    return staff.staff_fact(t).drop("id")


# ----------------------------------------------------------------------------- infrastructure

TYPE_FLAG_LIST = [*infrastructure.TYPE_FLAGS, *infrastructure.LEVEL_FLAGS]


@query(f"""
WITH n AS (SELECT b.id AS source_id, b.name AS type_name, c.name AS item_category, {', '.join(f'coalesce(k.{f}, FALSE) AS {f}' for f in TYPE_FLAG_LIST)}, coalesce(b.is_active_yn, TRUE) AS is_active_yn
  FROM {{src_setting_school_building_types}} b LEFT JOIN {{src_setting_school_item_categories}} c ON c.id = b.item_category_id LEFT JOIN {{src_setting_school_infrastructure_types}} k ON k.id = b.id
  WHERE b.deleted_at IS NULL AND b.is_archived_yn = FALSE), d AS (SELECT * FROM {{dw_infrastructure_type_dim}})
SELECT d.source_id, coalesce(n.type_name, d.type_name) AS type_name, CASE WHEN n.source_id IS NULL THEN d.item_category ELSE n.item_category END AS item_category, coalesce(n.is_lab_yn, d.is_lab_yn) AS is_lab_yn,
  coalesce(n.is_sanitation_yn, d.is_sanitation_yn) AS is_sanitation_yn, {', '.join(f'd.{f}' for f in TYPE_FLAG_LIST[2:])}, coalesce(n.is_active_yn, d.is_active_yn) AS is_active_yn FROM d LEFT JOIN n USING (source_id)
UNION ALL SELECT n.source_id, n.type_name, n.item_category, {', '.join(f'n.{f}' for f in TYPE_FLAG_LIST)}, n.is_active_yn FROM n WHERE n.source_id NOT IN (SELECT source_id FROM d)""")
def type_dim_upsert(t):
    return infrastructure.merge_types(t).drop("id")


@query(f"""
SELECT b.id AS building_status_id, b.school_id, s.name AS school_name, st.name AS school_type, {PLACE} AS admin_unit_source_id, b.building_id, bt.name AS building_name, c.name AS item_category,
 k.id AS infrastructure_type_id, k.name AS infrastructure_type_name, {', '.join(f'coalesce(k.{f}, FALSE) AS {f}' for f in infrastructure.TYPE_FLAGS)}, {year_sql('y.name', 'b.date_created')} AS academic_year, {term_sql('n.name')} AS term,
 b.total_number, CASE WHEN b.area >= 0 AND b.area < 1e13 THEN CAST(floor(b.area * 100 + 0.5) AS DOUBLE) / 100 END AS area, {case('b.completion_status', COMPLETION)} AS completion_status, {case('b.usage_mode', USAGE_MODE)} AS usage_mode,
 {case('b.condition', CONDITION)} AS structure_condition, {case('b.gender_usage', GENDER_USAGE)} AS gender_usage, {case('b.user_category', USER_CATEGORY)} AS user_category
FROM {{src_school_building_status_updates}} b JOIN {{src_schools}} s ON s.id = b.school_id {SCHOOL_NAMES} LEFT JOIN {{src_setting_school_building_types}} bt ON bt.id = b.building_id
LEFT JOIN {{src_setting_school_item_categories}} c ON c.id = bt.item_category_id LEFT JOIN {{src_setting_school_infrastructure_types}} k ON k.id = b.building_id
LEFT JOIN {{src_setting_academic_years}} y ON y.id = b.academic_year_id LEFT JOIN {{src_setting_teaching_periods}} n ON n.id = b.teaching_period_id""".replace("{{", "{").replace("}}", "}"))
def buildings_extract(t):
    return plain(infrastructure.extract_buildings(t).drop("date_created", "date_updated"))


FEBRUARY = "LEFT JOIN {dw_date_dim} feb ON feb.system_date = make_date(r.academic_year, 2, 1)"


@query(f"""
WITH gen AS ({GENERAL}), r AS (SELECT * FROM {{stg_infrastructure_raw}} WHERE school_id IS NOT NULL AND building_id IS NOT NULL AND academic_year IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY school_id, building_id, academic_year, term ORDER BY building_status_id DESC) = 1)
SELECT v.id AS school_id, k.id AS infra_type_id, coalesce(d.id, feb.id) AS date_id, r.school_id AS school_source_id, r.building_id AS building_source_id, r.academic_year, r.term, r.total_number, CAST(r.area AS DOUBLE) AS area,
 r.completion_status, r.usage_mode, r.structure_condition, r.gender_usage, r.user_category FROM r JOIN {{dw_schools_dim}} v ON v.source_id = r.school_id AND v.is_current JOIN {{dw_infrastructure_type_dim}} k ON k.source_id = r.building_id
LEFT JOIN gen ON gen.academic_year = r.academic_year AND gen.term = r.term LEFT JOIN {{dw_date_dim}} d ON d.system_date = gen.start_date {FEBRUARY}""")
def infrastructure_fact(t):
    return plain(infrastructure.infrastructure_fact(t).drop("id"))


# ----------------------------------------------------------------------------- subjects

@query(f"""SELECT id AS source_id, 'SECONDARY' AS subject_level, name AS subject_name, {', '.join(subjects.DESCRIBED)}, is_archived_yn FROM {{src_setting_secondary_school_subjects}} WHERE deleted_at IS NULL
UNION ALL SELECT id, 'PRIMARY', name, coalesce(is_language_subject, FALSE), FALSE, NULL, NULL, NULL, NULL, NULL, NULL, is_active_yn, is_archived_yn FROM {{src_setting_primary_school_subjects}} WHERE deleted_at IS NULL""")
def subjects_list(t):
    return subjects.subject_list(t).drop("date_created", "date_updated")


AT_SCHOOL = f"""SELECT x.person_id, x.employee_id AS teacher_employee, x.teacher_type, x.gender, x.qualification, d.school_id, s.name AS school_name, st.name AS school_type, {PLACE} AS place
 FROM {{stg_teachers_raw}} x JOIN {{stg_teacher_school_raw}} d ON d.person_id = x.person_id LEFT JOIN {{src_schools}} s ON s.id = d.school_id {SCHOOL_NAMES}"""


@query(f"""
WITH a AS ({AT_SCHOOL}),
sec AS (SELECT u.person_id, u.employee_id, u.subject_id, u.subject_name, 'SECONDARY' AS subject_level, u.is_science_subject, u.is_language_subject, s.is_olevel_subject, a.school_id, a.school_name, a.school_type, a.teacher_type, a.place
  FROM {{stg_teacher_subjects_raw}} u JOIN a ON a.person_id = u.person_id LEFT JOIN {{src_setting_secondary_school_subjects}} s ON s.id = u.subject_id
  QUALIFY row_number() OVER (PARTITION BY u.person_id, u.subject_id ORDER BY a.school_id NULLS LAST, u.id) = 1),
both_ AS (SELECT person_id, trained_subject_1_id AS sid FROM {{src_teachers}} UNION SELECT person_id, trained_subject_2_id FROM {{src_teachers}}),
pri AS (SELECT b.person_id, a.teacher_employee, b.sid, p.name, 'PRIMARY', FALSE, coalesce(p.is_language_subject, FALSE), CAST(NULL AS BOOLEAN), a.school_id, a.school_name, a.school_type, a.teacher_type, a.place FROM both_ b
  JOIN {{src_setting_primary_school_subjects}} p ON p.id = b.sid AND p.deleted_at IS NULL JOIN a ON a.person_id = b.person_id WHERE NOT EXISTS (SELECT 1 FROM sec WHERE sec.person_id = b.person_id AND sec.subject_id = b.sid)
  QUALIFY row_number() OVER (PARTITION BY b.person_id, b.sid ORDER BY a.school_id NULLS LAST) = 1)
SELECT person_id, employee_id, subject_id, subject_name, subject_level, is_science_subject, is_language_subject, is_olevel_subject, school_id, school_name, school_type, teacher_type, place AS admin_unit_source_id FROM (SELECT * FROM sec UNION ALL SELECT * FROM pri) AS u""")
def teaching_flatten(t):
    return subjects.flatten_teaching(t).drop("is_principal_subject", "is_alevel_subject", "gender", "qualification", "date_created", "date_updated")


@query(f"""
WITH n AS (SELECT *, CASE WHEN is_language_subject THEN 'LANGUAGE' WHEN is_science_subject THEN 'SCIENCE' ELSE 'ARTS' END AS subject_category FROM {{stg_subject_dim_raw}}), d AS (SELECT * FROM {{dw_subject_dim}})
SELECT d.source_id, d.subject_level, {', '.join(f'CASE WHEN n.source_id IS NULL THEN d.{c} ELSE n.{c} END AS {c}' for c in subjects.SUBJECT_UPDATES)} FROM d LEFT JOIN n ON n.source_id = d.source_id AND n.subject_level = d.subject_level
UNION ALL SELECT n.source_id, n.subject_level, {', '.join(f'n.{c}' for c in subjects.SUBJECT_UPDATES)} FROM n ANTI JOIN d ON n.source_id = d.source_id AND n.subject_level = d.subject_level""")
def subject_dim_upsert(t):
    return subjects.merge_subjects(t).drop("id")


@query("""SELECT x.id AS teacher_id, v.id AS school_id, b.id AS subject_id, coalesce((SELECT id FROM {dw_date_dim} WHERE system_date = DATE '2025-01-15'), 0) AS date_id, f.person_id, f.school_id AS school_source_id, f.subject_id AS subject_source_id, f.subject_level
FROM {stg_teaching_subject_flat} f JOIN {dw_teacher_dim} x ON x.source_id = f.person_id AND x.is_current JOIN {dw_schools_dim} v ON v.source_id = f.school_id AND v.is_current
JOIN {dw_subject_dim} b ON b.source_id = f.subject_id AND b.subject_level = f.subject_level""")
def teaching_subject_fact(t):
    return subjects.teaching_fact(t, TODAY).drop("id")


# ----------------------------------------------------------------------------- transfers

@query(f"""
WITH n AS (SELECT person_id, count(*) AS total, count(*) FILTER (WHERE is_science_subject) AS science FROM {{stg_teacher_subjects_raw}} GROUP BY 1),
last AS (SELECT x.id, max(p.posting_date) AS posted FROM {{src_teacher_transfers}} x JOIN {{src_teacher_postings}} p ON p.person_id = x.person_id AND p.school_id = x.outgoing_school_id AND p.posting_date < x.posting_date AND p.status <= 2 GROUP BY 1)
SELECT x.id AS transfer_id, x.person_id, x.outgoing_school_id, x.incoming_school_id, so.name AS outgoing_school_name, si.name AS incoming_school_name, ko.name AS outgoing_school_type, ki.name AS incoming_school_type, od.id AS outgoing_district_id, idd.id AS incoming_district_id,
 od.name AS outgoing_district_name, idd.name AS incoming_district_name, coalesce(od.id <> idd.id, FALSE) AS is_inter_district, x.posting_date, x.reporting_date, {case('x.status', TRANSFER_STATUS, "'UNKNOWN'")} AS transfer_status,
 CAST(x.posting_date - last.posted AS INTEGER) AS days_at_outgoing_station, tr.teacher_type, tr.gender, tr.qualification, CASE WHEN n.total IS NULL THEN NULL WHEN n.science = n.total THEN 'SCIENCE' WHEN n.science = 0 THEN 'ARTS' ELSE 'BOTH' END AS discipline, tr.ipps_number
FROM {{src_teacher_transfers}} x LEFT JOIN {{src_schools}} so ON so.id = x.outgoing_school_id LEFT JOIN {{src_setting_school_types}} ko ON ko.id = so.school_type_id LEFT JOIN {{src_schools}} si ON si.id = x.incoming_school_id
LEFT JOIN {{src_setting_school_types}} ki ON ki.id = si.school_type_id LEFT JOIN {{src_admin_unit_upper_local_governments}} og ON og.id = x.outgoing_local_government_id LEFT JOIN {{src_admin_unit_districts}} od ON od.id = og.district_id AND NOT od.is_archived_yn
LEFT JOIN {{src_admin_unit_upper_local_governments}} ig ON ig.id = x.incoming_local_government_id LEFT JOIN {{src_admin_unit_districts}} idd ON idd.id = ig.district_id AND NOT idd.is_archived_yn LEFT JOIN last ON last.id = x.id
LEFT JOIN {{stg_teachers_raw}} tr ON tr.person_id = x.person_id LEFT JOIN n ON n.person_id = x.person_id""".replace("{{", "{").replace("}}", "}"))
def transfers_extract(t):
    return transfers.extract_transfers(t).drop("employee_id", "outgoing_employee_id", "appointment_minute_number", "category_id", "date_created", "date_updated")


@query("""
WITH dis AS (SELECT * FROM {dw_admin_units_dim} WHERE admin_unit_type = 'District' AND current_status), cur AS (SELECT * FROM {dw_schools_dim} WHERE is_current)
SELECT x.id AS teacher_id, so.id AS out_school_id, si.id AS in_school_id, od.id AS out_district_id, ic.id AS in_district_id, coalesce(d.id, (SELECT max(id) FROM {dw_date_dim})) AS date_id, r.person_id, r.transfer_id AS transfer_source_id,
 r.outgoing_school_id AS outgoing_school_source_id, r.incoming_school_id AS incoming_school_source_id, r.appointment_minute_number, r.is_inter_district, r.days_at_outgoing_station, CAST(r.reporting_date - r.posting_date AS INTEGER) AS days_to_report
FROM {stg_teacher_transfers_raw} r JOIN {dw_teacher_dim} x ON x.source_id = r.person_id AND x.is_current LEFT JOIN cur so ON so.source_id = r.outgoing_school_id LEFT JOIN cur si ON si.source_id = r.incoming_school_id
LEFT JOIN dis od ON od.source_id = r.outgoing_district_id LEFT JOIN dis ic ON ic.source_id = r.incoming_district_id LEFT JOIN {dw_date_dim} d ON d.system_date = r.posting_date WHERE r.transfer_status = 'APPROVED'""")
def transfer_fact(t):
    return transfers.transfer_fact(t).drop("id", "transfer_status", "posting_date", "reporting_date")


# ----------------------------------------------------------------------------- indicators

def _band(per_mille: int) -> str:
    return f"CAST((2 * total_population * {per_mille} + 1000) // 2000 AS BIGINT)"


@query(f"""SELECT p.district_name, d.id AS district_source_id, p.year, p.sex, p.total_population, {_band(55)} AS pop_age_3_5, {_band(18)} AS pop_age_6, {_band(125)} AS pop_age_6_12, {_band(68)} AS pop_age_13_16, {_band(32)} AS pop_age_17_18
FROM {{src_population}} p LEFT JOIN {{src_admin_unit_districts}} d ON lower(trim(d.name)) = lower(trim(p.district_name)) AND NOT d.is_archived_yn""")
def population_load(t):
    return indicators.population_raw(t).drop("data_source")


@query(f"SELECT a.id AS district_id, p.district_name, p.year, p.sex, {', '.join('p.' + c for c in indicators.POPULATION_UPDATES)} FROM {{stg_population_raw}} p JOIN {{dw_admin_units_dim}} a ON a.source_id = p.district_source_id AND a.admin_unit_type = 'District' AND a.current_status")
def population_fact(t):
    return indicators.population_fact(t).drop("id", "data_source")


BASE_COUNTS = CLIMB_SQL + """,
c AS (SELECT r.district_id, r.name AS district_name, v.school_type AS school_level, f.academic_year, l.gender, count(*) AS total_enrolment,
  count(*) FILTER (WHERE (upper(g.grade_name) LIKE '%P1%' OR upper(g.grade_name) LIKE '%BABY%' OR upper(g.grade_code) = 'P1') AND e.enrolment_type IN ('BASELINE', 'NEW')) AS new_entrants_p1,
  count(*) FILTER (WHERE l.is_visual_yn OR l.is_hearing_yn OR l.is_walking_yn OR l.is_self_care_yn OR l.is_remembering_yn OR l.is_communication_yn) AS learners_with_disability
  FROM {dw_enrolment_fact} f JOIN {dw_learner_dim} l ON l.id = f.learner_id AND l.is_current JOIN {dw_schools_dim} v ON v.id = f.school_id AND v.is_current LEFT JOIN {dw_grade_dim} g ON g.id = f.grade_id
  LEFT JOIN {dw_enrolment_type_dim} e ON e.id = f.enrolment_type_id JOIN reach r ON r.id = v.admin_unit_id WHERE f.academic_year >= 2022 AND l.gender IS NOT NULL GROUP BY ALL)
"""


@query(BASE_COUNTS + f""",
t AS (SELECT * FROM c UNION ALL SELECT district_id, district_name, school_level, academic_year, 'TOTAL', CAST(sum(total_enrolment) AS BIGINT), CAST(sum(new_entrants_p1) AS BIGINT), CAST(sum(learners_with_disability) AS BIGINT) FROM c
  WHERE upper(gender) IN ('M', 'F', 'MALE', 'FEMALE') GROUP BY ALL),
b AS (SELECT t.*, CASE WHEN school_level ILIKE '%PRE%PRIMARY%' THEN p.pop_age_3_5 WHEN school_level ILIKE '%PRIMARY%' AND school_level NOT ILIKE '%PRE%' THEN p.pop_age_6_12 WHEN school_level ILIKE '%SECONDARY%' THEN p.pop_age_13_16 + p.pop_age_17_18 END AS served,
  p.pop_age_6 AS six, school_level ILIKE '%PRIMARY%' AND school_level NOT ILIKE '%PRE%' AS is_primary FROM t LEFT JOIN {{dw_population_fact}} p ON p.district_id = t.district_id AND p.year = t.academic_year
  AND p.sex = CASE upper(t.gender) WHEN 'M' THEN 'M' WHEN 'MALE' THEN 'M' WHEN 'F' THEN 'F' WHEN 'FEMALE' THEN 'F' ELSE 'TOTAL' END)
SELECT district_id, district_name, school_level, academic_year, gender, total_enrolment, new_entrants_p1, learners_with_disability, served AS school_age_population, six AS population_age_6,
 {pct('total_enrolment', 'served', 2)} AS ger, CASE WHEN is_primary THEN {pct('new_entrants_p1', 'six', 2)} END AS gir, {pct('0', 'total_enrolment', 2)} AS repetition_rate, {pct('learners_with_disability', 'total_enrolment', 2)} AS sne_inclusion_rate FROM b""")
def enrolment_indicators(t):
    return plain(indicators.enrolment_indicators(t).drop("official_age_enrolment", "new_entrants_p1_official_age", "repeaters", "ner"))


EIF = "district_id, school_level, academic_year, gender"


@query(f"""
WITH gen AS ({GENERAL}), one AS (SELECT gen.academic_year, min_by(d.id, gen.start_date) AS id FROM gen JOIN {{dw_date_dim}} d ON d.system_date = gen.start_date WHERE period_name = '1' GROUP BY 1),
r AS (SELECT s.* FROM {{stg_enrolment_indicator_raw}} s WHERE s.district_id IS NOT NULL)
SELECT r.district_id, coalesce(one.id, feb.id) AS date_id, r.school_level, r.academic_year, r.gender, r.total_enrolment, r.new_entrants_p1, r.learners_with_disability, CAST(r.ger AS DOUBLE) AS ger FROM r
LEFT JOIN one ON one.academic_year = r.academic_year {FEBRUARY}""")
def enrolment_indicator_rows(t):
    return plain(indicators.enrolment_indicator_rows(t).select(
        "district_id", "date_id", "school_level", "academic_year", "gender", "total_enrolment", "new_entrants_p1", "learners_with_disability", "ger"))


@query(f"""
WITH old AS (SELECT * FROM {{dw_enrolment_indicator_fact}} WHERE school_level IS NOT NULL AND total_enrolment > 2), new AS (SELECT * FROM {{stg_enrolment_indicator_raw}} WHERE district_id IS NOT NULL),
m AS (SELECT coalesce(o.district_id, n.district_id) AS district_id, coalesce(o.school_level, n.school_level) AS school_level, coalesce(o.academic_year, n.academic_year) AS academic_year, coalesce(o.gender, n.gender) AS gender,
  coalesce(n.total_enrolment, o.total_enrolment) AS total_enrolment, CASE WHEN n.gender IS NULL THEN o.ger ELSE n.ger END AS ger, o.gpi_ger FROM old o FULL JOIN new n ON {' AND '.join(f'o.{c.strip()} = n.{c.strip()}' for c in EIF.split(','))})
SELECT m.district_id, m.school_level, m.academic_year, m.gender, m.total_enrolment, CAST(m.ger AS DOUBLE) AS ger,
  CASE WHEN m.gender = 'TOTAL' AND f.gender = 'F' AND b.gender = 'M' THEN CASE WHEN b.ger > 0 THEN {pct('coalesce(f.ger, 0) * 100', 'CAST(b.ger * 100 AS BIGINT)', 4, 1)} END ELSE CAST(m.gpi_ger AS DOUBLE) END AS gpi_ger
FROM m LEFT JOIN m f ON f.district_id = m.district_id AND f.school_level = m.school_level AND f.academic_year = m.academic_year AND f.gender = 'F'
LEFT JOIN m b ON b.district_id = m.district_id AND b.school_level = m.school_level AND b.academic_year = m.academic_year AND b.gender = 'M'""")
def enrolment_indicator_upsert(t):
    """Loaded onto an existing fact: listed columns refreshed, parity written on the TOTAL rows."""
    world = type(t)(t.spark, t.sf_dir, **{k: v for k, v in t.items()})
    existing = t["dw.enrolment_indicator_fact"].filter("school_level is not null and total_enrolment > 2")
    typed = empty(t.spark, schema("dw.enrolment_indicator_fact")).drop("load_time")
    world["dw.enrolment_indicator_fact"] = typed.unionByName(existing, allowMissingColumns=True)
    fact = indicators.enrolment_indicator_fact(world)
    return plain(fact.select("district_id", "school_level", "academic_year", "gender", "total_enrolment", "ger", "gpi_ger"))


NEWEST_YEAR = "(SELECT max(academic_year) FROM {dw_enrolment_fact})"
SAME_GROUP = "{0}.district_id = {1}.district_id AND {0}.school_level = {1}.school_level AND {0}.academic_year = {1}.academic_year"


@query(BASE_COUNTS + f""",
t AS (SELECT * FROM c UNION ALL SELECT district_id, district_name, school_level, academic_year, 'TOTAL', CAST(sum(total_enrolment) AS BIGINT), CAST(sum(new_entrants_p1) AS BIGINT), CAST(sum(learners_with_disability) AS BIGINT) FROM c
  WHERE upper(gender) IN ('M', 'F', 'MALE', 'FEMALE') GROUP BY ALL),
b AS (SELECT t.*, CASE WHEN school_level ILIKE '%PRE%PRIMARY%' THEN p.pop_age_3_5 WHEN school_level ILIKE '%PRIMARY%' AND school_level NOT ILIKE '%PRE%' THEN p.pop_age_6_12 WHEN school_level ILIKE '%SECONDARY%' THEN p.pop_age_13_16 + p.pop_age_17_18 END AS served
  FROM t LEFT JOIN {{dw_population_fact}} p ON p.district_id = t.district_id AND p.year = t.academic_year
  AND p.sex = CASE upper(t.gender) WHEN 'M' THEN 'M' WHEN 'MALE' THEN 'M' WHEN 'F' THEN 'F' WHEN 'FEMALE' THEN 'F' ELSE 'TOTAL' END),
touched AS (SELECT DISTINCT r.district_id, v.school_type AS school_level, f.academic_year FROM {{dw_enrolment_fact}} f JOIN {{dw_schools_dim}} v ON v.id = f.school_id AND v.is_current JOIN reach r ON r.id = v.admin_unit_id
  WHERE f.academic_year = {NEWEST_YEAR} AND v.school_type IS NOT NULL),
n AS (SELECT b.*, CAST({pct('total_enrolment', 'served', 2)} AS DECIMAL(8,2)) AS new_ger, CAST({pct('learners_with_disability', 'total_enrolment', 2)} AS DECIMAL(8,2)) AS new_sne FROM b SEMI JOIN touched ON {SAME_GROUP.format('touched', 'b')}),
o AS (SELECT * FROM {{dw_enrolment_indicator_fact}} WHERE school_level IS NOT NULL),
m AS (SELECT coalesce(n.district_id, o.district_id) AS district_id, coalesce(n.school_level, o.school_level) AS school_level, coalesce(n.academic_year, o.academic_year) AS academic_year, coalesce(n.gender, o.gender) AS gender,
  CASE WHEN n.gender IS NULL THEN o.total_enrolment ELSE n.total_enrolment END AS total_enrolment, CASE WHEN n.gender IS NULL THEN o.learners_with_disability ELSE n.learners_with_disability END AS learners_with_disability,
  CASE WHEN n.gender IS NULL THEN o.repetition_rate ELSE 0 END AS repetition_rate, CASE WHEN n.gender IS NULL THEN o.ger ELSE n.new_ger END AS ger, n.new_sne AS sne_inclusion_rate, o.gpi_ger
  FROM o FULL JOIN n ON {SAME_GROUP.format('o', 'n')} AND o.gender = n.gender),
g AS (SELECT m.district_id, m.school_level, m.academic_year, bool_or(upper(gender) IN ('F', 'FEMALE')) AND bool_or(upper(gender) IN ('M', 'MALE')) AS complete,
  max(CASE WHEN upper(gender) IN ('F', 'FEMALE') THEN coalesce(ger, -1) END) AS f_ger, max(CASE WHEN upper(gender) IN ('M', 'MALE') THEN coalesce(ger, -1) END) AS m_ger FROM m SEMI JOIN touched ON {SAME_GROUP.format('touched', 'm')} GROUP BY 1, 2, 3)
SELECT m.district_id, m.school_level, m.academic_year, m.gender, m.total_enrolment, m.learners_with_disability, CAST(m.repetition_rate AS DOUBLE) AS repetition_rate, CAST(m.ger AS DOUBLE) AS ger, CAST(m.sne_inclusion_rate AS DOUBLE) AS sne_inclusion_rate,
  CASE WHEN m.gender = 'TOTAL' AND g.complete THEN CASE WHEN g.m_ger > 0 THEN {pct('CAST(greatest(g.f_ger, 0) * 100 AS BIGINT)', 'CAST(g.m_ger * 100 AS BIGINT)', 4, 1)} END ELSE CAST(m.gpi_ger AS DOUBLE) END AS gpi_ger
FROM m LEFT JOIN g ON {SAME_GROUP.format('g', 'm')}""")
def enrolment_indicator_incremental(t):
    """The newest year's enrolments arrive: their groups are refreshed on the existing fact, all other rows stay."""
    world = type(t)(t.spark, t.sf_dir, **{k: v for k, v in t.items()})
    typed = empty(t.spark, schema("dw.enrolment_indicator_fact")).drop("load_time")
    fact = typed.unionByName(t["dw.enrolment_indicator_fact"].filter("school_level is not null"), allowMissingColumns=True)
    world["dw.enrolment_indicator_fact"] = fact
    newest = t["dw.enrolment_fact"].agg(F.max("academic_year").alias("academic_year"))
    batch = t["dw.enrolment_fact"].join(newest, "academic_year", "left_semi")
    after = indicators.refreshed_groups(world, batch)
    kept = fact.join(indicators.changed_groups(world, batch), indicators.ENROLMENT_KEY[:3], "left_anti")
    return plain(kept.unionByName(after.select(fact.columns)).select(
        "district_id", "school_level", "academic_year", "gender", "total_enrolment", "learners_with_disability", "repetition_rate", "ger", "sne_inclusion_rate", "gpi_ger"))


GENDERS = {"male": "('M', 'MALE')", "female": "('F', 'FEMALE')"}


@query(CLIMB_SQL + f""",
e AS (SELECT f.school_source_id, f.academic_year, count(*) AS n, {', '.join(f"count(*) FILTER (WHERE upper(l.gender) IN {v}) AS {k}" for k, v in GENDERS.items())} FROM {{dw_enrolment_fact}} f JOIN {{dw_learner_dim}} l ON l.id = f.learner_id AND l.is_current WHERE f.academic_year >= 2022 GROUP BY 1, 2),
h AS (SELECT f.school_source_id, f.academic_year, f.term, count(*) AS n, {', '.join(f"count(*) FILTER (WHERE upper(x.gender) IN {v}) AS {k}" for k, v in GENDERS.items())}, count(*) FILTER (WHERE x.teacher_type = 'QUALIFIED') AS q,
  count(*) FILTER (WHERE x.teacher_type IN ('QUALIFIED', 'TRAINED')) AS t FROM {{dw_hr_fact}} f JOIN {{dw_teacher_dim}} x ON x.id = f.teacher_id AND x.is_current WHERE f.academic_year >= 2022 GROUP BY 1, 2, 3)
SELECT h.school_source_id, v.name AS school_name, v.school_type, coalesce((SELECT min(district_id) FROM reach WHERE reach.id = v.admin_unit_id), v.admin_unit_id) AS district_id, h.academic_year, h.term, coalesce(e.n, 0) AS total_learners,
 coalesce(e.male, 0) AS male_learners, coalesce(e.female, 0) AS female_learners, h.n AS total_teachers, h.male AS male_teachers, h.female AS female_teachers, h.q AS qualified_teachers, h.t AS trained_teachers, {pct('coalesce(e.n, 0)', 'h.n', 2, 1)} AS ptr,
 {pct('h.q', 'h.n', 2)} AS qualified_teacher_ratio, {pct('h.t', 'h.n', 2)} AS trained_teacher_ratio, {pct('h.female', 'h.n', 2)} AS pct_female_teachers, CASE WHEN h.male > 0 AND h.female > 0 THEN {pct('coalesce(e.female, 0) * h.male', '(h.female * coalesce(e.male, 0))', 4, 1)} END AS gpi_ptr
FROM h LEFT JOIN e ON e.school_source_id = h.school_source_id AND e.academic_year = h.academic_year LEFT JOIN {{dw_schools_dim}} v ON v.source_id = h.school_source_id AND v.is_current""")
def school_indicators(t):
    return plain(indicators.school_indicators(t))


@query(f"""
WITH gen AS ({GENERAL}), s1 AS (SELECT source_id, min_by(id, effective_date) AS id FROM {{dw_schools_dim}} GROUP BY 1), r AS (SELECT * FROM {{stg_school_indicator_raw}})
SELECT s1.id AS school_id, coalesce(d.id, feb.id) AS date_id, r.school_source_id, r.academic_year, r.term, r.total_learners, r.total_teachers, CAST(r.ptr AS DOUBLE) AS ptr, CAST(r.gpi_ptr AS DOUBLE) AS gpi_ptr FROM r JOIN s1 ON s1.source_id = r.school_source_id
LEFT JOIN gen ON gen.academic_year = r.academic_year AND gen.term = r.term LEFT JOIN {{dw_date_dim}} d ON d.system_date = gen.start_date {FEBRUARY}""")
def school_indicator_rows(t):
    return plain(indicators.school_indicator_rows(t).select(
        "school_id", "date_id", "school_source_id", "academic_year", "term", "total_learners", "total_teachers", "ptr", "gpi_ptr"))


# ----------------------------------------------------------------------------- lookup dimensions

def _seed(name: str, build, sql: str, table: str) -> None:
    def dataset(t):
        world = type(t)(t.spark, t.sf_dir, **{k: v for k, v in t.items()})
        world.setdefault(table, empty(t.spark, schema(table)))
        return build(world).drop("id", "category_id")
    register(name, dataset, sql)


_seed("seed_teacher_types", lookups.teacher_types, "SELECT name AS teacher_type, max(id) AS source_id FROM {src_setting_teacher_types} GROUP BY name", "dw.teacher_type_dim")
_seed("seed_qualifications", lookups.qualifications,
      "SELECT id AS source_id, name AS qualification_name, * EXCLUDE (id, name, is_archived) FROM {src_setting_teacher_professional_qualifications} WHERE is_archived = FALSE QUALIFY row_number() OVER (PARTITION BY name ORDER BY id DESC) = 1",
      "dw.qualification_dim")
_seed("seed_designations", lookups.designations,
      "SELECT d.id AS source_id, d.name AS designation, st.name AS school_type FROM {src_setting_teaching_staff_designations} d LEFT JOIN {src_setting_school_types} st ON st.id = d.school_type_id QUALIFY row_number() OVER (PARTITION BY d.name ORDER BY d.id DESC) = 1",
      "dw.designation_dim")
_seed("seed_staff_categories", lookups.staff_categories, "SELECT name AS category_name, min(id) AS source_id FROM {src_setting_non_teaching_staff_categories} GROUP BY name", "dw.staff_category_dim")


@query("""WITH c AS (SELECT name, min(id) AS id FROM {src_setting_non_teaching_staff_categories} GROUP BY name)
SELECT r.id AS source_id, r.name AS role_name, c.name AS category_name FROM {src_setting_non_teaching_staff_roles} r LEFT JOIN c ON c.id = r.non_teaching_staff_category_id QUALIFY row_number() OVER (PARTITION BY r.name ORDER BY r.id) = 1""")
def seed_staff_roles(t):
    world = type(t)(t.spark, t.sf_dir, **{k: v for k, v in t.items()})
    for table in ("dw.staff_category_dim", "dw.staff_role_dim"):
        world[table] = empty(t.spark, schema(table))
    world["dw.staff_category_dim"] = lookups.staff_categories(world)
    return lookups.staff_roles(world).drop("id", "category_id")


@query("""SELECT (SELECT count(*) FROM {dw_enrolment_fact}) AS fact_total, (SELECT count(*) FROM {stg_enrolments_flat} WHERE is_active) AS staged_total,
(SELECT count(*) FROM {stg_enrolments_flat} e WHERE is_active AND NOT EXISTS (SELECT 1 FROM {dw_enrolment_fact} f WHERE f.learner_source_id = e.learner_source_id AND f.school_source_id = e.school_source_id AND f.academic_year = e.academic_year AND f.term = e.term AND f.grade_id > 3)) AS unresolved""")
def enrolment_reconcile(t):
    names = {k: k for k in enrolment.NATURAL_KEY}
    fact = t["dw.enrolment_fact"]
    lost = quality.reconcile(t["stg.enrolments_flat"].filter("is_active"), fact.filter("grade_id > 3"), names).select("staged_total", "unresolved")
    return fact.agg(F.count(F.lit(1)).alias("fact_total")).withColumn("staged_total", lost.select("staged_total").scalar()).withColumn(
        "unresolved", lost.select("unresolved").scalar())


# A load that lost some rows, holds some that were taken back since, and has other values in some; the row counts alone cannot tell.
CHANGED_LOAD = """WITH staged AS (SELECT * FROM {dw_enrolment_fact} WHERE learner_source_id % 83 <> 0),
loaded AS (SELECT * REPLACE (CASE WHEN learner_source_id % 97 = 0 THEN NULL ELSE grade_id END AS grade_id) FROM {dw_enrolment_fact} WHERE learner_source_id % 89 <> 0)
"""


@query(CHANGED_LOAD + """, s AS (SELECT learner_source_id, school_source_id, academic_year, term, grade_id, enrolment_type_id, count(*) FROM staged GROUP BY ALL),
l AS (SELECT learner_source_id, school_source_id, academic_year, term, grade_id, enrolment_type_id, count(*) FROM loaded GROUP BY ALL),
k AS (SELECT DISTINCT learner_source_id, school_source_id, academic_year, term FROM ((FROM s EXCEPT FROM l) UNION ALL (FROM l EXCEPT FROM s)) AS d)
SELECT k.*, CASE WHEN learner_source_id % 89 = 0 THEN 'missing' WHEN learner_source_id % 83 = 0 THEN 'extra' ELSE 'changed' END AS difference FROM k""")
def enrolment_differences(t):
    fact, learner = t["dw.enrolment_fact"], F.col("learner_source_id")
    loaded = fact.filter(learner % 89 != 0).withColumn("grade_id", F.when(learner % 97 != 0, F.col("grade_id")))
    same = ["grade_id", "enrolment_type_id"]
    return quality.differences(fact.filter(learner % 83 != 0), loaded, {k: k for k in enrolment.NATURAL_KEY}, {c: c for c in same}, "academic_year")
