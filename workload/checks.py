"""The quality suites on the derived tables, their log, and their summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.operators import quality
from censusmart.plans.suites import SUITES
from workload.registry import TODAY, query, register

COLUMNS = ["run_date", "mart", "check_name", "status", "row_count", "severity"]


def n(source: str, where: str = "TRUE") -> str:
    return f"(SELECT count(*) FROM {source} AS q WHERE {where})"


def lost(fact: str, column: str, dim: str) -> str:
    return f"(SELECT count(*) FROM {{{fact}}} f WHERE NOT EXISTS (SELECT 1 FROM {{{dim}}} d WHERE d.id = f.{column}))"


def unused(dim: str, key: str, fact: str, column: str, where: str = "is_current") -> str:
    return f"(SELECT count(*) FROM {{{dim}}} WHERE {where} AND {key} NOT IN (SELECT {column} FROM {{{fact}}} WHERE {column} IS NOT NULL))"


def dup(source: str, keys: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {source} AS q GROUP BY {keys} HAVING count(*) > 1) AS g)"


def diff(fact: str, flat: str, where: str = "TRUE") -> str:
    return f"abs((SELECT count(*) FROM {{{fact}}}) - (SELECT count(*) FROM {{{flat}}} WHERE {where}))"


FAIL, WARN, WARNING = ("FAIL", "CRITICAL"), ("WARN", "WARNING"), ("WARNING", "WARNING")


def none(value: str, bad=FAIL, over: int = 0) -> tuple[str, str, str]:
    return value, f"CASE WHEN n > {over} THEN '{bad[0]}' ELSE 'PASS' END", bad[1]


def some(value: str, floor: int | None = None, bad=FAIL, least: int = 1) -> tuple[str, str, str]:
    soft = f" WHEN n < {floor} THEN 'WARN'" if floor else ""
    return value, f"CASE WHEN n < {least} THEN '{bad[0]}'{soft} ELSE 'PASS' END", bad[1]


def note(value: str, status: str) -> tuple[str, str, str]:
    return value, f"'{status}'", "INFO"


def close(fact: str, flat: str, where: str = "TRUE") -> tuple[str, str, str]:
    base = f"(SELECT count(*) FROM {{{flat}}} WHERE {where})"
    return diff(fact, flat, where), f"CASE WHEN n * 100 < {base} THEN 'PASS' ELSE 'WARNING' END", "WARNING"


def live(dim: str) -> str:
    return f"(SELECT * FROM {{{dim}}} WHERE is_current)"


def gap_count(dim: str) -> str:
    return (f"(SELECT count(*) FROM (SELECT expiration_date, lead(effective_date) OVER (PARTITION BY source_id ORDER BY effective_date) AS nxt FROM {{{dim}}}) AS g "
            "WHERE expiration_date + 1 <> nxt)")


V, SF = "dw_schools_dim", "dw_school_fact"
DAY = "date_id IN (SELECT id FROM {dw_date_dim} WHERE system_date = DATE '2025-01-15')"
INF = "dw_infrastructure_fact"
STAGED_KEY = "school_id IS NOT NULL AND building_id IS NOT NULL AND academic_year IS NOT NULL"
TR = "{dw_teacher_transfer_fact}"
EI, SI, POP = "{dw_enrolment_indicator_fact}", "{dw_school_indicator_fact}", "{dw_population_fact}"


def _people(dim: str, fact: str, flat: str, person: str) -> dict[str, tuple[str, str, str]]:
    return {
        "person": none(lost(fact, person, dim)), "DQ-2: Fact orphaned school_id": none(lost(fact, "school_id", V)),
        "DQ-3: Fact orphaned date_id": none(lost(fact, "date_id", "dw_date_dim")), "current": none(dup(live(dim), "source_id")),
        "unused": none(unused(dim, "id", fact, person), WARNING), "variance": close(fact, flat),
    }


def _renamed(checks: dict, **names: str) -> dict:
    return {names.get(k, k): v for k, v in checks.items()}


EXPECTED: dict[str, tuple[str, dict[str, tuple[str, str, str]]]] = {
    "schools_nightly": ("SCHOOLS_NIGHTLY", {
        "schools_raw_not_empty": some(n("{stg_schools_raw}")), "schools_flat_not_empty": some(n("{stg_schools_flat}")),
        "null_emis_numbers_in_dim": none(n(live(V), "emis_number IS NULL"), WARN),
        "no_orphan_admin_unit_id": none(n(live(V), "admin_unit_id NOT IN (SELECT id FROM {dw_admin_units_dim})")),
        "fact_rows_loaded_today": some(n("{dw_school_fact}", DAY)), "no_duplicate_fact_rows": none(dup("{dw_school_fact}", "school_id, date_id")),
        "all_staged_schools_have_current_dim_row": none(n("{stg_schools_flat}", f"source_id NOT IN (SELECT source_id FROM {live(V)} AS l)")),
    }),
    "schools": ("SCHOOLS", {
        "schools_dim_row_count": some(n(live(V)), 80000), "schools_dim_no_emis_number": none(n(live(V), "coalesce(emis_number, '') = ''"), WARN),
        "schools_dim_no_admin_unit": none(n(live(V), "admin_unit_id IS NULL"), WARN), "school_fact_row_count": some(n("{dw_school_fact}")),
        "school_fact_unresolved_school": none(lost(SF, "school_id", V)), "schools_dim_not_in_fact": none(unused(V, "id", SF, "school_id"), WARN, 1000),
        "schools_dim_duplicate_emis": none(dup(live(V), "emis_number"), WARN),
    }),
    "enrolment": ("ENROLMENT", {
        "DQ-1: Fact orphaned learner_id": none(lost("dw_enrolment_fact", "learner_id", "dw_learner_dim")),
        "DQ-2: Fact orphaned school_id": none(lost("dw_enrolment_fact", "school_id", V)),
        "DQ-3: Fact orphaned date_id": none(lost("dw_enrolment_fact", "date_id", "dw_date_dim")),
        "DQ-4: learner_dim duplicate current rows": none(dup(live("dw_learner_dim"), "source_id")),
        "DQ-5: NULL grade_id in enrolment_fact": none(n("{dw_enrolment_fact}", "grade_id IS NULL"), WARNING),
        "DQ-6: NULL enrolment_type_id in enrolment_fact": none(n("{dw_enrolment_fact}", "enrolment_type_id IS NULL"), WARNING),
        "DQ-7: Learners without NIN": note(n(live("dw_learner_dim"), "nin IS NULL"), "INFO"),
        "DQ-8: Enrolment fact vs staging count": close("dw_enrolment_fact", "stg_enrolments_flat", "is_active"),
        "DQ-9: learner_dim SCD2 version gaps": none(gap_count("dw_learner_dim"), WARNING),
    }),
    "teachers": ("TEACHERS", _renamed(
        _people("dw_teacher_dim", "dw_hr_fact", "stg_teachers_flat", "teacher_id"), person="DQ-1: Fact orphaned teacher_id",
        current="DQ-4: teacher_dim duplicate current rows", unused="DQ-5: Teachers in dim with no hr_fact rows",
        variance="DQ-8: hr_fact vs teachers_flat count") | {
        "DQ-6: Teachers without IPPS number": note(n(live("dw_teacher_dim"), "ipps_number IS NULL"), "INFO"),
        "DQ-7: Teachers with NULL discipline": none(n(live("dw_teacher_dim"), "discipline IS NULL"), WARNING)}),
    "non_teaching_staff": ("NON_TEACHING_STAFF", _renamed(
        _people("dw_non_teaching_staff_dim", "dw_non_teaching_staff_fact", "stg_non_teaching_staff_flat", "staff_id"),
        person="DQ-1: Fact orphaned staff_id", current="DQ-4: dim duplicate current rows", unused="DQ-5: Staff in dim with no fact rows",
        variance="DQ-8: Fact vs staging count") | {
        "DQ-6: Staff with no category": none(n(live("dw_non_teaching_staff_dim"), "category IS NULL"), WARNING),
        "DQ-7: Staff with no role": none(n(live("dw_non_teaching_staff_dim"), "role IS NULL"), WARNING)}),
    "infrastructure": ("INFRASTRUCTURE", {
        "infra_type_dim_row_count": some(n("{dw_infrastructure_type_dim}")), "infra_fact_row_count": some(n(f"{{{INF}}}")),
        "infra_unresolved_school": none(lost(INF, "school_id", V)), "infra_unresolved_type": none(lost(INF, "infra_type_id", "dw_infrastructure_type_dim")),
        "infra_complete_count": note(n(f"{{{INF}}}", "completion_status = 'COMPLETE'"), "PASS"),
        "infra_poor_condition_count": none(n(f"{{{INF}}}", "structure_condition = 'POOR' OR structure_condition = 'DILAPIDATED'"), WARN),
        "infra_null_total_number": none(n(f"{{{INF}}}", "total_number IS NULL"), WARN),
        "infra_staging_not_loaded": none(
            f"(SELECT count(*) FROM {{stg_infrastructure_raw}} r WHERE {STAGED_KEY} AND NOT EXISTS (SELECT 1 FROM {{{INF}}} f WHERE f.school_source_id = r.school_id "
            "AND f.building_source_id = r.building_id AND f.academic_year = r.academic_year AND f.term = r.term))", WARN),
        "infra_schools_no_lab": note(n(live(V), f"id NOT IN (SELECT f.school_id FROM {{{INF}}} f JOIN {{dw_infrastructure_type_dim}} k ON k.id = f.infra_type_id AND k.is_lab_yn)"), "PASS"),
    }),
    "teaching_subjects": ("TEACHING_SUBJECTS", {
        "subjects_dim_row_count": some(n("{dw_subject_dim}")),
        "subjects_both_levels_present": some("(SELECT count(DISTINCT subject_level) FROM {dw_subject_dim})", None, WARN, 2),
        "teaching_subject_fact_row_count": some(n("{dw_teaching_subject_fact}")),
        "teaching_subject_unresolved_teacher": none(lost("dw_teaching_subject_fact", "teacher_id", "dw_teacher_dim")),
        "teaching_subject_unresolved_school": none(lost("dw_teaching_subject_fact", "school_id", V)),
        "subjects_with_no_teachers": none(unused("dw_subject_dim", "id", "dw_teaching_subject_fact", "subject_id", "is_active_yn"), WARN),
        "teaching_subject_no_school": none(n("{stg_teaching_subject_flat}", "school_id IS NULL"), WARN),
        "teaching_subject_science_count": note("(SELECT count(*) FROM {dw_teaching_subject_fact} f JOIN {dw_subject_dim} s ON s.id = f.subject_id WHERE s.is_science_subject)", "PASS"),
    }),
    "teacher_transfers": ("TEACHER_TRANSFERS", {
        "transfers_staging_row_count": some(n("{stg_teacher_transfers_raw}")),
        "transfers_approved_count": some(n("{stg_teacher_transfers_raw}", "transfer_status = 'APPROVED'"), None, WARN),
        "transfer_fact_row_count": some(n(TR)), "transfers_unresolved_teacher": none(lost("dw_teacher_transfer_fact", "teacher_id", "dw_teacher_dim")),
        "transfers_unresolved_out_school": none(n(TR, "out_school_id IS NULL"), WARN),
        "transfers_no_district": none(n(TR, "coalesce(out_district_id, in_district_id) IS NULL"), WARN),
        "transfers_inter_district_count": note(n(TR, "is_inter_district"), "PASS"),
        "transfers_implausible_days": none(n(TR, "days_at_outgoing_station NOT BETWEEN 0 AND 7300"), WARN),
        "transfers_date_logic_error": none(n(TR, "reporting_date < posting_date"), WARN),
        "transfers_approved_not_loaded": none(n("{stg_teacher_transfers_raw}", "transfer_status = 'APPROVED' AND person_id IS NOT NULL AND transfer_id NOT IN "
                                                f"(SELECT transfer_source_id FROM {TR})"), WARN),
    }),
    "indicators": ("INDICATORS", {
        "indicators_population_current_year": some(n(POP, "sex = 'TOTAL'"), 100),
        "indicators_population_age_proportions": none(n(POP, "sex = 'TOTAL' AND pop_age_6_12 * 5 > total_population"), WARN),
        "indicators_enrolment_fact_row_count": some(n(EI)), "indicators_ger_range": none(n(EI, "ger NOT BETWEEN 0 AND 200"), WARN),
        "indicators_repetition_rate_range": none(n(EI, "repetition_rate > 30"), WARN),
        "indicators_missing_ger_denominator": none(n(EI, "ger IS NULL AND total_enrolment > 0"), WARN),
        "indicators_school_fact_row_count": some(n(SI)), "indicators_ptr_extreme": none(n(SI, "ptr > 100"), WARN),
        "indicators_schools_no_teachers": none(n(SI, "total_learners > 0 AND total_teachers = 0"), WARN, 1000),
        "indicators_female_teacher_pct_range": none(n(SI, "pct_female_teachers NOT BETWEEN 0 AND 100")),
    }),
}

# The district of every unit, level by level from the top, as an independent form of the climb.
REACH = """(WITH RECURSIVE up(id, source_id, top_id, left_) AS (
  SELECT id, source_id, id, CASE admin_unit_type WHEN 'District' THEN 0 WHEN 'County' THEN 1 WHEN 'Municipality' THEN 1 WHEN 'City' THEN 1 WHEN 'Sub County' THEN 2
    WHEN 'Town Council' THEN 2 WHEN 'Parish' THEN 3 WHEN 'Ward' THEN 3 END FROM {dw_admin_units_dim} WHERE current_status
  UNION ALL SELECT up.id, p.source_id, p.id, left_ - 1 FROM up JOIN {dw_admin_units_dim} c ON c.id = up.top_id JOIN {dw_admin_units_dim} p ON p.source_id = c.child_id AND p.current_status WHERE left_ > 0)
  SELECT up.id, top_id FROM up JOIN {dw_admin_units_dim} d ON d.id = up.top_id AND d.admin_unit_type = 'District' WHERE left_ = 0)"""


def expired(fact: str, column: str, dim: str) -> str:
    return f"(SELECT count(*) FROM {{{fact}}} f LEFT JOIN {live(dim)} d ON d.id = f.{column} WHERE d.id IS NULL)"


EXPECTED["supplementary"] = ("SUPPLEMENTARY", {
    "units_with_several_districts": none(f"(SELECT count(*) FROM (SELECT id FROM {REACH} AS r GROUP BY id HAVING count(DISTINCT top_id) > 1) AS g)", WARN),
    "units_above_themselves": none("""(SELECT count(DISTINCT a.id) FROM {dw_admin_units_dim} a JOIN {dw_admin_units_dim} b ON b.source_id = a.child_id AND b.current_status
      LEFT JOIN {dw_admin_units_dim} c ON c.source_id = b.child_id AND c.current_status LEFT JOIN {dw_admin_units_dim} d ON d.source_id = c.child_id AND d.current_status
      WHERE a.current_status AND (a.id = b.id OR a.id = c.id OR a.id = d.id))""", WARN),
    "schools_without_district": none(n(live(V), f"admin_unit_id NOT IN (SELECT id FROM {REACH} AS r)"), WARN),
    "enrolments_of_expired_learners": none(expired("dw_enrolment_fact", "learner_id", "dw_learner_dim"), WARN),
    "hr_rows_of_expired_teachers": none(expired("dw_hr_fact", "teacher_id", "dw_teacher_dim"), WARN),
    "implausible_academic_year": none(n("{stg_enrolments_flat}", "academic_year NOT BETWEEN 2000 AND 2100"), WARN),
    "population_district_unmatched": none(n("{stg_population_raw}", "district_source_id IS NULL AND sex = 'TOTAL'"), WARN),
})


def suite_sql(name: str) -> str:
    mart, checks = EXPECTED[name]
    rows = [
        f"SELECT DATE '{TODAY}' AS run_date, '{mart}' AS mart, '{check}' AS check_name, {status} AS status, CAST(n AS BIGINT) AS row_count, '{severity}' AS severity FROM (SELECT {value} AS n) AS c"
        for check, (value, status, severity) in checks.items()
    ]
    return " UNION ALL ".join(rows)


for suite_name in SUITES:
    register(f"dq_{suite_name}", lambda w, _suite=SUITES[suite_name]: _suite(w, TODAY).run(TODAY).select(COLUMNS), suite_sql(suite_name))


def _log(w) -> DataFrame:
    return reduce(DataFrame.unionByName, [SUITES[s](w, TODAY).run(TODAY) for s in ("teacher_transfers", "indicators")])


LOG_SQL = f"{suite_sql('teacher_transfers')} UNION ALL {suite_sql('indicators')}"


@query(f"""SELECT run_date, mart, count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status IN ('WARN', 'WARNING')) AS warned, count(*) FILTER (WHERE status = 'FAIL') AS failed,
count(*) FILTER (WHERE status = 'INFO') AS info FROM ({LOG_SQL}) AS l GROUP BY 1, 2""")
def dq_summary(w):
    return quality.summarise(_log(w))


@query(f"SELECT mart, check_name, status AS result FROM ({LOG_SQL}) AS l")
def dq_backfill_result(w):
    """Log rows of the older layout take their result from the status."""
    old = _log(w).withColumn("result", F.when(F.col("status") == "PASS", F.col("result")))
    return quality.with_result(old).select("mart", "check_name", "result")
