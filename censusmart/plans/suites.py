"""The quality suites of the marts: what is counted, and which count is a problem."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from censusmart.functions.numbers import is_true
from censusmart.operators.hierarchy import above_themselves, reach, several_districts
from censusmart.operators.quality import (
    Rule, Suite, VarianceRule, distinct_values, gaps, informative, non_empty, none_allowed, orphans, repeated,
    rows, uncovered, variance,
)
from censusmart.plans.common import Tables

# Thresholds of the rules below.
EXPECTED_SCHOOLS = 80_000
EXPECTED_DISTRICTS = 100
TOLERATED_ROWS = 1_000
LONGEST_POSTING_DAYS = 7_300
YEARS = (2000, 2100)


def _warning(detail: str) -> Rule:
    return none_allowed("WARNING", detail, "WARNING")


def _warn(detail: str) -> Rule:
    return none_allowed("WARN", detail, "WARNING")


def _fail(detail: str) -> Rule:
    return none_allowed("FAIL", detail)


def nightly_schools(t: Tables, as_of: date) -> Suite:
    """Checks at the end of the nightly schools run."""
    every = F.lit(True)
    dim, fact = t["dw.schools_dim"].filter("is_current"), t["dw.school_fact"]
    today = t["dw.date_dim"].filter(F.col("system_date") == F.lit(as_of)).select(F.col("id").alias("date_id"))
    s = Suite("SCHOOLS_NIGHTLY")
    s.scan(t["stg.schools_raw"], {"schools_raw_not_empty": (every, non_empty("rows in raw staging"))})
    s.scan(t["stg.schools_flat"], {"schools_flat_not_empty": (every, non_empty("rows in flat staging"))})
    s.scan(dim, {"null_emis_numbers_in_dim": (F.col("emis_number").isNull(), _warn("current rows without EMIS number"))})
    s.add("no_orphan_admin_unit_id", _fail("current rows with a missing unit"), orphans,
          dim.filter(F.col("admin_unit_id").isNotNull()), "admin_unit_id", t["dw.admin_units_dim"])
    s.scan(fact.join(today, "date_id", "left_semi"),
           {"fact_rows_loaded_today": (every, non_empty("snapshot rows of the day"))})
    s.add("no_duplicate_fact_rows", _fail("repeated school and day"), repeated, fact, ["school_id", "date_id"])
    s.add("all_staged_schools_have_current_dim_row", _fail("staged schools without a current row"), uncovered,
          t["stg.schools_flat"], ["source_id"], dim, ["source_id"])
    return s


def schools(t: Tables, as_of: date) -> Suite:
    dim, fact = t["dw.schools_dim"].filter("is_current"), t["dw.school_fact"]
    emis = F.col("emis_number")
    s = Suite("SCHOOLS")
    s.scan(dim, {
        "schools_dim_row_count": (F.lit(True), non_empty("current rows", soft_floor=EXPECTED_SCHOOLS)),
        "schools_dim_no_emis_number": (emis.isNull() | (emis == ""), _warn("schools without EMIS number")),
        "schools_dim_no_admin_unit": (F.col("admin_unit_id").isNull(), _warn("schools without unit")),
    })
    s.scan(fact, {"school_fact_row_count": (F.lit(True), non_empty("fact rows"))})
    s.add("school_fact_unresolved_school", _fail("fact rows with unknown school"), orphans, fact, "school_id",
          t["dw.schools_dim"])
    s.add("schools_dim_not_in_fact", Rule(bad="WARN", at_most=TOLERATED_ROWS, severity="WARNING",
                                          detail="current schools without fact row"),
          uncovered, dim, ["id"], fact, ["school_id"])
    s.add("schools_dim_duplicate_emis", _warn("repeated EMIS numbers"), repeated, dim, ["emis_number"])
    return s


def enrolment(t: Tables, as_of: date) -> Suite:
    dim, fact = t["dw.learner_dim"], t["dw.enrolment_fact"]
    live = dim.filter("is_current")
    s = Suite("ENROLMENT")
    s.refer(fact, {
        "DQ-1: Fact orphaned learner_id": ("learner_id", dim, _fail("fact rows with unknown learner")),
        "DQ-2: Fact orphaned school_id": ("school_id", t["dw.schools_dim"], _fail("fact rows with unknown school")),
        "DQ-3: Fact orphaned date_id": ("date_id", t["dw.date_dim"], _fail("fact rows with unknown date")),
    })
    s.add("DQ-4: learner_dim duplicate current rows", _fail("learners with several current rows"), repeated, live,
          ["source_id"])
    s.scan(fact, {
        "DQ-5: NULL grade_id in enrolment_fact": (F.col("grade_id").isNull(), _warning("grade unresolved")),
        "DQ-6: NULL enrolment_type_id in enrolment_fact":
            (F.col("enrolment_type_id").isNull(), _warning("enrolment type unresolved")),
    })
    s.scan(live, {"DQ-7: Learners without NIN": (F.col("nin").isNull(), informative("INFO", "learners without NIN"))})
    s.add("DQ-8: Enrolment fact vs staging count",
          VarianceRule(bad="WARNING", severity="WARNING", detail="difference to the active staging rows"), variance,
          fact, t["stg.enrolments_flat"].filter(is_true(F.col("is_active"))))
    s.add("DQ-9: learner_dim SCD2 version gaps", _warning("gaps between versions"), gaps, dim, ["source_id"])
    return s


def _people_mart(mart: str, dim, fact, flat, person: str, t: Tables, names: dict[str, str]) -> Suite:
    """The checks that the two staff marts share."""
    s = Suite(mart)
    s.refer(fact, {
        names["person"]: (person, dim, _fail("fact rows with unknown person")),
        "DQ-2: Fact orphaned school_id": ("school_id", t["dw.schools_dim"], _fail("fact rows with unknown school")),
        "DQ-3: Fact orphaned date_id": ("date_id", t["dw.date_dim"], _fail("fact rows with unknown date")),
    })
    live = dim.filter("is_current")
    s.add(names["current"], _fail("persons with several current rows"), repeated, live, ["source_id"])
    s.add(names["unused"], _warning("current persons without fact row"), uncovered, live, ["id"], fact, [person])
    s.add(names["variance"], VarianceRule(bad="WARNING", severity="WARNING", detail="difference to the staging rows"),
          variance, fact, flat)
    return s


def teachers(t: Tables, as_of: date) -> Suite:
    names = {
        "person": "DQ-1: Fact orphaned teacher_id", "current": "DQ-4: teacher_dim duplicate current rows",
        "unused": "DQ-5: Teachers in dim with no hr_fact rows", "variance": "DQ-8: hr_fact vs teachers_flat count",
    }
    s = _people_mart("TEACHERS", t["dw.teacher_dim"], t["dw.hr_fact"], t["stg.teachers_flat"], "teacher_id", t, names)
    return s.scan(t["dw.teacher_dim"].filter("is_current"), {
        "DQ-6: Teachers without IPPS number":
            (F.col("ipps_number").isNull(), informative("INFO", "teachers without payroll number")),
        "DQ-7: Teachers with NULL discipline": (F.col("discipline").isNull(), _warning("teachers without discipline")),
    })


def staff(t: Tables, as_of: date) -> Suite:
    names = {
        "person": "DQ-1: Fact orphaned staff_id", "current": "DQ-4: dim duplicate current rows",
        "unused": "DQ-5: Staff in dim with no fact rows", "variance": "DQ-8: Fact vs staging count",
    }
    s = _people_mart("NON_TEACHING_STAFF", t["dw.non_teaching_staff_dim"], t["dw.non_teaching_staff_fact"],
                     t["stg.non_teaching_staff_flat"], "staff_id", t, names)
    return s.scan(t["dw.non_teaching_staff_dim"].filter("is_current"), {
        "DQ-6: Staff with no category": (F.col("category").isNull(), _warning("staff without category")),
        "DQ-7: Staff with no role": (F.col("role").isNull(), _warning("staff without role")),
    })


def infrastructure(t: Tables, as_of: date) -> Suite:
    fact, types = t["dw.infrastructure_fact"], t["dw.infrastructure_type_dim"]
    s = Suite("INFRASTRUCTURE")
    s.scan(types, {"infra_type_dim_row_count": (F.lit(True), non_empty("building types"))})
    s.scan(fact, {
        "infra_fact_row_count": (F.lit(True), non_empty("fact rows")),
        "infra_complete_count": (F.col("completion_status") == "COMPLETE", informative("PASS", "complete structures")),
        "infra_poor_condition_count":
            (F.col("structure_condition").isin("POOR", "DILAPIDATED"), _warn("structures in bad condition")),
        "infra_null_total_number": (F.col("total_number").isNull(), _warn("fact rows without number")),
    })
    s.refer(fact, {
        "infra_unresolved_school": ("school_id", t["dw.schools_dim"], _fail("fact rows with unknown school")),
        "infra_unresolved_type": ("infra_type_id", types, _fail("fact rows with unknown type")),
    })
    staged = t["stg.infrastructure_raw"].filter(
        F.col("school_id").isNotNull() & F.col("building_id").isNotNull() & F.col("academic_year").isNotNull()
    )
    s.add("infra_staging_not_loaded", _warn("staged rows not loaded"), uncovered, staged,
          ["school_id", "building_id", "academic_year", "term"], fact,
          ["school_source_id", "building_source_id", "academic_year", "term"])
    labs = fact.join(types.filter(is_true(F.col("is_lab_yn"))).select(F.col("id").alias("infra_type_id")),
                     "infra_type_id", "left_semi")
    s.add("infra_schools_no_lab", informative("PASS", "current schools without laboratory"), uncovered,
          t["dw.schools_dim"].filter("is_current"), ["id"], labs, ["school_id"])
    return s


def subjects(t: Tables, as_of: date) -> Suite:
    dim, fact = t["dw.subject_dim"], t["dw.teaching_subject_fact"]
    s = Suite("TEACHING_SUBJECTS")
    s.scan(dim, {"subjects_dim_row_count": (F.lit(True), non_empty("subjects"))})
    s.add("subjects_both_levels_present",
          Rule(bad="WARN", at_least=2, severity="WARNING", detail="subject levels"), distinct_values, dim,
          "subject_level")
    s.scan(fact, {"teaching_subject_fact_row_count": (F.lit(True), non_empty("fact rows"))})
    s.refer(fact, {
        "teaching_subject_unresolved_teacher": ("teacher_id", t["dw.teacher_dim"], _fail("fact rows with unknown teacher")),
        "teaching_subject_unresolved_school": ("school_id", t["dw.schools_dim"], _fail("fact rows with unknown school")),
    })
    s.add("subjects_with_no_teachers", _warn("active subjects without teacher"), uncovered,
          dim.filter(is_true(F.col("is_active_yn"))), ["id"], fact, ["subject_id"])
    s.scan(t["stg.teaching_subject_flat"],
           {"teaching_subject_no_school": (F.col("school_id").isNull(), _warn("staged rows without school"))})
    science = dim.filter(is_true(F.col("is_science_subject"))).select(F.col("id").alias("subject_id"))
    s.scan(fact.join(science, "subject_id"),
           {"teaching_subject_science_count": (F.lit(True), informative("PASS", "science assignments"))})
    return s


def transfers(t: Tables, as_of: date) -> Suite:
    staged, fact = t["stg.teacher_transfers_raw"], t["dw.teacher_transfer_fact"]
    approved = F.col("transfer_status") == "APPROVED"
    days = F.col("days_at_outgoing_station")
    s = Suite("TEACHER_TRANSFERS")
    s.scan(staged, {
        "transfers_staging_row_count": (F.lit(True), non_empty("staged transfers")),
        "transfers_approved_count": (approved, Rule(bad="WARN", at_least=1, severity="WARNING",
                                                    detail="approved transfers")),
    })
    s.scan(fact, {
        "transfer_fact_row_count": (F.lit(True), non_empty("fact rows")),
        "transfers_unresolved_out_school": (F.col("out_school_id").isNull(), _warn("outgoing school unresolved")),
        "transfers_no_district": (F.col("out_district_id").isNull() & F.col("in_district_id").isNull(),
                                  _warn("no district resolved")),
        "transfers_inter_district_count": (is_true(F.col("is_inter_district")),
                                           informative("PASS", "inter-district transfers")),
        "transfers_implausible_days": ((days < 0) | (days > LONGEST_POSTING_DAYS), _warn("implausible days at station")),
        "transfers_date_logic_error": (F.col("reporting_date") < F.col("posting_date"),
                                       _warn("reporting before posting")),
    })
    s.add("transfers_unresolved_teacher", _fail("fact rows with unknown teacher"), orphans, fact, "teacher_id",
          t["dw.teacher_dim"])
    s.add("transfers_approved_not_loaded", _warn("approved transfers not loaded"), uncovered,
          staged.filter(approved & F.col("person_id").isNotNull()), ["transfer_id"], fact, ["transfer_source_id"])
    return s


def indicators(t: Tables, as_of: date) -> Suite:
    total = F.col("sex") == "TOTAL"
    ger, women = F.col("ger"), F.col("pct_female_teachers")
    crowded = F.col("pop_age_6_12") > F.col("total_population") * F.lit("0.20").cast("decimal(3,2)")
    s = Suite("INDICATORS")
    s.scan(t["dw.population_fact"], {
        "indicators_population_current_year": (total, non_empty("district totals", soft_floor=EXPECTED_DISTRICTS)),
        "indicators_population_age_proportions": (total & crowded, _warn("too large a share aged 6 to 12")),
    })
    s.scan(t["dw.enrolment_indicator_fact"], {
        "indicators_enrolment_fact_row_count": (F.lit(True), non_empty("enrolment indicator rows")),
        "indicators_ger_range": ((ger < 0) | (ger > 200), _warn("enrolment ratio out of range")),
        "indicators_repetition_rate_range": (F.col("repetition_rate") > 30, _warn("repetition rate out of range")),
        "indicators_missing_ger_denominator": (ger.isNull() & (F.col("total_enrolment") > 0),
                                               _warn("enrolment without population")),
    })
    s.scan(t["dw.school_indicator_fact"], {
        "indicators_school_fact_row_count": (F.lit(True), non_empty("school indicator rows")),
        "indicators_ptr_extreme": (F.col("ptr") > 100, _warn("more than 100 learners per teacher")),
        "indicators_schools_no_teachers": ((F.col("total_learners") > 0) & (F.col("total_teachers") == 0),
                                           Rule(bad="WARN", at_most=TOLERATED_ROWS, severity="WARNING",
                                                detail="schools with learners and no teacher")),
        "indicators_female_teacher_pct_range": ((women < 0) | (women > 100), _fail("share out of range")),
    })
    return s


def supplementary(t: Tables, as_of: date) -> Suite:
    """Conditions that change results without breaking a rule of the marts above.

    Units that climb to several districts multiply their schools' counts; schools outside the
    hierarchy drop out of the district indicators; facts that point at expired versions drop out
    of all indicators; and a year joined from two numbers lies outside any calendar.
    """
    ancestry, dim = t["dw.unit_ancestor"], t["dw.schools_dim"].filter("is_current")
    reached = reach(ancestry)
    year = F.col("academic_year")
    s = Suite("SUPPLEMENTARY")
    s.add("units_with_several_districts", _warn("units in several districts"), rows, several_districts(reached))
    s.add("units_above_themselves", _warn("units in a cycle of the hierarchy"), rows, above_themselves(ancestry))
    s.add("schools_without_district", _warn("current schools outside the hierarchy"), uncovered, dim,
          ["admin_unit_id"], reached, ["unit_dim_id"])
    s.add("enrolments_of_expired_learners", _warn("enrolments of expired learner versions"), orphans,
          t["dw.enrolment_fact"], "learner_id", t["dw.learner_dim"].filter("is_current"))
    s.add("hr_rows_of_expired_teachers", _warn("HR rows of expired teacher versions"), orphans,
          t["dw.hr_fact"], "teacher_id", t["dw.teacher_dim"].filter("is_current"))
    s.scan(t["stg.enrolments_flat"], {
        "implausible_academic_year": ((year < YEARS[0]) | (year > YEARS[1]), _warn("academic year out of range")),
    })
    s.scan(t["stg.population_raw"], {
        "population_district_unmatched": (F.col("district_source_id").isNull() & (F.col("sex") == "TOTAL"),
                                          _warn("districts not found by name")),
    })
    return s


SUITES = {
    "schools_nightly": nightly_schools, "schools": schools, "enrolment": enrolment, "teachers": teachers,
    "non_teaching_staff": staff, "infrastructure": infrastructure, "teaching_subjects": subjects,
    "teacher_transfers": transfers, "indicators": indicators, "supplementary": supplementary,
}
