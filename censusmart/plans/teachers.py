"""Teacher mart: extracts, person × term rows, teacher versions, HR fact."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.functions.calendar import age_in_year
from censusmart.functions.labels import discipline, full_given_name, nationality
from censusmart.functions.numbers import is_true
from censusmart.operators.asof import Role, version_or_earliest
from censusmart.operators.keys import first_per_key
from censusmart.operators.lookup import decode_ids, expand_periods, lookup
from censusmart.operators.scd2 import Versioned, scd2_merge
from censusmart.plans.common import Tables, all_periods, identity_numbers, on_calendar, people, school_facts

NATURAL_KEY = ["person_id", "school_source_id", "academic_year", "term"]

TEACHERS = Versioned(
    keys=["source_id"],
    tracked={
        "gender": "", "qualification": "", "qualification_category": "", "teacher_type": "",
        "designation": "", "highest_education_level": "", "is_on_government_payroll": "false",
        "discipline": "",
    },
)


def _latest(df: DataFrame, keys: list[str], *ties: str) -> DataFrame:
    return first_per_key(df, keys, [F.col("date_updated").desc_nulls_last(), *[F.col(c) for c in ties]])


def extract_teachers(t: Tables) -> DataFrame:
    """One row per teacher with the most recently updated teaching employment."""
    jobs = _latest(t["src.school_employees"].filter(is_true(F.col("is_teaching_staff"))), ["person_id"], "id")
    jobs = decode_ids(
        jobs,
        [
            (t["src.setting_education_levels"], "highest_education_level_id", {"name": "highest_education_level"}),
            (t["src.setting_employment_statuses"], "employment_status_id", {"name": "employment_status"}),
        ],
    ).select(
        F.col("person_id").alias("_worker"), F.col("id").alias("employee_id"),
        F.col("ipps_number").alias("job_ipps"), F.col("is_on_government_payroll").alias("job_payroll"),
        "highest_education_level", "employment_status", "hrin", "hcm_employee_number", "date_started",
        "date_ended", "weekly_teaching_periods", "is_undergoing_training",
        F.col("date_updated").alias("job_updated"),
    )
    person = people(t).filter(F.col("deleted_at").isNull()).select(
        F.col("id").alias("_person"), "surname", "first_name", "other_names", "birth_date", "gender", "country"
    )
    ids = identity_numbers(t, ["nin", "passport_no"]).withColumnRenamed("person_id", "_holder")
    named = decode_ids(
        t["src.teachers"],
        [
            (t["src.setting_teacher_types"], "teacher_type_id", {"name": "teacher_type"}),
            (t["src.setting_teacher_professional_qualifications"], "qualification_id",
             {"name": "qualification", "qualification_category": "qualification_category"}),
            (t["src.setting_teaching_staff_designations"], "designation_id", {"name": "designation"}),
        ],
    )
    joined = (
        named.join(person, F.col("person_id") == F.col("_person"))
        .join(jobs, F.col("person_id") == F.col("_worker"), "left")
        .join(ids, F.col("person_id") == F.col("_holder"), "left")
    )
    newest = [F.col(c).desc_nulls_last() for c in ("job_updated", "date_updated", "tmis_number", "ipps_number")]
    joined = first_per_key(joined, ["person_id"], newest)
    touched = F.greatest("date_updated", "job_updated")
    return joined.select(
        "person_id", "employee_id", "surname",
        full_given_name(F.col("first_name"), F.col("other_names")).alias("given_name"),
        "gender", F.col("birth_date").alias("date_of_birth"),
        nationality(F.col("country")).alias("nationality"), "nin", "passport_no",
        "teacher_type", "qualification", "qualification_category", "designation",
        F.coalesce("ipps_number", "job_ipps").alias("ipps_number"), "tmis_number", "moes_license_number",
        F.coalesce("is_on_government_payroll", "job_payroll").alias("is_on_government_payroll"),
        "first_appointment_date", "posting_date", "subject_category", "highest_education_level",
        "employment_status", "hrin", "hcm_employee_number", "date_started", "date_ended",
        "weekly_teaching_periods", "is_undergoing_training", "current_school_id",
        touched.alias("date_created"), touched.alias("date_updated"),
    )


def extract_teacher_subjects(t: Tables) -> DataFrame:
    """Subjects taught, active ones only, with the person behind the employment."""
    subjects = t["src.setting_secondary_school_subjects"].filter(
        F.col("deleted_at").isNull() & is_true(F.col("is_active_yn"))
    )
    rows = lookup(
        t["src.teacher_subjects"], subjects, "subject_id",
        {"name": "subject_name", "is_science_subject": "is_science_subject",
         "is_language_subject": "is_language_subject"}, how="inner",
    )
    rows = lookup(rows, t["src.school_employees"], "employee_id", {"person_id": "person_id"}, how="inner")
    return rows.select(
        "id", "employee_id", "person_id", "subject_id", "subject_name", "is_science_subject",
        "is_language_subject", "date_created", "date_updated",
    )


def extract_deployments(t: Tables) -> DataFrame:
    """The most recently updated school of every employment."""
    posted = t["src.teaching_staff"].filter(F.col("school_id").isNotNull()).select(
        "employee_id", "person_id", "school_id", "is_transfer_appointment", "appointment_date",
        "staff_category", "date_created", "date_updated",
    )
    return _latest(posted, ["employee_id"], "school_id", "person_id")


def subject_counts(t: Tables) -> DataFrame:
    """Per person, the number of subjects and of science subjects."""
    return t["stg.teacher_subjects_raw"].groupBy(F.col("person_id").alias("_counted")).agg(
        F.count(F.lit(1)).alias("subjects"),
        F.count_if(is_true(F.col("is_science_subject"))).alias("science"),
    )


def flatten_teachers(t: Tables, as_of: date, compat: bool = False) -> DataFrame:
    """One row per teacher, deployment and academic term.

    Everything about the person and the school is joined before the rows multiply by terms.
    """
    schools = school_facts(t)
    levels = t["src.setting_education_levels"].select(
        F.col("id").alias("_level_id"), F.col("name").alias("school_level")
    )
    schools = schools.join(levels, F.col("_school_type_id") == F.col("_level_id"), "left")
    posts = t["stg.teacher_school_raw"].filter(F.col("school_id").isNotNull()).select(
        F.col("person_id").alias("_posted"), "school_id"
    )
    persons = (
        t["stg.teachers_raw"]
        .join(posts, F.col("person_id") == F.col("_posted"))
        .join(subject_counts(t), F.col("person_id") == F.col("_counted"), "left")
        .join(schools, F.col("school_id") == F.col("_school"))
    )
    ready = persons.select(
        "person_id", "employee_id", "school_id", "surname", "given_name", "gender",
        age_in_year(as_of, F.col("date_of_birth")).alias("age"), "date_of_birth", "nationality", "nin",
        "passport_no", "teacher_type", "qualification", "qualification_category", "designation",
        discipline(F.col("subjects"), F.col("science"), compat).alias("discipline"),
        "ipps_number", "tmis_number", "moes_license_number", "is_on_government_payroll",
        "first_appointment_date", "posting_date", "highest_education_level", "employment_status", "hrin",
        "hcm_employee_number", "weekly_teaching_periods", "is_undergoing_training",
        "school_emis_number", "school_name", "school_type", "school_ownership", "school_level",
        "admin_unit_source_id",
    )
    periods = all_periods(t).withColumnRenamed("school_id", "for_school")
    return expand_periods(ready, periods, "school_id", "for_school")


def stage_teachers(flat: DataFrame) -> DataFrame:
    """One row per teacher, from the latest term."""
    latest = [F.col("term_start_date").desc_nulls_last(), F.col("school_id"), F.col("term")]
    return first_per_key(flat, ["person_id"], latest).withColumnRenamed("person_id", "source_id")


def merge_teachers(t: Tables, as_of: date, compat: bool = False) -> DataFrame:
    spec = replace(TEACHERS, compat="initial") if compat else TEACHERS
    return scd2_merge(t["dw.teacher_dim"], stage_teachers(t["stg.teachers_flat"]), spec, as_of)


def hr_fact(t: Tables) -> DataFrame:
    """Teacher × school × term with the surrogates valid at the term's start, or the earliest."""
    flat = t["stg.teachers_flat"].select(
        "person_id", F.col("school_id").alias("school_source_id"), "academic_year", "term", "term_start_date"
    )
    dated = on_calendar(flat, t["dw.date_dim"], "term_start_date")
    roles = [
        Role(t["dw.teacher_dim"], "person_id", "teacher_id"),
        Role(t["dw.schools_dim"], "school_source_id", "school_id"),
    ]
    loaded = version_or_earliest(dated, roles, "term_start_date", NATURAL_KEY, [F.col("term_start_date")])
    return loaded.select(
        F.xxhash64(*NATURAL_KEY).alias("id"), "teacher_id", "school_id", "date_id", *NATURAL_KEY, "load_phase"
    )
