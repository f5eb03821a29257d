"""Teaching-subjects mart: subject list, teacher × subject rows, coverage fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.functions.labels import subject_category
from censusmart.operators.keys import first_per_key
from censusmart.operators.upsert import insert_absent, upsert
from censusmart.plans.common import Tables, current_ids, school_facts

NATURAL_KEY = ["person_id", "subject_source_id", "subject_level"]

DESCRIBED = (
    "is_language_subject", "is_science_subject", "is_principal_subject", "is_olevel_subject",
    "is_alevel_subject", "is_mandatory", "is_examinable", "has_lab_yn", "is_active_yn",
)
# Columns a reload refreshes.
SUBJECT_UPDATES = ["subject_name", *DESCRIBED, "subject_category"]
FACT_UPDATES = ["teacher_id", "school_id", "date_id"]

FLAT_COLUMNS = [
    "person_id", "employee_id", "subject_id", "subject_name", "subject_level", "is_science_subject",
    "is_language_subject", "is_principal_subject", "is_olevel_subject", "is_alevel_subject",
    "school_id", "school_name", "school_type", "teacher_type", "gender", "qualification",
    "admin_unit_source_id", "date_created", "date_updated",
]


def subject_list(t: Tables) -> DataFrame:
    """Secondary and primary subjects, not deleted, in one list keyed by (id, level)."""
    kept = F.col("deleted_at").isNull()
    unknown = F.lit(None).cast("boolean")
    secondary = t["src.setting_secondary_school_subjects"].filter(kept).select(
        F.col("id").alias("source_id"), F.lit("SECONDARY").alias("subject_level"),
        F.col("name").alias("subject_name"), *DESCRIBED, "is_archived_yn", "date_created", "date_updated",
    )
    made = {"is_language_subject": F.coalesce("is_language_subject", F.lit(False)),
            "is_science_subject": F.lit(False), "is_active_yn": F.col("is_active_yn")}
    primary = t["src.setting_primary_school_subjects"].filter(kept).select(
        F.col("id").alias("source_id"), F.lit("PRIMARY").alias("subject_level"),
        F.col("name").alias("subject_name"), *[made.get(c, unknown).alias(c) for c in DESCRIBED],
        "is_archived_yn", "date_created", "date_updated",
    )
    return secondary.unionByName(primary)


def _teachers_at_schools(t: Tables) -> DataFrame:
    """Teacher rows once per school they are deployed at, with the school's description."""
    schools = school_facts(t).select("_school", "school_name", "school_type", "admin_unit_source_id")
    posts = t["stg.teacher_school_raw"].select(F.col("person_id").alias("_posted"), "school_id")
    teachers = t["stg.teachers_raw"].select(
        F.col("person_id").alias("_teacher"), F.col("employee_id").alias("teacher_employee"), "teacher_type",
        "gender", "qualification",
    )
    return (
        teachers.join(posts, F.col("_teacher") == F.col("_posted"))
        .join(schools, F.col("school_id") == F.col("_school"), "left")
        .drop("_posted", "_school")
    )


def _one_per_subject(df: DataFrame, *ties: str) -> DataFrame:
    order = [F.col("school_id").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    return first_per_key(df, ["person_id", "subject_id"], order)


def secondary_teaching(t: Tables) -> DataFrame:
    subjects = t["src.setting_secondary_school_subjects"].select(
        F.col("id").alias("_subject"), "is_principal_subject", "is_olevel_subject", "is_alevel_subject"
    )
    taught = t["stg.teacher_subjects_raw"].join(
        _teachers_at_schools(t), F.col("person_id") == F.col("_teacher")
    ).join(subjects, F.col("subject_id") == F.col("_subject"), "left")
    return _one_per_subject(taught.withColumn("subject_level", F.lit("SECONDARY")), "id").select(FLAT_COLUMNS)


def primary_teaching(t: Tables) -> DataFrame:
    """Teachers of primary subjects by their two trained subjects; the same one twice counts once."""
    trained = t["src.teachers"].select(
        "person_id", "date_created", "date_updated",
        F.explode(F.array_distinct(F.array("trained_subject_1_id", "trained_subject_2_id"))).alias("subject_id"),
    )
    subjects = t["src.setting_primary_school_subjects"].filter(F.col("deleted_at").isNull()).select(
        F.col("id").alias("_subject"), F.col("name").alias("subject_name"),
        F.coalesce("is_language_subject", F.lit(False)).alias("is_language_subject"),
    )
    taught = trained.join(subjects, F.col("subject_id") == F.col("_subject")).join(
        _teachers_at_schools(t), F.col("person_id") == F.col("_teacher")
    )
    unknown = F.lit(None).cast("boolean")
    shaped = taught.withColumns(
        {
            "employee_id": F.col("teacher_employee"), "subject_level": F.lit("PRIMARY"),
            "is_science_subject": F.lit(False), "is_principal_subject": unknown,
            "is_olevel_subject": unknown, "is_alevel_subject": unknown,
        }
    )
    return _one_per_subject(shaped).select(FLAT_COLUMNS)


def flatten_teaching(t: Tables) -> DataFrame:
    """Teacher × subject rows, unique by person and subject id; secondary wins a shared id."""
    return insert_absent(secondary_teaching(t), primary_teaching(t), ["person_id", "subject_id"])


def subjects_for_dim(t: Tables) -> DataFrame:
    listed = t["stg.subject_dim_raw"].select("source_id", "subject_level", "subject_name", *DESCRIBED)
    return listed.withColumn(
        "subject_category", subject_category(F.col("is_language_subject"), F.col("is_science_subject"))
    ).withColumn("id", F.xxhash64("source_id", "subject_level"))


def merge_subjects(t: Tables) -> DataFrame:
    return upsert(t["dw.subject_dim"], subjects_for_dim(t), ["source_id", "subject_level"], SUBJECT_UPDATES)


def teaching_fact(t: Tables, as_of: date) -> DataFrame:
    """Current teacher × current school × subject, dated ``as_of`` (or the calendar's last day)."""
    days = t["dw.date_dim"]
    today = days.filter(F.col("system_date") == F.lit(as_of)).agg(F.max("id")).scalar()
    last = days.agg(F.max_by("id", "system_date")).scalar()
    flat = t["stg.teaching_subject_flat"].select(
        "person_id", F.col("school_id").alias("school_source_id"),
        F.col("subject_id").alias("subject_source_id"), "subject_level",
    )
    teachers = current_ids(t["dw.teacher_dim"], "teacher_id").withColumnRenamed("_source", "_t")
    schools = current_ids(t["dw.schools_dim"], "school_id").withColumnRenamed("_source", "_s")
    subjects = t["dw.subject_dim"].select(
        F.col("source_id").alias("subject_source_id"), "subject_level", F.col("id").alias("subject_id")
    )
    joined = (
        flat.join(teachers, F.col("person_id") == F.col("_t"))
        .join(schools, F.col("school_source_id") == F.col("_s"))
        .join(subjects, ["subject_source_id", "subject_level"])
    )
    return joined.select(
        F.xxhash64(*NATURAL_KEY).alias("id"), "teacher_id", "school_id", "subject_id",
        F.coalesce(today, last).alias("date_id"), "person_id", "school_source_id", "subject_source_id",
        "subject_level",
    )
