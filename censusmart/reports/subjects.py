"""Teaching-subject datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.functions.labels import certificate_level, or_label, yes_no
from censusmart.functions.numbers import is_false, is_true, percent
from censusmart.operators.distinct import distinct_counts, numbered
from censusmart.plans.common import Tables
from censusmart.reports.base import Dataset, district_of, largest, smallest

FACT, DIM = "dw.teaching_subject_fact", "dw.subject_dim"
SCIENCE = "is_science_subject"


def taught(t: Tables, *columns: str) -> DataFrame:
    """Each teacher × subject once, with columns of the subject."""
    pairs = t[FACT].select("teacher_id", "subject_id").distinct()
    subjects = t[DIM].select(F.col("id").alias("subject_id"), *columns)
    return pairs.join(subjects, "subject_id")


def total_assignments(t: Tables) -> DataFrame:
    return t[FACT].agg(F.count(F.lit(1)).alias("total_assignments"))


def distinct_in_fact(column: str, name: str) -> Dataset:
    return lambda t: t[FACT].agg(F.count_distinct(column).alias(name))


def teachers_where(test, name: str) -> Dataset:
    return lambda t: taught(t, SCIENCE).filter(test(F.col(SCIENCE))).agg(
        F.count_distinct("teacher_id").alias(name)
    )


def pct_science(t: Tables) -> DataFrame:
    """Per teacher: whether any subject is a science; then one conditional count."""
    teachers = taught(t, SCIENCE).groupBy("teacher_id").agg(F.max(is_true(F.col(SCIENCE))).alias("science"))
    return teachers.agg(
        percent(F.count_if("science"), F.count("teacher_id"), 1).alias("pct_science_teachers")
    )


def by_attribute(column: str) -> Dataset:
    """Teachers and subjects per attribute in one pass; teachers are numbered by their first subject."""
    def dataset(t: Tables) -> DataFrame:
        subjects = numbered(t[DIM].select(F.col("id").alias("subject_id"), column), "subject_id", "_subject")
        rows = numbered(t[FACT].select("teacher_id", "subject_id"), "teacher_id", "_teacher", near="subject_id")
        counted = distinct_counts(
            rows.join(subjects, "subject_id"), [column],
            {"total_teachers": F.col("_teacher"), "total_subjects": F.col("_subject")},
        )
        return largest(counted.withColumn(column, or_label(F.col(column))), "total_teachers", column)
    return dataset


def top20_by_teachers(t: Tables) -> DataFrame:
    counted = taught(t, "subject_name", "subject_category", "subject_level").groupBy(
        "subject_name", F.col("subject_category").alias("category"), F.col("subject_level").alias("level")
    ).agg(F.count_distinct("teacher_id").alias("total_teachers"))
    return largest(counted, "total_teachers", "subject_name", "category", "level", n=20)


def science_vs_arts_by_district(t: Tables) -> DataFrame:
    """Teachers per district by kind of subject; each teacher is reduced to two flags first."""
    def any_where(test: Column) -> Column:
        return F.max(F.when(test, 1).otherwise(0))

    rows = t[FACT].select("school_id", "teacher_id", "subject_id").distinct().join(
        t[DIM].select(F.col("id").alias("subject_id"), SCIENCE), "subject_id"
    )
    per_school = rows.groupBy("school_id", "teacher_id").agg(
        any_where(is_true(F.col(SCIENCE))).alias("s"), any_where(is_false(F.col(SCIENCE))).alias("a")
    )
    per_teacher = district_of(per_school, t).groupBy("district_name", "teacher_id").agg(
        F.max("s").alias("s"), F.max("a").alias("a")
    )
    board = per_teacher.groupBy("district_name").agg(
        F.sum("s").alias("science_teachers"), F.sum("a").alias("arts_teachers"),
        F.count(F.lit(1)).alias("total_teachers"),
        percent(F.sum("s"), F.count(F.lit(1)), 1).alias("pct_science"),
    )
    return smallest(board, "pct_science", "district_name", n=20)


def olevel_alevel_split(t: Tables) -> DataFrame:
    level = certificate_level(F.col("is_olevel_subject"), F.col("is_alevel_subject"))
    counted = taught(t, "is_olevel_subject", "is_alevel_subject").groupBy(level.alias("level_type")).agg(
        F.count_distinct("teacher_id").alias("total_teachers")
    )
    return largest(counted, "total_teachers", "level_type")


def lab_subjects(t: Tables) -> DataFrame:
    counted = taught(t, "subject_name", "subject_category", "has_lab_yn").filter("has_lab_yn").groupBy(
        "subject_name", F.col("subject_category").alias("category")
    ).agg(F.count_distinct("teacher_id").alias("total_teachers"))
    return largest(counted, "total_teachers", "subject_name", "category")


# Report headings of the subject attributes.
HEADINGS = {"subject_name": "Subject", "subject_level": "Level", "subject_category": "Category"}
FLAG_HEADINGS = {
    SCIENCE: "Science", "has_lab_yn": "Lab Required", "is_mandatory": "Mandatory", "is_examinable": "Examinable",
}


def full_leaderboard(t: Tables) -> DataFrame:
    """Grouped by the raw attributes: an unknown flag and a false one print alike but stay apart."""
    keys = [*HEADINGS, *FLAG_HEADINGS]
    counted = taught(t, *keys).groupBy(*keys).agg(F.count_distinct("teacher_id").alias("Teachers"))
    board = counted.select(
        *[F.col(c).alias(h) for c, h in HEADINGS.items()],
        *[yes_no(F.col(c)).alias(h) for c, h in FLAG_HEADINGS.items()], "Teachers",
    )
    return largest(board, "Teachers", "Subject", "Level")


DATASETS = {
    "subjects_kpi_total_assignments": total_assignments,
    "subjects_kpi_teachers_with_subjects": distinct_in_fact("teacher_id", "teachers_with_subjects"),
    "subjects_kpi_total_subjects": distinct_in_fact("subject_id", "total_subjects"),
    "subjects_kpi_science_teachers": teachers_where(is_true, "science_teachers"),
    "subjects_kpi_arts_teachers": teachers_where(is_false, "arts_teachers"),
    "subjects_kpi_pct_science": pct_science,
    "subjects_by_category": by_attribute("subject_category"),
    "subjects_by_level": by_attribute("subject_level"),
    "subjects_top20_by_teachers": top20_by_teachers,
    "subjects_science_vs_arts_by_district": science_vs_arts_by_district,
    "subjects_olevel_alevel_split": olevel_alevel_split,
    "subjects_lab_subjects": lab_subjects,
    "subjects_full_leaderboard": full_leaderboard,
}
