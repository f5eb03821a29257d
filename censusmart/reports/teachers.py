"""Teacher datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.functions.calendar import period_label
from censusmart.functions.numbers import is_true, percent, ratio
from censusmart.operators.distinct import distinct_counts, numbered
from censusmart.plans.common import Tables
from censusmart.reports.base import (
    breakdown, current_count, district_of, district_people, largest, people_by, smallest,
)

DIM, FACT = "dw.teacher_dim", "dw.hr_fact"


def pct_female(t: Tables) -> DataFrame:
    rows = t[DIM].filter("is_current").select("id", "gender").distinct()
    return rows.agg(percent(F.count_if(F.col("gender") == "F"), F.count("id"), 1).alias("pct_female"))


def trend_over_time(t: Tables) -> DataFrame:
    rows = people_by(t[FACT], ["academic_year", "term"], "teacher_id", t[DIM], ["gender"])
    counted = rows.groupBy("academic_year", "term").agg(
        F.count(F.lit(1)).alias("total_teachers"),
        F.count_if(F.col("gender") == "M").alias("male"),
        F.count_if(F.col("gender") == "F").alias("female"),
    )
    return counted.withColumn("period", period_label(F.col("academic_year"), F.col("term"))).orderBy(
        "academic_year", "term"
    )


def district_leaderboard(t: Tables) -> DataFrame:
    placed = district_of(t[FACT].select("school_id", "teacher_id").distinct(), t)
    rows = people_by(
        placed, ["district_name"], "teacher_id", t[DIM],
        ["gender", "teacher_type", "is_on_government_payroll"],
    )
    female = F.count_if(F.col("gender") == "F")
    board = rows.groupBy(F.col("district_name").alias("District")).agg(
        F.count(F.lit(1)).alias("Total Teachers"),
        F.count_if(F.col("gender") == "M").alias("Male"),
        female.alias("Female"),
        percent(female, F.count(F.lit(1)), 1).alias("% Female"),
        F.count_if(F.col("teacher_type") == "QUALIFIED").alias("Qualified"),
        F.count_if(is_true(F.col("is_on_government_payroll"))).alias("Govt Payroll"),
    )
    return largest(board, "Total Teachers", "District")


def _learners_per_school(t: Tables) -> DataFrame:
    return t["dw.enrolment_fact"].groupBy(F.col("school_id").alias("_school")).agg(
        F.count(F.lit(1)).alias("learners")
    )


def ptr_by_district(t: Tables) -> DataFrame:
    """As published: a school's learners count once for every HR row of the school.

    The HR rows are first reduced to one row per school and teacher with their number; one pass of bitmaps then
    counts schools and teachers and sums the learners.
    """
    posts = t[FACT].groupBy("school_id", "teacher_id").agg(F.count(F.lit(1)).alias("hr_rows"))
    places = numbered(t["dw.school_district_map"].select("school_dim_id", "district_name"), "school_dim_id", "_school_no")
    rows = numbered(posts, "teacher_id", "_teacher_no", near="school_id").join(
        places, F.col("school_id") == F.col("school_dim_id")
    ).join(_learners_per_school(t), F.col("school_id") == F.col("_school"), "left")
    counted = distinct_counts(
        rows, ["district_name"], {"Schools": F.col("_school_no"), "Teachers": F.col("_teacher_no")},
        {"Learners": F.col("learners") * F.col("hr_rows")},
    )
    board = counted.select(
        F.col("district_name").alias("District"), "Schools", "Teachers", "Learners",
        ratio(F.col("Learners"), F.col("Teachers"), 1).alias("PTR"),
    )
    return largest(board, "PTR", "District")


def ptr_by_district_dedup(t: Tables) -> DataFrame:
    """The same ratio with every school's learners counted once."""
    posts = district_of(t[FACT].select("school_id", "teacher_id").distinct(), t)
    per_school = posts.groupBy("district_name", "school_id").agg(F.count(F.lit(1)).alias("n"))
    learners = per_school.join(
        _learners_per_school(t), F.col("school_id") == F.col("_school"), "left"
    ).groupBy("district_name").agg(F.count(F.lit(1)).alias("Schools"), F.sum("learners").alias("Learners"))
    teachers = posts.groupBy("district_name").agg(F.count_distinct("teacher_id").alias("Teachers"))
    board = learners.join(teachers, "district_name").select(
        F.col("district_name").alias("District"), "Schools", "Teachers", "Learners",
        ratio(F.col("Learners"), F.col("Teachers"), 1).alias("PTR"),
    )
    return largest(board, "PTR", "District")


DATASETS = {
    "teachers_kpi_total": current_count(DIM, "total_teachers"),
    "teachers_kpi_male": current_count(DIM, "total_male", lambda: F.col("gender") == "M"),
    "teachers_kpi_female": current_count(DIM, "total_female", lambda: F.col("gender") == "F"),
    "teachers_kpi_pct_female": pct_female,
    "teachers_kpi_qualified": current_count(
        DIM, "qualified_teachers", lambda: F.col("teacher_type") == "QUALIFIED"),
    "teachers_kpi_govt_payroll": current_count(
        DIM, "on_govt_payroll", lambda: is_true(F.col("is_on_government_payroll"))),
    "teachers_by_type": breakdown(DIM, "teacher_type", "total_teachers"),
    "teachers_by_gender": breakdown(DIM, "gender", "total_teachers"),
    "teachers_by_discipline": breakdown(DIM, "discipline", "total_teachers"),
    "teachers_by_qualification": breakdown(DIM, "qualification", "total_teachers"),
    "teachers_by_designation": breakdown(DIM, "designation", "total_teachers"),
    "teachers_top15_districts": district_people(FACT, "teacher_id", "total_teachers", largest),
    "teachers_bottom15_districts": district_people(FACT, "teacher_id", "total_teachers", smallest),
    "teachers_trend_over_time": trend_over_time,
    "teachers_district_leaderboard": district_leaderboard,
    "teachers_ptr_by_district": ptr_by_district,
    "teachers_ptr_by_district_dedup": ptr_by_district_dedup,
}
