"""Non-teaching staff datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.functions.calendar import period_label
from censusmart.functions.numbers import is_true, percent
from censusmart.plans.common import Tables
from censusmart.reports.base import (
    breakdown, current_count, district_of, district_people, largest, people_by, smallest,
)

DIM, FACT = "dw.non_teaching_staff_dim", "dw.non_teaching_staff_fact"


def pct_female(t: Tables) -> DataFrame:
    rows = t[DIM].filter("is_current").select("id", "gender").distinct()
    return rows.agg(percent(F.count_if(F.col("gender") == "F"), F.count("id"), 1).alias("pct_female"))


def schools_with_staff(t: Tables) -> DataFrame:
    return t[FACT].agg(F.count_distinct("school_id").alias("schools_with_nts"))


def trend_over_time(t: Tables) -> DataFrame:
    counted = t[FACT].groupBy("academic_year", "term").agg(F.count_distinct("staff_id").alias("total_staff"))
    return counted.withColumn("period", period_label(F.col("academic_year"), F.col("term"))).orderBy(
        "academic_year", "term"
    )


def district_leaderboard(t: Tables) -> DataFrame:
    placed = district_of(t[FACT].select("school_id", "staff_id").distinct(), t)
    rows = people_by(
        placed, ["district_name"], "staff_id", t[DIM], ["gender", "category", "is_on_government_payroll"]
    )
    female = F.count_if(F.col("gender") == "F")
    board = rows.groupBy(F.col("district_name").alias("District")).agg(
        F.count(F.lit(1)).alias("Total Staff"),
        F.count_if(F.col("gender") == "M").alias("Male"),
        female.alias("Female"),
        percent(female, F.count(F.lit(1)), 1).alias("% Female"),
        F.count_if(F.col("category") == "ADMINISTRATIVE").alias("Administrative"),
        F.count_if(F.col("category") == "SUPPORT").alias("Support"),
        F.count_if(is_true(F.col("is_on_government_payroll"))).alias("Govt Payroll"),
    )
    return largest(board, "Total Staff", "District")


DATASETS = {
    "nts_kpi_total": current_count(DIM, "total_staff"),
    "nts_kpi_male": current_count(DIM, "total_male", lambda: F.col("gender") == "M"),
    "nts_kpi_female": current_count(DIM, "total_female", lambda: F.col("gender") == "F"),
    "nts_kpi_pct_female": pct_female,
    "nts_kpi_govt_payroll": current_count(
        DIM, "on_govt_payroll", lambda: is_true(F.col("is_on_government_payroll"))),
    "nts_kpi_schools": schools_with_staff,
    "nts_by_category": breakdown(DIM, "category", "total_staff"),
    "nts_by_gender": breakdown(DIM, "gender", "total_staff"),
    "nts_by_role": breakdown(DIM, "role", "total_staff"),
    "nts_by_employment_status": breakdown(DIM, "employment_status", "total_staff"),
    "nts_by_education_level": breakdown(DIM, "highest_education_level", "total_staff", "education_level"),
    "nts_top15_districts": district_people(FACT, "staff_id", "total_staff", largest),
    "nts_bottom15_districts": district_people(FACT, "staff_id", "total_staff", smallest),
    "nts_trend_over_time": trend_over_time,
    "nts_district_leaderboard": district_leaderboard,
}
