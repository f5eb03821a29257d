"""Indicator datasets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.functions.calendar import period_label
from censusmart.functions.numbers import mean, percent, ptr_band
from censusmart.plans.common import Tables
from censusmart.reports.base import Dataset, district_of, largest, smallest

SCHOOL, ENROLMENT = "dw.school_indicator_fact", "dw.enrolment_indicator_fact"
PTR, QUALIFIED, WOMEN = "ptr", "qualified_teacher_ratio", "pct_female_teachers"


def plausible(limit: int = 200) -> Column:
    """Ratios of 0 and extreme ones point to missing data and stay out of the averages."""
    return (F.col(PTR) > 0) & (F.col(PTR) < limit)


def average(column: str, name: str, keep: Callable[[], Column]) -> Dataset:
    return lambda t: t[SCHOOL].filter(keep()).agg(mean(F.col(column), 1).alias(name))


def schools_with_data(t: Tables) -> DataFrame:
    return t[SCHOOL].agg(F.count_distinct("school_id").alias("schools_with_indicators"))


def districts_with_data(t: Tables) -> DataFrame:
    return t[ENROLMENT].agg(F.count_distinct("district_id").alias("districts_with_indicators"))


def latest_year(t: Tables) -> DataFrame:
    """Enrolment indicators of the newest year in the table, whatever the gender rows."""
    newest = t[ENROLMENT].agg(F.max("academic_year")).scalar()
    return t[ENROLMENT].filter(F.col("academic_year") == newest)


def total_enrolment(t: Tables) -> DataFrame:
    rows = latest_year(t).filter(F.col("gender") == "TOTAL")
    return rows.agg(F.sum("total_enrolment").alias("total_enrolment"))


def ptr_by_district(t: Tables) -> DataFrame:
    board = district_of(t[SCHOOL].filter(plausible()), t).groupBy(F.col("district_name").alias("District")).agg(
        mean(F.col(PTR), 1).alias("Avg PTR"),
        mean(F.col(QUALIFIED), 1).alias("% Qualified Teachers"),
        mean(F.col(WOMEN), 1).alias("% Female Teachers"),
        F.count_distinct("school_id").alias("Schools"),
    )
    return largest(board, "Avg PTR", "District", n=20)


def ptr_distribution(t: Tables) -> DataFrame:
    rows = t[SCHOOL].filter(plausible(500)).groupBy(ptr_band(F.col(PTR)).alias("ptr_range")).agg(
        F.count(F.lit(1)).alias("schools"), F.min(PTR).alias("_from")
    )
    return rows.orderBy("_from").drop("_from")


def _level() -> Column:
    return F.upper(F.trim("school_level")).alias("school_level")


def enrolment_by_level_gender(t: Tables) -> DataFrame:
    """Grouped by the level as stored: spellings that differ in case print alike but stay apart."""
    rows = latest_year(t).filter(F.col("gender").isin("M", "F") & F.col("school_level").isNotNull())
    sums = rows.groupBy("school_level", "gender", "academic_year").agg(
        F.sum("total_enrolment").alias("total_enrolment")
    )
    return sums.orderBy("school_level", "gender").select(_level(), "gender", "total_enrolment", "academic_year")


def enrolment_trend(t: Tables) -> DataFrame:
    rows = t[ENROLMENT].filter((F.col("gender") == "TOTAL") & F.col("school_level").isNotNull())
    sums = rows.groupBy("academic_year", "school_level").agg(F.sum("total_enrolment").alias("total_enrolment"))
    return sums.orderBy("academic_year", "school_level").select("academic_year", _level(), "total_enrolment")


def district_totals(t: Tables) -> DataFrame:
    """TOTAL rows with the district's name, from every version of the district unit."""
    units = t["dw.admin_units_dim"].filter(F.col("admin_unit_type") == "District").select(
        F.col("id").alias("district_id"), F.col("name").alias("District")
    )
    return t[ENROLMENT].filter(F.col("gender") == "TOTAL").join(units, "district_id")


def gpi_by_district(t: Tables) -> DataFrame:
    board = district_totals(t).filter(F.col("school_level").isNotNull()).groupBy(
        "District", F.col("school_level").alias("School Level")
    ).agg(
        mean(F.col("gpi_ger"), 2).alias("GPI (GER)"),
        mean(F.col("gpi_ner"), 2).alias("GPI (NER)"),
        F.sum("total_enrolment").alias("Total Enrolment"),
    )
    return smallest(board, "GPI (GER)", "District", "School Level", n=30)


def sne_by_district(t: Tables) -> DataFrame:
    board = district_totals(t).groupBy("District").agg(
        F.sum("learners_with_disability").alias("SNE Learners"),
        F.sum("total_enrolment").alias("Total Enrolment"),
        percent(F.sum("learners_with_disability"), F.sum("total_enrolment"), 2).alias("SNE Inclusion Rate %"),
    )
    return largest(board, "SNE Learners", "District", n=15)


def lowest_districts(column: str, name: str) -> Dataset:
    def dataset(t: Tables) -> DataFrame:
        rows = district_of(t[SCHOOL].filter(F.col(column) >= 0), t)
        board = rows.groupBy("district_name").agg(mean(F.col(column), 1).alias(name))
        return smallest(board, name, "district_name", n=20)
    return dataset


def ptr_over_time(t: Tables) -> DataFrame:
    rows = t[SCHOOL].filter(plausible()).groupBy("academic_year", "term").agg(
        mean(F.col(PTR), 1).alias("avg_ptr"),
        mean(F.col(QUALIFIED), 1).alias("avg_qualified_ratio"),
        mean(F.col(WOMEN), 1).alias("avg_pct_female"),
    )
    return rows.withColumn("period", period_label(F.col("academic_year"), F.col("term"))).orderBy(
        "academic_year", "term"
    )


DATASETS = {
    "indicators_kpi_avg_ptr": average(PTR, "national_avg_ptr", plausible),
    "indicators_kpi_avg_qualified_ratio": average(
        QUALIFIED, "avg_qualified_ratio", lambda: F.col(QUALIFIED) > 0),
    "indicators_kpi_avg_pct_female_teachers": average(
        WOMEN, "avg_pct_female_teachers", lambda: F.col(WOMEN) >= 0),
    "indicators_kpi_schools_with_data": schools_with_data,
    "indicators_kpi_total_enrolment": total_enrolment,
    "indicators_kpi_districts_with_data": districts_with_data,
    "indicators_ptr_by_district": ptr_by_district,
    "indicators_ptr_distribution": ptr_distribution,
    "indicators_enrolment_by_level_gender": enrolment_by_level_gender,
    "indicators_gpi_by_district": gpi_by_district,
    "indicators_qualified_teacher_by_district": lowest_districts(QUALIFIED, "avg_qualified_ratio"),
    "indicators_female_teachers_by_district": lowest_districts(WOMEN, "avg_pct_female_teachers"),
    "indicators_enrolment_trend": enrolment_trend,
    "indicators_sne_by_district": sne_by_district,
    "indicators_ptr_over_time": ptr_over_time,
}
