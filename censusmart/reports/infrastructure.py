"""Infrastructure datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.functions.labels import or_label
from censusmart.functions.numbers import percent, ratio, sum_when
from censusmart.plans.common import Tables
from censusmart.reports.base import Dataset, district_of, largest

FACT, DIM = "dw.infrastructure_fact", "dw.infrastructure_type_dim"

# Words in a building type's name that put it under a heading.
CLASSROOMS, LATRINES, LABS = ["%classroom%"], ["%latrine%"], ["%lab%", "%science%"]
LIBRARIES, COMPUTER_LABS = ["%library%"], ["%computer%"]


def counted(t: Tables) -> DataFrame:
    """Records that state a number of structures."""
    return t[FACT].filter(F.col("total_number") > 0)


def named(name: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [name.ilike(p) for p in patterns])


def per_school_and_type(t: Tables) -> DataFrame:
    """Structures per school and building type: the fact shrinks before it meets any dimension."""
    sums = counted(t).groupBy("school_id", "infra_type_id").agg(F.sum("total_number").alias("structures"))
    types = t[DIM].select(F.col("id").alias("infra_type_id"), "type_name")
    return sums.join(types, "infra_type_id")


def total_records(t: Tables) -> DataFrame:
    return t[FACT].agg(F.count(F.lit(1)).alias("total_records"))


def schools_with_data(t: Tables) -> DataFrame:
    return t[FACT].agg(F.count_distinct("school_id").alias("schools_with_data"))


def structures(name: str, column: str | None = None, value: str | None = None) -> Dataset:
    def dataset(t: Tables) -> DataFrame:
        rows = counted(t)
        if column:
            rows = rows.filter(F.upper(column) == value)
        return rows.agg(F.sum("total_number").alias(name))
    return dataset


def pct_complete(t: Tables) -> DataFrame:
    complete = sum_when(F.upper("completion_status") == "COMPLETE", F.col("total_number"))
    return counted(t).agg(percent(complete, F.sum("total_number"), 1).alias("pct_complete"))


def by_state(column: str, missing: str = "Unknown") -> Dataset:
    """Structures per stored value of ``column``; the label is upper-cased after grouping."""
    def dataset(t: Tables) -> DataFrame:
        sums = counted(t).groupBy(column).agg(F.sum("total_number").alias("total_structures"))
        shown = sums.withColumn(column, or_label(F.upper(column), missing))
        return largest(shown, "total_structures", column)
    return dataset


def by_type(t: Tables) -> DataFrame:
    rows = per_school_and_type(t).groupBy(F.col("type_name").alias("structure_type")).agg(
        F.sum("structures").alias("total_structures"), F.count_distinct("school_id").alias("schools")
    )
    return largest(rows, "total_structures", "structure_type")


def kind_by_district(patterns: list[str], total: str, schools: str, average: str | None = None) -> Dataset:
    def dataset(t: Tables) -> DataFrame:
        rows = per_school_and_type(t).filter(named(F.col("type_name"), patterns))
        rows = rows.groupBy("school_id").agg(F.sum("structures").alias("structures"))
        board = district_of(rows, t).groupBy(F.col("district_name").alias("District")).agg(
            F.sum("structures").alias(total), F.count_distinct("school_id").alias(schools)
        )
        if average:
            board = board.withColumn(average, ratio(F.col(total), F.col(schools), 1))
        return largest(board, total, "District", n=20)
    return dataset


def top15_districts(t: Tables) -> DataFrame:
    rows = counted(t).groupBy("school_id").agg(F.sum("total_number").alias("structures"))
    board = district_of(rows, t).groupBy("district_name").agg(
        F.count_distinct("school_id").alias("schools_with_infra_data"),
        F.sum("structures").alias("total_structures"),
    )
    return largest(board, "total_structures", "district_name", n=15)


def full_leaderboard(t: Tables) -> DataFrame:
    kinds = {
        "Classrooms": CLASSROOMS, "Latrines": LATRINES, "Labs": LABS, "Libraries": LIBRARIES,
        "Computer Labs": COMPUTER_LABS,
    }
    rows = district_of(per_school_and_type(t), t)
    board = rows.groupBy(F.col("district_name").alias("District")).agg(
        F.count_distinct("school_id").alias("Schools"),
        *[sum_when(named(F.col("type_name"), p), F.col("structures")).alias(h) for h, p in kinds.items()],
        F.sum("structures").alias("Total Structures"),
    )
    return largest(board, "Total Structures", "District")


DATASETS = {
    "infra_kpi_total_records": total_records,
    "infra_kpi_schools": schools_with_data,
    "infra_kpi_total_structures": structures("total_structures"),
    "infra_kpi_complete": structures("complete_structures", "completion_status", "COMPLETE"),
    "infra_kpi_permanent": structures("permanent_structures", "usage_mode", "PERMANENT"),
    "infra_kpi_pct_complete": pct_complete,
    "infra_by_completion_status": by_state("completion_status"),
    "infra_by_usage_mode": by_state("usage_mode"),
    "infra_by_structure_condition": by_state("structure_condition", "Not Recorded"),
    "infra_by_type": by_type,
    "infra_classrooms_by_district": kind_by_district(
        CLASSROOMS, "Total Classrooms", "Schools", "Avg Classrooms per School"),
    "infra_latrines_by_district": kind_by_district(
        LATRINES, "Total Latrine Stances", "Schools", "Avg Stances per School"),
    "infra_labs_by_district": kind_by_district(LABS, "Total Labs", "Schools with Labs"),
    "infra_top15_districts": top15_districts,
    "infra_full_leaderboard": full_leaderboard,
}
