"""The charts over the datasets: what each one aggregates, by which columns, and how many rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from censusmart.operators.shape import apply_metric
from censusmart.plans.common import Tables
from censusmart.reports import DATASETS


@dataclass(frozen=True)
class Chart:
    metrics: tuple[tuple[str, str], ...]
    dims: tuple[str, ...] = ()
    series: tuple[str, ...] = ()
    limit: int | None = None


def _sum(dim: str, *columns: str, limit: int | None = None, series: tuple[str, ...] = ()) -> Chart:
    return Chart(tuple(("SUM", c) for c in columns), (dim,), series, limit)


def _avg(dim: str, column: str, limit: int) -> Chart:
    return Chart((("AVG", column),), (dim,), (), limit)


# Aggregate, columns and row limit of every chart that aggregates its dataset. The
# single figures show the one row of their dataset, the tables show all rows as they are.
CHARTS: dict[str, Chart] = {
    "teachers_by_type": _sum("teacher_type", "total_teachers"),
    "teachers_by_gender": _sum("gender", "total_teachers"),
    "teachers_by_discipline": _sum("discipline", "total_teachers"),
    "teachers_by_qualification": _sum("qualification", "total_teachers"),
    "teachers_by_designation": _sum("designation", "total_teachers"),
    "teachers_top15_districts": _sum("district_name", "total_teachers"),
    "teachers_bottom15_districts": _sum("district_name", "total_teachers"),
    "teachers_trend_over_time": _sum("period", "total_teachers"),
    "infra_by_completion_status": _sum("completion_status", "total_structures", limit=10),
    "infra_by_usage_mode": _sum("usage_mode", "total_structures", limit=10),
    "infra_by_structure_condition": _sum("structure_condition", "total_structures", limit=10),
    "infra_by_type": _sum("structure_type", "total_structures", limit=25),
    "infra_top15_districts": _sum("district_name", "total_structures", limit=15),
    "infra_labs_by_district": _sum("District", "Total Labs", limit=20),
    "nts_by_category": _sum("category", "total_staff", limit=50),
    "nts_by_gender": _sum("gender", "total_staff", limit=50),
    "nts_by_employment_status": _sum("employment_status", "total_staff", limit=50),
    "nts_by_role": _sum("role", "total_staff", limit=50),
    "nts_by_education_level": _sum("education_level", "total_staff", limit=50),
    "nts_top15_districts": _sum("district_name", "total_staff", limit=15),
    "nts_bottom15_districts": _sum("district_name", "total_staff", limit=15),
    "nts_trend_over_time": _sum("period", "total_staff", limit=50),
    "subjects_by_category": _sum("subject_category", "total_teachers", limit=10),
    "subjects_by_level": _sum("subject_level", "total_teachers", limit=10),
    "subjects_olevel_alevel_split": _sum("level_type", "total_teachers", limit=10),
    "subjects_top20_by_teachers": _sum("subject_name", "total_teachers", limit=20),
    "subjects_science_vs_arts_by_district": _sum("district_name", "science_teachers", "arts_teachers", limit=20),
    "subjects_lab_subjects": _sum("subject_name", "total_teachers", limit=20),
    "indicators_ptr_distribution": _sum("ptr_range", "schools", limit=10),
    "indicators_enrolment_by_level_gender": _sum("school_level", "total_enrolment", limit=50, series=("gender",)),
    "indicators_enrolment_trend": _sum("academic_year", "total_enrolment", limit=50, series=("school_level",)),
    "indicators_ptr_over_time": _avg("period", "avg_ptr", 50),
    "indicators_qualified_teacher_by_district": _avg("district_name", "avg_qualified_ratio", 20),
    "indicators_female_teachers_by_district": _avg("district_name", "avg_pct_female_teachers", 20),
    "indicators_kpi_total_enrolment": Chart((("SUM", "total_enrolment"),)),
    "indicators_kpi_avg_ptr": Chart((("MAX", "national_avg_ptr"),)),
}


def chart(t: Tables, name: str) -> DataFrame:
    """The rows behind one chart."""
    spec = CHARTS[name]
    return apply_metric(DATASETS[name](t), spec.dims, spec.metrics, spec.series, spec.limit)
