"""Registered queries against their SQL in DuckDB (``tools/compare.py`` runs all of them)."""

import duckdb
import pytest

import __spark_entry__ as registry
from tests.conftest import SF
from tools.compare import TABLES, normal
from workload import QUERIES, SQL

FAMILIES = [
    "scd2_change_reason", "asof_fallback_fact", "latest_before", "upsert_partial", "unique_or_null_key", "units_with_several_districts",
    "period_expand", "gender_parity", "ptr_fanout", "json_row_copy", "schools_flatten", "enrolment_fact", "deployments_extract",
    "teaching_flatten", "transfer_fact", "enrolment_indicator_upsert", "school_indicators", "seed_staff_roles",
    "teachers_district_leaderboard", "indicators_gpi_by_district", "subjects_olevel_alevel_split",
    "chart_indicators_enrolment_by_level_gender", "dq_infrastructure", "dq_supplementary",
    "distinct_rollup", "teachers_ptr_by_district", "subjects_by_category",
]


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return db


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", FAMILIES)
def test_equals_sql(spark, duck, name):
    spark_rows = normal(registry.queries()[name](spark, SF).toPandas())
    assert spark_rows == normal(duck.sql(registry.oracle_sql()[name]).df())
    assert spark_rows[1]


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["operational_status", "school_count"] and result.count() > 0
