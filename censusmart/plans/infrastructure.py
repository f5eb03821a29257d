"""Infrastructure mart: building types, decoded status records, fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.functions import labels
from censusmart.functions.calendar import academic_year, term_label
from censusmart.functions.labels import decode
from censusmart.functions.numbers import guarded_area, is_false
from censusmart.operators.keys import first_per_key
from censusmart.operators.lookup import decode_ids, lookup
from censusmart.operators.upsert import upsert
from censusmart.plans.common import Tables, current_ids, dated_or_february, period_dates, school_facts

NATURAL_KEY = ["school_source_id", "building_source_id", "academic_year", "term"]

TYPE_FLAGS = ("is_lab_yn", "is_sanitation_yn", "is_area_captured_yn", "gender_usage_yn", "user_category_yn")
LEVEL_FLAGS = ("is_for_pre_primary", "is_for_primary", "is_for_secondary")

# Columns a reload refreshes; the others keep what they had.
TYPE_UPDATES = ["type_name", "item_category", "is_lab_yn", "is_sanitation_yn", "is_active_yn"]
FACT_UPDATES = [
    "total_number", "area", "completion_status", "usage_mode", "structure_condition", "gender_usage",
    "user_category",
]
STATUS_CODES = {
    "completion_status": ("completion_status", labels.COMPLETION),
    "usage_mode": ("usage_mode", labels.USAGE_MODE),
    "condition": ("structure_condition", labels.CONDITION),
    "gender_usage": ("gender_usage", labels.GENDER_USAGE),
    "user_category": ("user_category", labels.USER_CATEGORY),
}


def _building_types(t: Tables, flags: tuple[str, ...]) -> DataFrame:
    """Building types with their category and, where an infrastructure type shares the id, its flags."""
    kinds = t["src.setting_school_infrastructure_types"]
    return decode_ids(
        t["src.setting_school_building_types"],
        [
            (t["src.setting_school_item_categories"], "item_category_id", {"name": "item_category"}),
            (kinds, "id", {"id": "kind_id", "name": "kind_name", **{f: f"kind_{f}" for f in flags}}),
        ],
    )


def building_types(t: Tables) -> DataFrame:
    """The building types in use as rows of the type dimension."""
    flags = TYPE_FLAGS + LEVEL_FLAGS
    used = _building_types(t, flags).filter(
        F.col("deleted_at").isNull() & is_false(F.col("is_archived_yn"))
    )
    return used.select(
        F.xxhash64("id").alias("id"), F.col("id").alias("source_id"), F.col("name").alias("type_name"),
        "item_category", *[F.coalesce(f"kind_{f}", F.lit(False)).alias(f) for f in flags],
        F.coalesce("is_active_yn", F.lit(True)).alias("is_active_yn"),
    )


def merge_types(t: Tables) -> DataFrame:
    return upsert(t["dw.infrastructure_type_dim"], building_types(t), ["source_id"], TYPE_UPDATES)


def extract_buildings(t: Tables) -> DataFrame:
    """Building status records with decoded codes, period and school."""
    updates = t["src.school_building_status_updates"]
    types = _building_types(t, TYPE_FLAGS).select(
        F.col("id").alias("_type"), F.col("name").alias("building_name"), "item_category"
    )
    kinds = t["src.setting_school_infrastructure_types"].select(
        F.col("id").alias("infrastructure_type_id"), F.col("name").alias("infrastructure_type_name"), *[
            F.col(f).alias(f"kind_{f}") for f in TYPE_FLAGS]
    )
    placed = (
        updates.join(
            school_facts(t).select("_school", "school_name", "school_type", "admin_unit_source_id"),
            F.col("school_id") == F.col("_school"),
        )
        .join(types, F.col("building_id") == F.col("_type"), "left")
        .join(kinds, F.col("building_id") == F.col("infrastructure_type_id"), "left")
    )
    placed = decode_ids(
        placed,
        [
            (t["src.setting_academic_years"], "academic_year_id", {"name": "_year"}),
            (t["src.setting_teaching_periods"], "teaching_period_id", {"name": "_term"}),
        ],
    )
    return placed.select(
        F.col("id").alias("building_status_id"), "school_id", "school_name", "school_type",
        "admin_unit_source_id", "building_id", "building_name", "item_category",
        "infrastructure_type_id", "infrastructure_type_name",
        *[F.coalesce(f"kind_{f}", F.lit(False)).alias(f) for f in TYPE_FLAGS],
        academic_year(F.col("_year"), F.col("date_created")).alias("academic_year"),
        term_label(F.col("_term")).alias("term"),
        "total_number", guarded_area(F.col("area")).alias("area"),
        *[decode(F.col(code), mapping).alias(name) for code, (name, mapping) in STATUS_CODES.items()],
        "date_created", "date_updated",
    )


def infrastructure_fact(t: Tables) -> DataFrame:
    """The newest record per school, building and term, at the current school version."""
    staged = t["stg.infrastructure_raw"].filter(
        F.col("school_id").isNotNull() & F.col("building_id").isNotNull() & F.col("academic_year").isNotNull()
    )
    rows = staged.select(
        F.col("school_id").alias("school_source_id"), F.col("building_id").alias("building_source_id"),
        "academic_year", "term", "building_status_id", *FACT_UPDATES,
    )
    newest = first_per_key(rows, NATURAL_KEY, [F.col("building_status_id").desc()])
    known = newest.join(
        current_ids(t["dw.schools_dim"], "school_id"), F.col("school_source_id") == F.col("_source")
    ).drop("_source")
    known = lookup(known, t["dw.infrastructure_type_dim"], "building_source_id", {"id": "infra_type_id"},
                   key="source_id", how="inner")
    dated = dated_or_february(known, t, period_dates(t), ["academic_year", "term"])
    return dated.select(
        F.xxhash64(*NATURAL_KEY).alias("id"), "school_id", "infra_type_id", "date_id", *NATURAL_KEY, *FACT_UPDATES
    )
