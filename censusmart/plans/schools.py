"""Schools mart: flatten, versions of schools and administrative units, daily snapshot."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.functions.labels import (
    INSTITUTION_RESIDENCE, SCHOOL_RESIDENCE, cut, ownership, residence, sex_composition,
)
from censusmart.operators.hierarchy import refreshed_ancestors
from censusmart.operators.keys import unique_or_null
from censusmart.operators.lookup import decode_ids, first_available, lookup
from censusmart.operators.scd2 import Versioned, scd2_merge
from censusmart.plans.common import Tables
from censusmart.sources.files import conform
from censusmart.sources.schemas import schema

# The tables that tell day and boarding admission, in the order they are consulted.
SCHOOL_KINDS = ("pre_primary_schools", "primary_schools", "secondary_schools", "international_schools")
INSTITUTION_KINDS = ("certificate_awarding_schools", "diploma_awarding_schools")
ADMISSION_FLAGS = {"day": "admits_day_scholars_yn", "board": "admits_boarders_yn"}

# Order in which a school's unit ids are tried.
UNIT_LEVELS = ("parish_id", "sub_county_id", "county_id", "district_id", "admin_unit_id")

TRACKED = (
    "name", "admin_unit_id", "emis_number", "school_type", "operational_status", "ownership_status",
    "funding_type", "sex_composition", "boarding_status", "founding_body_type",
)

# Reason text per changed column, in order of precedence.
REASONS = (
    ("name", "School renamed"),
    ("admin_unit_id", "Admin unit re-assignment or boundary update"),
    ("operational_status", "Operational status updated"),
    ("boarding_status", "Boarding status changed"),
    ("sex_composition", "Sex composition changed"),
    ("ownership_status", "Ownership status changed"),
    ("funding_type", "Funding type changed"),
    ("founding_body_type", "Founding body changed"),
)


def school_versions(compat: bool = False) -> Versioned:
    """``compat`` overlooks NULL ↔ value changes and lists only the columns that have a reason."""
    return Versioned(
        keys=["source_id"], tracked=dict.fromkeys(TRACKED, ""), reasons=REASONS,
        default_reason="Attribute update", first_fields="ALL",
        named=[c for c, _ in REASONS] if compat else None, compat="unsafe" if compat else None,
    )


ADMIN_UNITS = Versioned(
    keys=["source_id", "admin_unit_type"],
    tracked=dict.fromkeys(("name", "admin_unit_type", "admin_unit_code", "voting_code", "child_id"), ""),
    current_col="current_status", stored_hash=False, describe=False,
)

LOCATIONS = Versioned(
    keys=["school_id"],
    tracked=dict.fromkeys(
        ("physical_address", "postal_address", "admin_unit_id", "latitude", "longitude"), ""
    ),
    stored_hash=False, describe=False,
)


def _extract(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a source table; empty text is NULL, as in a CSV transfer."""
    rows = conform(df, schema(table))
    texts = [f.name for f in rows.schema.fields if f.dataType.typeName() == "string"]
    return rows.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def extract_schools(t: Tables) -> DataFrame:
    return _extract(t["src.schools"], "stg.schools_raw")


def extract_locations(t: Tables) -> DataFrame:
    return _extract(t["src.school_location_details"], "stg.school_location_details_raw")


def extract_admin_units(t: Tables) -> DataFrame:
    """The unit list as delivered; unit types are trimmed and written in title case."""
    rows = _extract(t["src.admin_units"], "stg.admin_units_raw")
    return rows.withColumn("admin_unit_type", F.initcap(F.trim("admin_unit_type")))


def admissions(t: Tables, kinds: tuple[str, ...], prefix: str) -> DataFrame:
    """Per school, the first known day and boarding flag over the kind tables, in their order.

    The kind tables are stacked and reduced in one aggregation instead of one join each.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [
            t[f"src.{kind}"].select("school_id", F.lit(i).alias("turn"), *ADMISSION_FLAGS.values())
            for i, kind in enumerate(kinds)
        ],
    )

    def first_known(flag: str) -> Column:
        return F.min(F.when(F.col(flag).isNotNull(), F.struct("turn", flag)))[flag]

    return stacked.groupBy(F.col("school_id").alias(f"{prefix}_school")).agg(
        *[first_known(flag).alias(f"{prefix}_{name}") for name, flag in ADMISSION_FLAGS.items()]
    )


def boarding_label() -> Column:
    school = residence(F.col("s_day"), F.col("s_board"), SCHOOL_RESIDENCE)
    institution = residence(F.col("i_day"), F.col("i_board"), INSTITUTION_RESIDENCE)
    return F.when(F.col("s_school").isNotNull(), school).when(F.col("i_school").isNotNull(), institution)


def flatten_schools(t: Tables, as_of: date) -> DataFrame:
    """One decoded row per school; schools that share an EMIS number are left out altogether."""
    raw = unique_or_null(t["stg.schools_raw"], "emis_number")
    units = t["dw.admin_units_dim"].filter("current_status")
    placed = first_available(raw, UNIT_LEVELS, units, "unit_dim_id", "source_id", "id", "effective_date")
    named = decode_ids(
        placed,
        [
            (t["src.setting_school_types"], "school_type_id",
             {"display_name": "type_display", "name": "type_name"}),
            (t["src.setting_operational_statuses"], "operational_status_id", {"name": "operating"}),
            (t["src.setting_ownership_statuses"], "school_ownership_status_id", {"name": "owner"}),
            (t["src.setting_founding_bodies"], "founding_body_id", {"name": "founder"}),
        ],
    )
    lodged = named.join(
        admissions(t, SCHOOL_KINDS, "s"), F.col("id") == F.col("s_school"), "left"
    ).join(admissions(t, INSTITUTION_KINDS, "i"), F.col("id") == F.col("i_school"), "left")
    return lodged.select(
        F.col("id").alias("source_id"),
        "name",
        F.col("unit_dim_id").alias("admin_unit_id"),
        "emis_number",
        cut(F.coalesce("type_display", "type_name"), 50).alias("school_type"),
        cut(F.col("operating"), 20).alias("operational_status"),
        cut(ownership(F.col("owner"), F.col("is_government_owned_yn"), None), 60).alias("ownership_status"),
        cut(F.col("funding_source_id").cast("string"), 20).alias("funding_type"),
        sex_composition(F.col("has_male_students"), F.col("has_female_students")).alias("sex_composition"),
        boarding_label().alias("boarding_status"),
        cut(F.col("founder"), 60).alias("founding_body_type"),
        F.lit(as_of).alias("effective_date"),
        F.lit(None).cast("date").alias("expiration_date"),
        F.lit(True).alias("is_current"),
        F.lit("PENDING_SCD2").alias("change_reason"),
    )


def placed_schools(flat: DataFrame, units: DataFrame) -> DataFrame:
    """Flat schools whose unit is a current one; only these are versioned."""
    live = units.filter("current_status").select(F.col("id").alias("admin_unit_id"))
    return flat.join(live, "admin_unit_id", "left_semi")


def rejected_schools(flat: DataFrame, units: DataFrame) -> DataFrame:
    """Flat schools without a current unit: they get no dimension row."""
    live = units.filter("current_status").select(F.col("id").alias("admin_unit_id"))
    return flat.join(live, "admin_unit_id", "left_anti")


def merge_schools(t: Tables, as_of: date, compat: bool = False) -> DataFrame:
    staged = placed_schools(t["stg.schools_flat"], t["dw.admin_units_dim"])
    return scd2_merge(t["dw.schools_dim"], staged, school_versions(compat), as_of)


def merge_admin_units(t: Tables, as_of: date) -> DataFrame:
    """Unit versions; the staged parent becomes ``child_id``, which names a unit's parent."""
    staged = t["stg.admin_units_raw"].withColumnRenamed("parent_id", "child_id").drop(
        "id", "effective_date", "expiration_date", "current_status"
    )
    return scd2_merge(t["dw.admin_units_dim"], staged, ADMIN_UNITS, as_of)


def unit_ancestors(t: Tables) -> DataFrame:
    """Every current unit with all units above it; unchanged units keep their rows."""
    return refreshed_ancestors(t["dw.unit_ancestor"], t["dw.admin_units_dim"])


def merge_locations(t: Tables, as_of: date) -> DataFrame:
    """Versions of the school addresses, from the current row of each school."""
    live = t["stg.school_location_details_raw"].filter("is_current")
    staged = live.drop("id", "effective_date", "expiration_date", "is_current")
    return scd2_merge(t["dw.school_location_details_dim"], staged, LOCATIONS, as_of)


def school_snapshot(t: Tables, as_of: date) -> DataFrame:
    """The current schools on the calendar day ``as_of``; empty if the calendar lacks that day."""
    day = t["dw.date_dim"].filter(F.col("system_date") == F.lit(as_of)).agg(F.max("id")).scalar()
    current = t["dw.schools_dim"].filter("is_current").select(F.col("id").alias("school_id"))
    return current.withColumn("date_id", day).filter("date_id is not null").withColumn(
        "id", F.xxhash64("school_id", "date_id")
    )


def on_day(t: Tables, day: date) -> DataFrame:
    """Snapshot rows of one day with their school version's columns."""
    days = t["dw.date_dim"].filter(F.col("system_date") == F.lit(day)).select(F.col("id").alias("date_id"))
    rows = t["dw.school_fact"].join(days, "date_id", "left_semi").select("school_id")
    dim = t["dw.schools_dim"].select(
        F.col("id").alias("school_id"), "operational_status", "sex_composition", "admin_unit_id"
    )
    return rows.join(dim, "school_id")


def by_operational_status(t: Tables, day: date) -> DataFrame:
    counted = on_day(t, day).groupBy("operational_status").agg(F.count(F.lit(1)).alias("school_count"))
    return counted.orderBy(F.col("school_count").desc(), F.col("operational_status").asc_nulls_last())


def by_district_and_sex(t: Tables, day: date, unit_type: str = "District") -> DataFrame:
    """Schools attached straight to a unit of ``unit_type``, by its name and the pupils' sex."""
    units = t["dw.admin_units_dim"].filter(
        F.col("current_status") & (F.upper("admin_unit_type") == unit_type.upper())
    )
    named = lookup(on_day(t, day), units, "admin_unit_id", {"name": "district"}, how="inner")
    counted = named.groupBy("district", "sex_composition").agg(F.count(F.lit(1)).alias("total"))
    return counted.orderBy("district", F.col("sex_composition").asc_nulls_last())
