"""Pieces that several marts share."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.functions.calendar import academic_year, term_label
from censusmart.functions.labels import ownership
from censusmart.operators.keys import first_per_key
from censusmart.operators.lookup import decode_ids, lookup
from censusmart.operators.shape import pivot_max
from censusmart.functions.labels import matches_any

Tables = Mapping[str, DataFrame]

# Words that tell an identity document's kind by its type name.
IDENTITY_KINDS = {
    "nin": ["%NATIONAL%", "%NIN%"],
    "passport_no": ["%PASSPORT%"],
    "student_pass_no": ["%STUDENT%PASS%"],
    "work_permit_no": ["%WORK%PERMIT%"],
    "refugee_id": ["%REFUGEE%"],
}


def place_of(prefix: str = "") -> Column:
    """A school's most precise administrative unit."""
    levels = ("parish_id", "sub_county_id", "county_id", "district_id", "region_id")
    return F.coalesce(*[F.col(prefix + c) for c in levels])


def identity_numbers(t: Tables, kinds: list[str]) -> DataFrame:
    """Per person, the highest document number of each kind."""
    docs = lookup(
        t["src.identity_documents"], t["src.setting_identity_document_types"],
        "identity_type_id", {"name": "_kind"},
    )
    picks = {k: (matches_any(F.col("_kind"), IDENTITY_KINDS[k]), F.col("document_id")) for k in kinds}
    return pivot_max(docs, ["person_id"], picks)


def people(t: Tables) -> DataFrame:
    """Persons with the name of their country."""
    return lookup(t["src.persons"], t["src.admin_unit_countries"], "country_id", {"name": "country"})


def school_facts(t: Tables) -> DataFrame:
    """Per school: the descriptive columns that person marts copy onto their rows."""
    named = decode_ids(
        t["src.schools"],
        [
            (t["src.setting_school_types"], "school_type_id", {"name": "type_name"}),
            (t["src.setting_ownership_statuses"], "school_ownership_status_id", {"name": "owner_name"}),
        ],
    )
    return named.select(
        F.col("id").alias("_school"),
        F.col("emis_number").alias("school_emis_number"),
        F.col("name").alias("school_name"),
        F.col("type_name").alias("school_type"),
        ownership(F.col("owner_name"), F.col("is_government_owned_yn"), "PRIVATE").alias("school_ownership"),
        F.col("school_type_id").alias("_school_type_id"),
        place_of().alias("admin_unit_source_id"),
    )


def active_periods(t: Tables) -> DataFrame:
    """Active teaching periods with their academic year and term label."""
    named = decode_ids(
        t["src.academic_year_teaching_periods"].filter(F.col("status") == "active"),
        [
            (t["src.setting_academic_years"], "academic_year_id", {"name": "_year", "id": "_year_id"}),
            (t["src.setting_teaching_periods"], "teaching_period_id", {"name": "_term", "id": "_term_id"}),
        ],
    ).filter(F.col("_year_id").isNotNull() & F.col("_term_id").isNotNull())
    return named.select(
        "academic_year_id", "teaching_period_id", "school_id", "school_type_id",
        academic_year(F.col("_year"), F.col("start_date")).alias("academic_year"),
        term_label(F.col("_term")).alias("term"),
        F.col("_term").alias("period_name"),
        F.col("start_date").alias("term_start_date"),
    )


def general_periods(t: Tables) -> DataFrame:
    """One period per academic year and term, of those that apply to every school.

    The source repeats a period for each school type; the lowest type stands for all.
    """
    return first_per_key(
        active_periods(t).filter(F.col("school_id").isNull()), ["academic_year", "term"],
        [F.col("school_type_id").asc_nulls_last(), F.col("term_start_date").asc_nulls_last()],
    )


def all_periods(t: Tables) -> DataFrame:
    """General periods plus the school-specific ones that no general period already covers."""
    general = general_periods(t)
    own = active_periods(t).filter(F.col("school_id").isNotNull())
    own = first_per_key(
        own.join(general.select("academic_year", "term"), ["academic_year", "term"], "left_anti"),
        ["school_id", "academic_year", "term"],
        [F.col("school_type_id").asc_nulls_last(), F.col("term_start_date").asc_nulls_last()],
    )
    keep = ["academic_year", "term", "term_start_date", "school_id"]
    return general.select(keep).unionByName(own.select(keep))


def on_calendar(df: DataFrame, calendar: DataFrame, day: str, how: str = "inner") -> DataFrame:
    """Attach ``date_id`` of the calendar row; an inner join drops days outside the calendar."""
    return lookup(df, calendar, day, {"id": "date_id"}, key="system_date", how=how)


def period_dates(t: Tables) -> DataFrame:
    """``(academic_year, term, date_id)`` of the general periods that begin on a calendar day."""
    return on_calendar(general_periods(t), t["dw.date_dim"], "term_start_date").select(
        "academic_year", "term", "date_id"
    )


def dated_or_february(df: DataFrame, t: Tables, dates: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the period's ``date_id``, else that of the first of February of the row's year."""
    own = df.join(dates.withColumnRenamed("date_id", "_period_date"), keys, "left")
    own = own.withColumn("_feb", F.make_date("academic_year", F.lit(2), F.lit(1)))
    return on_calendar(own, t["dw.date_dim"], "_feb", "left").withColumn(
        "date_id", F.coalesce("_period_date", "date_id")
    ).drop("_feb", "_period_date")


def current_ids(dim: DataFrame, as_name: str, current_col: str = "is_current") -> DataFrame:
    """``(source_id, as_name)`` of the current versions, one per source id."""
    return dim.filter(current_col).groupBy(F.col("source_id").alias("_source")).agg(
        F.min("id").alias(as_name)
    )
