"""Indicator mart: population, enrolment indicators by district, school indicators."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.functions.labels import FEMALE, MALE, any_of, gender_in, matches_any
from censusmart.functions.numbers import age_bands, is_false, rate_when, ratio
from censusmart.operators.asof import earliest_version
from censusmart.operators.hierarchy import reach
from censusmart.operators.lookup import lookup
from censusmart.operators.shape import parity, with_totals
from censusmart.operators.upsert import upsert
from censusmart.plans.common import Tables, dated_or_february, general_periods, on_calendar, period_dates
from censusmart.plans.enrolment import DISABILITY_WORDS
from censusmart.session import cut_lineage
from censusmart.sources.warehouse import Warehouse

FIRST_YEAR = 2022

POPULATION_KEY = ["district_id", "year", "sex"]
ENROLMENT_KEY = ["district_id", "school_level", "academic_year", "gender"]
SCHOOL_KEY = ["school_source_id", "academic_year", "term"]

# Columns a reload refreshes; the others keep what they had.
POPULATION_UPDATES = [
    "total_population", "pop_age_3_5", "pop_age_6_12", "pop_age_13_16", "pop_age_17_18", "pop_age_6",
]
ENROLMENT_UPDATES = [
    "total_enrolment", "official_age_enrolment", "new_entrants_p1", "repeaters",
    "learners_with_disability", "school_age_population", "ger", "ner", "gir", "repetition_rate",
    "sne_inclusion_rate",
]
SCHOOL_UPDATES = [
    "total_learners", "total_teachers", "ptr", "qualified_teacher_ratio", "trained_teacher_ratio",
    "pct_female_teachers", "gpi_ptr",
]
COUNTS = [
    "total_enrolment", "official_age_enrolment", "new_entrants_p1", "new_entrants_p1_official_age",
    "repeaters", "learners_with_disability",
]


def population_raw(t: Tables) -> DataFrame:
    """Stated district populations with estimated age bands and the district's source id by name."""
    stated = t["src.population"]
    bands = {b: F.when(F.col("total_population").isNotNull(), c)
             for b, c in age_bands(F.col("total_population")).items()}
    names = t["src.admin_unit_districts"].filter(is_false(F.col("is_archived_yn"))).groupBy(
        F.upper(F.trim("name")).alias("_name")
    ).agg(F.min("id").alias("district_source_id"))
    return stated.withColumns(bands).join(
        names, F.upper(F.trim("district_name")) == F.col("_name"), "left"
    ).drop("_name")


def population_fact(t: Tables) -> DataFrame:
    districts = t["dw.admin_units_dim"].filter(F.col("current_status") & (F.col("admin_unit_type") == "District"))
    known = lookup(t["stg.population_raw"], districts, "district_source_id", {"id": "district_id"},
                   key="source_id", how="inner")
    return known.select(
        F.xxhash64(*POPULATION_KEY).alias("id"), "district_id", "district_name", "year", "sex",
        *POPULATION_UPDATES, "data_source",
    )


def placed_schools(t: Tables) -> DataFrame:
    """Current schools with their level and each district that their unit reaches."""
    schools = t["dw.schools_dim"].filter("is_current").select(
        F.col("id").alias("school_id"), F.col("school_type").alias("school_level"),
        F.col("admin_unit_id").alias("unit_dim_id"),
    )
    return schools.join(reach(t["dw.unit_ancestor"]), "unit_dim_id").withColumnRenamed("district_dim_id", "district_id")


def changed_groups(t: Tables, changed: DataFrame) -> DataFrame:
    """(district, level, year) groups whose indicators a batch of enrolment facts can change.

    Rows of one school and year are one key before they meet the schools. A school without a level has no key in the indicator
    fact and belongs to no group.
    """
    keys = changed.filter(F.col("academic_year") >= FIRST_YEAR).select("school_id", "academic_year").distinct()
    return keys.join(placed_schools(t).filter("school_level is not null"), "school_id").select(*ENROLMENT_KEY[:3]).distinct()


def district_counts(t: Tables, groups: DataFrame | None = None) -> DataFrame:
    """Enrolment counts by district, school level, year and gender; with ``groups`` of these groups alone.

    The fact meets the learners once and is then reduced to one row per school, year and gender;
    only these counts go on to the schools and the (possibly repeating) district map. Of a partitioned fact, groups
    leave their years' partitions only (dynamic pruning), and of these the rows of their schools.
    """
    fact, schools = t["dw.enrolment_fact"].filter(F.col("academic_year") >= FIRST_YEAR), placed_schools(t)
    if groups is not None:
        asked = schools.join(groups, ["district_id", "school_level"])
        fact = fact.join(asked.select("school_id", "academic_year").distinct(), ["school_id", "academic_year"], "left_semi")
    grades = t["dw.grade_dim"].select(
        F.col("id").alias("grade_id"),
        (matches_any(F.col("grade_name"), ["%P1%", "%BABY%"]) | (F.upper("grade_code") == "P1")).alias("_first"),
    )
    types = t["dw.enrolment_type_dim"].select(
        F.col("id").alias("enrolment_type_id"), F.upper("enrolment_type").isin("BASELINE", "NEW").alias("_new")
    )
    learners = t["dw.learner_dim"].filter(F.col("is_current") & F.col("gender").isNotNull()).select(
        F.col("id").alias("learner_id"), "gender", any_of([F.col(c) for c in DISABILITY_WORDS]).alias("_disabled")
    )
    rows = (
        fact.select("learner_id", "school_id", "grade_id", "enrolment_type_id", "academic_year")
        .join(learners, "learner_id")
        .join(grades, "grade_id", "left")
        .join(types, "enrolment_type_id", "left")
    )
    per_school = rows.groupBy("school_id", "academic_year", "gender").agg(
        F.count(F.lit(1)).alias("total_enrolment"),
        F.count_if(F.col("_first") & F.col("_new")).alias("new_entrants_p1"),
        F.count_if("_disabled").alias("learners_with_disability"),
    )
    placed = per_school.join(schools, "school_id")
    if groups is not None:
        # A school in several districts may have changed one of them only.
        placed = placed.join(groups, ENROLMENT_KEY[:3], "left_semi")
    zero = F.lit(0).cast("bigint")
    counted = placed.groupBy(
        "district_id", "district_name", "school_level", "academic_year", "gender"
    ).agg(*[F.sum(c).alias(c) for c in ("total_enrolment", "new_entrants_p1", "learners_with_disability")])
    return counted.withColumns(
        {c: zero for c in ("official_age_enrolment", "new_entrants_p1_official_age", "repeaters")}
    )


def school_age_band(level: Column, population: str = "") -> Column:
    """The population that a school level serves; levels of no known kind have none."""
    pre_primary = level.ilike("%PRE%PRIMARY%")
    primary = level.ilike("%PRIMARY%") & ~level.ilike("%PRE%")
    secondary = level.ilike("%SECONDARY%")
    return (
        F.when(pre_primary, F.col(f"{population}pop_age_3_5"))
        .when(primary, F.col(f"{population}pop_age_6_12"))
        .when(secondary, F.col(f"{population}pop_age_13_16") + F.col(f"{population}pop_age_17_18"))
    )


def enrolment_indicators(t: Tables, groups: DataFrame | None = None) -> DataFrame:
    """Counts per gender and in total, their population denominators, and the rates; with ``groups`` of these alone."""
    keys = ["district_id", "district_name", "school_level", "academic_year"]
    known = gender_in(F.col("gender"), MALE + FEMALE)
    counted = with_totals(district_counts(t, groups), keys, COUNTS, "gender", "TOTAL", known)
    sex = (
        F.when(gender_in(F.col("gender"), MALE), "M")
        .when(gender_in(F.col("gender"), FEMALE), "F")
        .otherwise("TOTAL")
    )
    people = t["dw.population_fact"].select(
        F.col("district_id").alias("_district"), F.col("year").alias("_year"), F.upper("sex").alias("_sex"),
        *POPULATION_UPDATES[1:],
    )
    rows = counted.withColumn("_for", sex).join(
        people,
        (F.col("district_id") == F.col("_district")) & (F.col("academic_year") == F.col("_year"))
        & (F.col("_for") == F.col("_sex")),
        "left",
    )
    level = F.col("school_level")
    rows = rows.withColumn("school_age_population", school_age_band(level)).withColumn(
        "population_age_6", F.col("pop_age_6")
    )
    primary = level.ilike("%PRIMARY%") & ~level.ilike("%PRE%")
    total, age6, served = (F.col(c) for c in ("total_enrolment", "population_age_6", "school_age_population"))
    rates = {
        "ger": rate_when(served > 0, total, served, 2),
        "ner": F.lit(None),
        "gir": rate_when(primary & (age6 > 0), F.col("new_entrants_p1"), age6, 2),
        "repetition_rate": rate_when(total > 0, F.col("repeaters"), total, 2),
        "sne_inclusion_rate": rate_when(total > 0, F.col("learners_with_disability"), total, 2),
    }
    return rows.select(
        *keys, "gender", *COUNTS, "school_age_population", "population_age_6",
        *[c.cast("decimal(8,2)").alias(n) for n, c in rates.items()],
    )


def term_one_dates(t: Tables) -> DataFrame:
    """Per academic year, the calendar row of the first day of term 1."""
    first = general_periods(t).filter(F.col("period_name") == "1")
    dated = on_calendar(first, t["dw.date_dim"], "term_start_date")
    return dated.groupBy("academic_year").agg(F.min_by("date_id", "term_start_date").alias("date_id"))


def enrolment_indicator_rows(t: Tables) -> DataFrame:
    """Indicator rows as the fact takes them."""
    staged = t["stg.enrolment_indicator_raw"].filter(F.col("district_id").isNotNull())
    dated = dated_or_february(staged, t, term_one_dates(t), ["academic_year"])
    unset = F.lit(None)
    return dated.select(
        F.xxhash64(*ENROLMENT_KEY).alias("id"), "district_id", "date_id", *ENROLMENT_KEY[1:], *COUNTS,
        "school_age_population", "population_age_6", "ger", "ner", "gir",
        unset.cast("decimal(8,2)").alias("nir"), unset.cast("decimal(8,4)").alias("gpi_ger"),
        unset.cast("decimal(8,4)").alias("gpi_ner"), "repetition_rate", "sne_inclusion_rate",
    )


def with_parity(fact: DataFrame) -> DataFrame:
    """Gender parity (female over male rate) on the TOTAL rows."""
    return parity(
        fact, ENROLMENT_KEY[:3], "gender", {"gpi_ger": "ger", "gpi_ner": "ner"}, FEMALE, MALE
    )


def enrolment_indicator_fact(t: Tables) -> DataFrame:
    """The fact after loading the staged indicators."""
    loaded = upsert(
        t["dw.enrolment_indicator_fact"], enrolment_indicator_rows(t), ENROLMENT_KEY, ENROLMENT_UPDATES
    )
    return with_parity(loaded)


def refreshed_groups(t: Tables, changed: DataFrame) -> DataFrame:
    """The fact's rows of the groups that a batch of enrolment facts changes, as they are after it.

    Groups are carried through counts, totals and parity, and only they are computed; the fact already holds the batch. A row whose
    learners are all gone keeps its values, as in a full reload.
    """
    groups = cut_lineage(changed_groups(t, changed))
    staged = {"stg.enrolment_indicator_raw": enrolment_indicators(t, groups)}
    rows = enrolment_indicator_rows(ChainMap(staged, t))
    old = t["dw.enrolment_indicator_fact"].join(groups, ENROLMENT_KEY[:3], "left_semi").select(t["dw.enrolment_indicator_fact"].columns)
    return with_parity(upsert(old, rows, ENROLMENT_KEY, ENROLMENT_UPDATES))


def load_changed_groups(t: Tables, changed: DataFrame, store: Warehouse) -> DataFrame:
    """Refresh the stored indicators after a batch: only the years of changed groups get new files."""
    rows = refreshed_groups(t, changed).withColumn("load_time", F.current_timestamp())
    return store.load_upsert("dw.enrolment_indicator_fact", rows, ENROLMENT_KEY, [*ENROLMENT_UPDATES, "gpi_ger", "gpi_ner", "load_time"], "academic_year")


def learner_counts(t: Tables) -> DataFrame:
    learners = t["dw.learner_dim"].filter("is_current").select(F.col("id").alias("learner_id"), "gender")
    rows = t["dw.enrolment_fact"].filter(F.col("academic_year") >= FIRST_YEAR).join(learners, "learner_id")
    return rows.groupBy("school_source_id", "academic_year").agg(
        F.count(F.lit(1)).alias("total_learners"),
        F.count_if(gender_in(F.col("gender"), MALE)).alias("male_learners"),
        F.count_if(gender_in(F.col("gender"), FEMALE)).alias("female_learners"),
    )


def teacher_counts(t: Tables) -> DataFrame:
    teachers = t["dw.teacher_dim"].filter("is_current").select(
        F.col("id").alias("teacher_id"), "gender", F.upper("teacher_type").alias("kind")
    )
    rows = t["dw.hr_fact"].filter(F.col("academic_year") >= FIRST_YEAR).join(teachers, "teacher_id")
    return rows.groupBy(*SCHOOL_KEY).agg(
        F.count(F.lit(1)).alias("total_teachers"),
        F.count_if(gender_in(F.col("gender"), MALE)).alias("male_teachers"),
        F.count_if(gender_in(F.col("gender"), FEMALE)).alias("female_teachers"),
        F.count_if(F.col("kind") == "QUALIFIED").alias("qualified_teachers"),
        F.count_if(F.col("kind").isin("QUALIFIED", "TRAINED")).alias("trained_teachers"),
    )


def school_indicators(t: Tables) -> DataFrame:
    """Teacher and learner counts and ratios per school, year and term.

    Both facts are reduced to counts before they meet. A unit that climbs to several districts
    keeps the lowest, so a school has one row per term.
    """
    schools = t["dw.schools_dim"].filter("is_current").select(
        F.col("source_id").alias("_school"), F.col("name").alias("school_name"), "school_type", "admin_unit_id"
    )
    districts = reach(t["dw.unit_ancestor"]).groupBy("unit_dim_id").agg(
        F.min("district_dim_id").alias("district_dim_id")
    )
    placed = (
        teacher_counts(t)
        .join(learner_counts(t), SCHOOL_KEY[:2], "left")
        .join(schools, F.col("school_source_id") == F.col("_school"), "left")
        .join(districts, F.col("admin_unit_id") == F.col("unit_dim_id"), "left")
    )
    learners = ["total_learners", "male_learners", "female_learners"]
    placed = placed.fillna(0, subset=learners)
    tt, mt, ft, ml, fl, tl = (
        F.col(c) for c in ("total_teachers", "male_teachers", "female_teachers", "male_learners",
                           "female_learners", "total_learners")
    )
    return placed.select(
        "school_source_id", "school_name", "school_type",
        F.coalesce("district_dim_id", "admin_unit_id").alias("district_id"), "academic_year", "term",
        *learners, "total_teachers", "male_teachers", "female_teachers", "qualified_teachers",
        "trained_teachers",
        ratio(tl, tt, 2).cast("decimal(8,2)").alias("ptr"),
        ratio(F.col("qualified_teachers"), tt, 2, 100).cast("decimal(8,2)").alias("qualified_teacher_ratio"),
        ratio(F.col("trained_teachers"), tt, 2, 100).cast("decimal(8,2)").alias("trained_teacher_ratio"),
        ratio(ft, tt, 2, 100).cast("decimal(8,2)").alias("pct_female_teachers"),
        # (female learners / female teachers) / (male learners / male teachers), in one division
        rate_when((mt > 0) & (ft > 0), fl * mt, ft * ml, 4, factor=1).cast("decimal(8,4)").alias("gpi_ptr"),
    )


def school_indicator_rows(t: Tables) -> DataFrame:
    staged = t["stg.school_indicator_raw"].filter(F.col("school_source_id").isNotNull())
    known = lookup(staged, earliest_version(t["dw.schools_dim"]), "school_source_id", {"id": "school_id"},
                   key="source_id", how="inner")
    dated = dated_or_february(known, t, period_dates(t), ["academic_year", "term"])
    return dated.select(
        F.xxhash64(*SCHOOL_KEY).alias("id"), "school_id", "date_id", *SCHOOL_KEY, "total_learners",
        "male_learners", "female_learners", "total_teachers", "male_teachers", "female_teachers",
        "qualified_teachers", "trained_teachers", "ptr", "qualified_teacher_ratio", "trained_teacher_ratio",
        "pct_female_teachers", "gpi_ptr",
    )
