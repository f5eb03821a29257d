"""Enrolment mart: learner and enrolment extracts, flat rows, learner versions, fact."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.functions.calendar import academic_year, age_in_year, term_label, term_start
from censusmart.functions.labels import (
    enrolment_type, full_given_name, more_than_one, nationality, orphan_status, ownership, residence,
    school_level, sex_composition,
)
from censusmart.operators.asof import Role, version_or_earliest
from censusmart.operators.keys import first_per_key
from censusmart.operators.lookup import decode_ids, lookup
from censusmart.operators.scd2 import Versioned, scd2_merge
from censusmart.operators.shape import keyword_flags
from censusmart.plans.common import IDENTITY_KINDS, Tables, identity_numbers, on_calendar, people, place_of
from censusmart.plans.schools import admissions

NATURAL_KEY = ["learner_source_id", "school_source_id", "academic_year", "term"]

# Words in a disability's name that set each flag.
DISABILITY_WORDS = {
    "is_visual_yn": ["%VISUAL%"],
    "is_hearing_yn": ["%HEARING%"],
    "is_walking_yn": ["%WALK%", "%MOBIL%"],
    "is_self_care_yn": ["%SELF%CARE%", "%SELF_CARE%"],
    "is_remembering_yn": ["%REMEMBER%", "%CONCENTRAT%", "%COGNIT%"],
    "is_communication_yn": ["%COMMUNIC%"],
}

LEARNERS = Versioned(
    keys=["source_id"],
    tracked={
        "gender": "", "nationality": "", "nin": "", "orphan_status": "",
        **dict.fromkeys([*DISABILITY_WORDS, "has_multiple_disabilities_yn"], "false"),
    },
)


def extract_learners(t: Tables) -> DataFrame:
    """Learners not deleted, with personal data and their identity numbers by kind."""
    person = people(t).select(
        F.col("id").alias("_person"), "surname", "first_name", "other_names", "birth_date", "gender",
        "country",
    )
    kinds = list(IDENTITY_KINDS)
    ids = identity_numbers(t, kinds).withColumnRenamed("person_id", "_holder")
    joined = (
        t["src.learners"].filter(F.col("deleted_at").isNull())
        .join(person, F.col("person_id") == F.col("_person"))
        .join(ids, F.col("person_id") == F.col("_holder"), "left")
    )
    return joined.select(
        "person_id", "lin", "surname",
        full_given_name(F.col("first_name"), F.col("other_names")).alias("given_name"),
        F.col("birth_date").alias("date_of_birth"), "gender",
        nationality(F.col("country")).alias("nationality"), "district_of_birth_id",
        *kinds, "is_flagged_yn", "is_father_dead", "is_mother_dead", "deleted_at", "date_created",
        "date_updated",
    )


def extract_disabilities(t: Tables) -> DataFrame:
    named = lookup(
        t["src.learner_disabilities"], t["src.setting_disability_types"], "disability_type_id",
        {"name": "disability_type"}, how="inner",
    )
    return named.select(
        "id", "learner_id", "disability_type", F.lit(None).cast("string").alias("severity"),
        "date_created", "date_updated",
    )


def extract_enrolments(t: Tables) -> DataFrame:
    return t["src.learner_enrolments"].filter("is_enrolment_active_yn").select(
        "id", "learner_id", "school_id", "academic_year_id", "teaching_period_id",
        "reporting_status_id", F.col("promotion_status_id").alias("learner_promotion_status_id"),
        "enrolment_type_id", "is_enrolment_active_yn", "date_created", "date_updated",
    )


def extract_subtypes(t: Tables) -> DataFrame:
    """Grade, school level and language of every active enrolment."""
    grades = lookup(
        t["src.setting_education_grades"], t["src.setting_education_levels"], "education_level_id",
        {"name": "level_name", "school_type_id": "level_type_id"},
    )
    grades = lookup(grades, t["src.setting_school_types"], "level_type_id", {"name": "type_name"})
    named = decode_ids(
        t["src.learner_enrolments"].filter("is_enrolment_active_yn"),
        [
            (grades, "education_grade_id",
             {"name": "grade_name", "level_name": "level_name", "type_name": "type_name"}),
            (t["src.setting_familiar_languages"], "familiar_language_id", {"name": "language"}),
        ],
    )
    return named.select(
        F.col("id").alias("enrolment_id"),
        school_level(F.col("type_name"), F.col("level_name")).alias("school_level"),
        F.col("education_grade_id").alias("education_class_id"),
        F.col("grade_name").alias("education_class_name"),
        "familiar_language_id", F.col("language").alias("familiar_language_name"), "date_created",
    )


def _status_events(t: Tables, table: str) -> DataFrame:
    """Promotion-like records with their status name, one per enrolment (the earliest)."""
    named = lookup(
        t[table], t["src.setting_promotion_statuses"], "promotion_status_id", {"name": "status_name"}
    )
    order = [F.col("date_created").asc_nulls_last(), F.col("learner_id"), F.col("school_id")]
    return first_per_key(named, ["enrolment_id"], order)


def extract_promotions(t: Tables) -> DataFrame:
    return _status_events(t, "src.learner_promotions").select(
        F.col("enrolment_id").alias("id"), "learner_id", "school_id", "academic_year_id",
        F.col("education_grade_id").alias("from_class_id"),
        F.lit(None).cast("bigint").alias("to_class_id"), "promotion_status_id",
        F.col("status_name").alias("promotion_status_name"), "date_created", "date_updated",
    )


def extract_transitions(t: Tables) -> DataFrame:
    return _status_events(t, "src.learner_transitions").select(
        F.col("enrolment_id").alias("id"), "learner_id",
        F.lit(None).cast("bigint").alias("from_school_id"), F.col("school_id").alias("to_school_id"),
        "academic_year_id", F.col("promotion_status_id").alias("transition_status_id"),
        F.col("status_name").alias("transition_status_name"), "date_created", "date_updated",
    )


def _periods(t: Tables) -> DataFrame:
    return decode_ids(
        t["src.academic_year_teaching_periods"].select(
            F.col("id").alias("_period"), "academic_year_id", "teaching_period_id", "start_date"
        ),
        [
            (t["src.setting_academic_years"], "academic_year_id", {"name": "_year", "id": "_y"}),
            (t["src.setting_teaching_periods"], "teaching_period_id", {"name": "_term", "id": "_t"}),
        ],
    ).filter(F.col("_y").isNotNull() & F.col("_t").isNotNull()).select(
        "_period", academic_year(F.col("_year"), F.col("start_date")).alias("academic_year"),
        term_label(F.col("_term")).alias("term"),
    )


def _schools(t: Tables) -> DataFrame:
    s = decode_ids(
        t["src.schools"],
        [
            (t["src.setting_school_types"], "school_type_id", {"name": "type_name"}),
            (t["src.setting_ownership_statuses"], "school_ownership_status_id", {"name": "owner"}),
            (t["src.setting_funding_sources"], "funding_source_id", {"name": "funder"}),
        ],
    )
    kinds = ("pre_primary_schools", "primary_schools", "secondary_schools")
    s = s.join(admissions(t, kinds, "s"), F.col("id") == F.col("s_school"), "left")
    empty = F.lit("")
    return s.select(
        F.col("id").alias("_school"), F.col("emis_number").alias("school_emis_number"),
        F.col("name").alias("school_name"),
        ownership(F.col("owner"), F.col("is_government_owned_yn"), "PRIVATE").alias("school_ownership"),
        F.coalesce("funder", empty).alias("school_funding_type"),
        sex_composition(F.col("has_male_students"), F.col("has_female_students")).alias("school_sex_composition"),
        residence(F.col("s_day"), F.col("s_board")).alias("school_boarding_status"),
        F.coalesce("type_name", empty).alias("school_type"),
        place_of().alias("admin_unit_source_id"),
    )


def flatten_enrolments(t: Tables, as_of: date) -> DataFrame:
    """One wide row per active enrolment.

    The enrolments are shuffled twice, by enrolment id to meet their class and by learner; the
    extracts carry what the source tables would otherwise have to be joined for again.
    """
    classes = t["stg.enrolments_subtype_raw"].select(
        F.col("enrolment_id").alias("_class_of"), F.col("education_class_name").alias("grade"), "school_level"
    )
    flags = list(DISABILITY_WORDS)
    disabled = keyword_flags(
        t["stg.learner_disabilities_raw"], "learner_id", "disability_type", DISABILITY_WORDS
    ).withColumnRenamed("learner_id", "_disabled")
    learners = t["stg.learners_raw"].select(
        "person_id", "lin", "gender", "date_of_birth", "nationality", *IDENTITY_KINDS,
        "is_father_dead", "is_mother_dead",
    ).join(disabled, F.col("person_id") == F.col("_disabled"), "left")
    e = t["stg.enrolments_raw"].select(
        F.col("id").alias("enrolment_source_id"), F.col("learner_id").alias("learner_source_id"),
        F.col("school_id").alias("school_source_id"), "teaching_period_id",
        "enrolment_type_id", F.col("is_enrolment_active_yn").alias("is_active"),
    )
    wide = (
        e.join(classes, F.col("enrolment_source_id") == F.col("_class_of"), "left")
        .join(learners, F.col("learner_source_id") == F.col("person_id"))
        .join(_periods(t), F.col("teaching_period_id") == F.col("_period"))
        .join(_schools(t), F.col("school_source_id") == F.col("_school"))
    )
    wide = lookup(wide, t["src.setting_enrolment_types"], "enrolment_type_id", {"name": "type_name"})
    false = F.lit(False)
    return wide.select(
        "enrolment_source_id", "learner_source_id", "school_source_id", "academic_year", "term",
        "lin", "gender", age_in_year(as_of, F.col("date_of_birth")).alias("age"), "nationality",
        *IDENTITY_KINDS,
        orphan_status(F.col("is_father_dead"), F.col("is_mother_dead")).alias("orphan_status"),
        *[F.coalesce(f, false).alias(f) for f in flags],
        more_than_one([F.col(f) for f in flags]).alias("has_multiple_disabilities_yn"),
        "grade", "school_level", enrolment_type(F.col("type_name")).alias("enrolment_type"),
        "is_active", "school_emis_number", "school_name", "school_ownership", "school_funding_type",
        "school_sex_composition", "school_boarding_status", "school_type", "admin_unit_source_id",
    )


def stage_learners(flat: DataFrame) -> DataFrame:
    """One row per learner: the oldest stated age, then the newest enrolment."""
    newest = [F.col("age").desc_nulls_last(), F.col("enrolment_source_id").desc()]
    return first_per_key(flat, ["learner_source_id"], newest).withColumnsRenamed(
        {"learner_source_id": "source_id", "age": "age_at_load"}
    )


def merge_learners(t: Tables, as_of: date, compat: bool = False) -> DataFrame:
    spec = replace(LEARNERS, compat="initial") if compat else LEARNERS
    return scd2_merge(t["dw.learner_dim"], stage_learners(t["stg.enrolments_flat"]), spec, as_of)


def enrolment_fact(t: Tables) -> DataFrame:
    """Active enrolments with the surrogates valid at their term's start, or the earliest ones."""
    flat = t["stg.enrolments_flat"].filter("is_active").select(
        *NATURAL_KEY, "enrolment_source_id", "grade", "enrolment_type"
    )
    dated = flat.withColumn("term_start_date", term_start(F.col("academic_year"), F.col("term")))
    dated = on_calendar(dated, t["dw.date_dim"], "term_start_date")
    dated = lookup(dated, t["dw.grade_dim"], "grade", {"id": "grade_id"}, key="grade_code")
    dated = lookup(
        dated, t["dw.enrolment_type_dim"], "enrolment_type", {"id": "enrolment_type_id"},
        key="enrolment_type",
    )
    roles = [
        Role(t["dw.learner_dim"], "learner_source_id", "learner_id"),
        Role(t["dw.schools_dim"], "school_source_id", "school_id"),
    ]
    loaded = version_or_earliest(
        dated, roles, "term_start_date", NATURAL_KEY, [F.col("enrolment_source_id")]
    )
    return loaded.select(
        F.xxhash64(*NATURAL_KEY).alias("id"), "learner_id", "school_id", "grade_id", "date_id",
        "enrolment_type_id", *NATURAL_KEY[:2], "enrolment_source_id", *NATURAL_KEY[2:], "load_phase",
    )
