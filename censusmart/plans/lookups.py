"""Lookup dimensions: fixed lists and those seeded from the source's setting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusmart.functions.numbers import is_false
from censusmart.operators.keys import first_per_key
from censusmart.operators.lookup import lookup
from censusmart.operators.upsert import insert_absent, upsert
from censusmart.plans.common import Tables

# Grades in school order, (code, name, level).
GRADES = [
    ("BC", "Baby Class", "PRE_PRIMARY"), ("MK", "Middle Class", "PRE_PRIMARY"), ("TK", "Top Class", "PRE_PRIMARY"),
    ("P1", "Primary One", "PRIMARY"), ("P2", "Primary Two", "PRIMARY"), ("P3", "Primary Three", "PRIMARY"),
    ("P4", "Primary Four", "PRIMARY"), ("P5", "Primary Five", "PRIMARY"), ("P6", "Primary Six", "PRIMARY"),
    ("P7", "Primary Seven", "PRIMARY"),
    ("S1", "Senior One", "SECONDARY"), ("S2", "Senior Two", "SECONDARY"), ("S3", "Senior Three", "SECONDARY"),
    ("S4", "Senior Four", "SECONDARY"), ("S5", "Senior Five", "SECONDARY"), ("S6", "Senior Six", "SECONDARY"),
    ("Y1", "Year One", "TERTIARY"), ("Y2", "Year Two", "TERTIARY"), ("Y3", "Year Three", "TERTIARY"),
    ("Y4", "Year Four", "TERTIARY"),
]

# Enrolment types, (source id, type, description).
ENROLMENT_TYPES = [
    (1, "BASELINE", "Learner enrolled at the time of the baseline census"),
    (2, "NEW", "New learner enrolling for the first time at this school"),
    (3, "CONTINUING", "Learner continuing from the previous term or year"),
    (4, "TRANSFER", "Learner who transferred from another school"),
]

# Orphan states, (state, description).
ORPHAN_TYPES = [
    ("MOTHER DECEASED", "Learner has lost their mother"),
    ("FATHER DECEASED", "Learner has lost their father"),
    ("BOTH DECEASED", "Learner has lost both parents (double orphan)"),
    ("NOT APPLICABLE", "Both parents are living"),
]

# Disability kinds, (code, name, description).
DISABILITY_TYPES = [
    ("VISUAL", "Visual Impairment", "Difficulty or inability to see"),
    ("HEARING", "Hearing Impairment", "Difficulty or inability to hear"),
    ("WALKING", "Mobility Difficulty", "Difficulty walking or climbing stairs"),
    ("SELF_CARE", "Self-care Difficulty", "Difficulty washing, dressing, or feeding oneself"),
    ("REMEMBERING", "Cognitive Difficulty", "Difficulty remembering, concentrating, or communicating"),
    ("COMMUNICATION", "Communication Difficulty", "Difficulty communicating using usual language"),
]

POPULATION_YEAR = 2025

# Stated population per district in that year, (district, male, female).
POPULATION = [
    ("KAMPALA CITY", 1020940, 810220), ("Kalangala", 48260, 31180), ("Kiboga", 99760, 91780),
    ("Luweero", 312700, 342310), ("Masaka", 60530, 61890), ("Mpigi", 159340, 187050),
    ("Mubende", 265210, 286110), ("Mukono", 483590, 510920), ("Nakasongola", 122970, 119530),
    ("Rakai", 197140, 154420), ("Ssembabule", 165090, 156780), ("Kayunga", 219560, 242140),
    ("Wakiso", 1977220, 1720380), ("Lyantonde", 75430, 63440), ("Mityana", 209010, 223250),
    ("Nakaseke", 132260, 132390), ("Buikwe", 260820, 285930), ("Bukomansimbi", 94480, 112280),
    ("Butambala", 80280, 68930), ("Buvuma", 62810, 56710), ("Gomba", 104520, 108300),
    ("Kalungu", 108920, 127520), ("Kyankwanzi", 145020, 154920), ("Lwengo", 148940, 197460),
    ("Kyotera", 136740, 148920), ("Kassanda", 164530, 172740), ("Masaka City", 165380, 150370),
]


def stated_population(spark: SparkSession) -> DataFrame:
    """Rows for men, women and both per district: a source table for the population load."""
    stated = spark.createDataFrame(POPULATION, "district_name string, m bigint, f bigint")
    sexes = F.array(*[
        F.struct(F.lit(sex).alias("sex"), total.alias("total_population"))
        for sex, total in (("M", F.col("m")), ("F", F.col("f")), ("TOTAL", F.col("m") + F.col("f")))
    ])
    return stated.select(
        "district_name", F.lit(POPULATION_YEAR).alias("year"), F.inline(sexes),
    ).withColumn("data_source", F.lit(None).cast("string"))


def grade_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, *g, i) for i, g in enumerate(GRADES, 1)]
    return spark.createDataFrame(
        rows, "id bigint, grade_code string, grade_name string, school_level string, sort_order int"
    )


def enrolment_type_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, *e) for i, e in enumerate(ENROLMENT_TYPES, 1)]
    return spark.createDataFrame(rows, "id bigint, source_id bigint, enrolment_type string, description string")


def orphan_type_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, *o) for i, o in enumerate(ORPHAN_TYPES, 1)]
    return spark.createDataFrame(rows, "id bigint, orphan_status string, description string")


def disability_type_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, *d) for i, d in enumerate(DISABILITY_TYPES, 1)]
    return spark.createDataFrame(
        rows, "id bigint, disability_code string, disability_name string, description string"
    )


def _by_name(df: DataFrame, name: str, newest: bool) -> DataFrame:
    """One row per name. An updating seed ends with the highest source id, the other keeps the lowest."""
    order = F.col("source_id").desc() if newest else F.col("source_id").asc()
    return first_per_key(df, [name], [order]).withColumn("id", F.xxhash64(name))


def teacher_types(t: Tables) -> DataFrame:
    rows = t["src.setting_teacher_types"].select(F.col("id").alias("source_id"), F.col("name").alias("teacher_type"))
    return upsert(t["dw.teacher_type_dim"], _by_name(rows, "teacher_type", True), ["teacher_type"], ["source_id"])


def qualifications(t: Tables) -> DataFrame:
    levels = [f"is_for_{x}" for x in ("pre_primary", "primary", "secondary", "certificate", "diploma", "degree")]
    rows = t["src.setting_teacher_professional_qualifications"].filter(is_false(F.col("is_archived"))).select(
        F.col("id").alias("source_id"), F.col("name").alias("qualification_name"), "qualification_category", *levels
    )
    return upsert(
        t["dw.qualification_dim"], _by_name(rows, "qualification_name", True), ["qualification_name"],
        ["source_id", "qualification_category"],
    )


def designations(t: Tables) -> DataFrame:
    named = lookup(
        t["src.setting_teaching_staff_designations"], t["src.setting_school_types"], "school_type_id",
        {"name": "school_type"},
    )
    rows = named.select(F.col("id").alias("source_id"), F.col("name").alias("designation"), "school_type")
    return upsert(t["dw.designation_dim"], _by_name(rows, "designation", True), ["designation"], ["source_id"])


def staff_categories(t: Tables) -> DataFrame:
    rows = t["src.setting_non_teaching_staff_categories"].select(
        F.col("id").alias("source_id"), F.col("name").alias("category_name")
    )
    return insert_absent(t["dw.staff_category_dim"], _by_name(rows, "category_name", False), ["category_name"])


def staff_roles(t: Tables) -> DataFrame:
    """Roles with the name and id of their category."""
    rows = t["src.setting_non_teaching_staff_roles"].select(
        F.col("id").alias("source_id"), F.col("name").alias("role_name"), "non_teaching_staff_category_id"
    )
    one = _by_name(rows, "role_name", False)
    named = lookup(one, t["dw.staff_category_dim"], "non_teaching_staff_category_id",
                   {"category_name": "category_name", "id": "category_id"}, key="source_id")
    return insert_absent(
        t["dw.staff_role_dim"], named.drop("non_teaching_staff_category_id"), ["role_name"]
    )
