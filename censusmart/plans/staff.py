"""Non-teaching staff mart: extract, person × term rows, staff versions, fact."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.functions.calendar import age_in_year
from censusmart.functions.labels import full_given_name, nationality
from censusmart.operators.asof import earliest_version
from censusmart.operators.keys import first_per_key
from censusmart.operators.lookup import decode_ids, expand_periods, lookup
from censusmart.operators.scd2 import Versioned, scd2_merge
from censusmart.plans.common import Tables, active_periods, on_calendar, people, school_facts

NATURAL_KEY = ["person_id", "school_source_id", "academic_year", "term"]

STAFF = Versioned(
    keys=["source_id"],
    tracked={
        "gender": "", "category": "", "role": "", "highest_education_level": "",
        "employment_status": "", "is_on_government_payroll": "false",
    },
)


def extract_staff(t: Tables) -> DataFrame:
    """One row per person with the most recently updated employment."""
    jobs = decode_ids(
        t["src.school_employees"],
        [
            (t["src.setting_education_levels"], "highest_education_level_id", {"name": "highest_education_level"}),
            (t["src.setting_employment_statuses"], "employment_status_id", {"name": "employment_status"}),
        ],
    ).select(
        F.col("id").alias("_job"), F.col("school_id").alias("job_school"), "highest_education_level",
        "employment_status", "is_on_government_payroll", "ipps_number", "hrin", "hcm_employee_number",
        "date_started", "date_ended", "is_undergoing_training", F.col("date_updated").alias("job_updated"),
        F.coalesce("date_updated", "date_created").alias("job_touched"),
    )
    person = people(t).filter(F.col("deleted_at").isNull()).select(
        F.col("id").alias("_person"), "surname", "first_name", "other_names", "birth_date", "gender",
        "country", "id_number",
    )
    named = decode_ids(
        t["src.non_teaching_staff"],
        [
            (t["src.setting_non_teaching_staff_categories"], "non_teaching_staff_category_id", {"name": "category"}),
            (t["src.setting_non_teaching_staff_roles"], "non_teaching_staff_role_id", {"name": "role"}),
        ],
    )
    joined = named.join(jobs, F.col("employee_id") == F.col("_job"), "left")
    order = [F.col("job_updated").desc_nulls_last(), F.col("employee_id").asc_nulls_last()]
    joined = first_per_key(joined, ["person_id"], order).join(person, F.col("person_id") == F.col("_person"))
    touched = F.greatest(F.coalesce("date_updated", "date_created"), "job_touched")
    return joined.select(
        "person_id", F.col("_job").alias("employee_id"), F.col("employee_id").alias("nts_employee_id"),
        "surname", full_given_name(F.col("first_name"), F.col("other_names")).alias("given_name"),
        "gender", F.col("birth_date").alias("date_of_birth"),
        nationality(F.col("country")).alias("nationality"), F.col("id_number").alias("nin"),
        "category", "role", "is_transfer_appointment", "appointment_date", "posting_date",
        F.coalesce("job_school", "current_school_id").alias("current_school_id"),
        "highest_education_level", "employment_status",
        F.coalesce("is_on_government_payroll", F.lit(False)).alias("is_on_government_payroll"),
        "ipps_number", "hrin", "hcm_employee_number", "date_started", "date_ended",
        "is_undergoing_training", touched.alias("date_created"), touched.alias("date_updated"),
    )


def staff_periods(t: Tables) -> DataFrame:
    """One general period per source year and period, that of the lowest school type."""
    periods = active_periods(t).filter(F.col("school_id").isNull())
    one = first_per_key(
        periods, ["academic_year_id", "teaching_period_id"],
        [F.col("school_type_id").asc_nulls_last(), F.col("term_start_date").asc_nulls_last()],
    )
    return one.select("academic_year", "term", "term_start_date")


def flatten_staff(t: Tables, as_of: date) -> DataFrame:
    """One row per staff member and academic term, at the school of the extract."""
    schools = school_facts(t).drop("_school_type_id")
    persons = t["stg.non_teaching_staff_raw"].join(schools, F.col("current_school_id") == F.col("_school"))
    ready = persons.select(
        "person_id", "employee_id", F.col("current_school_id").alias("school_id"), "surname", "given_name",
        "gender", age_in_year(as_of, F.col("date_of_birth")).alias("age"), "date_of_birth", "nationality",
        "nin", "category", "role", "posting_date", "highest_education_level", "employment_status",
        "is_on_government_payroll", "ipps_number", "hrin", "hcm_employee_number", "is_undergoing_training",
        "school_emis_number", "school_name", "school_type", "school_ownership", "admin_unit_source_id",
        F.lit(True).alias("is_primary_school"),
    )
    return expand_periods(ready, staff_periods(t))


def stage_staff(flat: DataFrame) -> DataFrame:
    latest = [F.col("term_start_date").desc_nulls_last(), F.col("school_id"), F.col("term")]
    return first_per_key(flat, ["person_id"], latest).withColumnRenamed("person_id", "source_id")


def merge_staff(t: Tables, as_of: date, compat: bool = False) -> DataFrame:
    spec = replace(STAFF, compat="initial") if compat else STAFF
    staged = stage_staff(t["stg.non_teaching_staff_flat"])
    return scd2_merge(t["dw.non_teaching_staff_dim"], staged, spec, as_of)


def staff_fact(t: Tables) -> DataFrame:
    """Staff × school × term; this mart always takes the earliest version of both dimensions."""
    flat = t["stg.non_teaching_staff_flat"].select(
        "person_id", F.col("school_id").alias("school_source_id"), "academic_year", "term",
        "term_start_date", "is_primary_school", "is_on_government_payroll",
    )
    dated = on_calendar(flat, t["dw.date_dim"], "term_start_date")
    dated = first_per_key(dated, NATURAL_KEY, [F.col("term_start_date").asc_nulls_last()])
    dated = lookup(dated, earliest_version(t["dw.non_teaching_staff_dim"]), "person_id",
                   {"id": "staff_id"}, key="source_id", how="inner")
    dated = lookup(dated, earliest_version(t["dw.schools_dim"]), "school_source_id",
                   {"id": "school_id"}, key="source_id", how="inner")
    return dated.select(
        F.xxhash64(*NATURAL_KEY).alias("id"), "staff_id", "school_id", "date_id", *NATURAL_KEY,
        "is_primary_school", "is_on_government_payroll",
    )
