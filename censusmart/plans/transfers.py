"""Teacher-transfer mart: decoded transfer records of every status, fact of the approved ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.functions.calendar import days_between
from censusmart.functions.labels import TRANSFER_STATUS, crosses, decode, discipline
from censusmart.functions.numbers import is_false
from censusmart.operators.asof import latest_before
from censusmart.operators.lookup import lookup
from censusmart.plans.common import Tables, current_ids
from censusmart.plans.teachers import subject_counts

NATURAL_KEY = ["person_id", "transfer_source_id"]

# Posting states that count as served (posted, received).
SERVED_POSTINGS = (1, 2)

# Columns a reload refreshes.
FACT_UPDATES = [
    "teacher_id", "out_school_id", "in_school_id", "out_district_id", "in_district_id",
    "days_at_outgoing_station", "days_to_report", "is_inter_district",
]

SIDES = ("outgoing", "incoming")


def with_last_posting(t: Tables) -> DataFrame:
    """Transfers with the latest posting to the outgoing school before the transfer's own date."""
    postings = t["src.teacher_postings"].filter(F.col("status").isin(*SERVED_POSTINGS)).select(
        "person_id", F.col("school_id").alias("outgoing_school_id"), F.col("posting_date").alias("posted")
    )
    return latest_before(
        t["src.teacher_transfers"], postings, ["person_id", "outgoing_school_id"], "posting_date", "posted",
        "last_posting_date",
    )


def extract_transfers(t: Tables) -> DataFrame:
    """All transfers with both schools, both districts, status text and days at the old station."""
    governments = t["src.admin_unit_upper_local_governments"]
    districts = t["src.admin_unit_districts"].filter(is_false(F.col("is_archived_yn")))
    types = t["src.setting_school_types"]
    rows = with_last_posting(t)
    for side in SIDES:
        rows = lookup(rows, t["src.schools"], f"{side}_school_id",
                      {"name": f"{side}_school_name", "school_type_id": f"{side}_type_id"})
        rows = lookup(rows, types, f"{side}_type_id", {"name": f"{side}_school_type"})
        rows = lookup(rows, governments, f"{side}_local_government_id", {"district_id": f"{side}_seat"})
        rows = lookup(rows, districts, f"{side}_seat",
                      {"id": f"{side}_district_id", "name": f"{side}_district_name"})
    teachers = t["stg.teachers_raw"].select(
        F.col("person_id").alias("_teacher"), "teacher_type", "gender", "qualification", "ipps_number"
    )
    rows = rows.join(teachers, F.col("person_id") == F.col("_teacher"), "left")
    rows = rows.join(subject_counts(t), F.col("person_id") == F.col("_counted"), "left")
    paired = [f"{side}_{part}" for part in ("school_id", "school_name", "school_type", "district_id",
                                            "district_name") for side in SIDES]
    return rows.select(
        F.col("id").alias("transfer_id"), "person_id", "employee_id", "outgoing_employee_id", *paired,
        crosses(F.col("outgoing_district_id"), F.col("incoming_district_id")).alias("is_inter_district"),
        "posting_date", "reporting_date",
        decode(F.col("status"), TRANSFER_STATUS, "UNKNOWN").alias("transfer_status"),
        "appointment_minute_number", "category_id",
        days_between(F.col("posting_date"), F.col("last_posting_date")).alias("days_at_outgoing_station"),
        "teacher_type", "gender", "qualification",
        discipline(F.col("subjects"), F.col("science")).alias("discipline"),
        "ipps_number", "date_created", "date_updated",
    )


def transfer_fact(t: Tables) -> DataFrame:
    """Approved transfers of current teachers; schools and districts may stay unresolved."""
    approved = t["stg.teacher_transfers_raw"].filter(
        (F.col("transfer_status") == "APPROVED") & F.col("person_id").isNotNull()
    )
    teachers = current_ids(t["dw.teacher_dim"], "teacher_id")
    rows = approved.join(teachers, F.col("person_id") == F.col("_source")).drop("_source")
    schools = current_ids(t["dw.schools_dim"], "_id")
    units = t["dw.admin_units_dim"].filter(F.col("current_status") & (F.col("admin_unit_type") == "District"))
    districts = current_ids(units, "_id", "current_status")
    for short, side in zip(("out", "in"), SIDES, strict=True):
        rows = lookup(rows, schools, f"{side}_school_id", {"_id": f"{short}_school_id"}, key="_source")
        rows = lookup(rows, districts, f"{side}_district_id", {"_id": f"{short}_district_id"}, key="_source")
    days = t["dw.date_dim"]
    last = days.agg(F.max_by("id", "system_date")).scalar()
    rows = lookup(rows, days, "posting_date", {"id": "_date"}, key="system_date")
    return rows.select(
        F.xxhash64("person_id", "transfer_id").alias("id"), "teacher_id", "out_school_id", "in_school_id",
        "out_district_id", "in_district_id", F.coalesce("_date", last).alias("date_id"), "person_id",
        F.col("transfer_id").alias("transfer_source_id"),
        F.col("outgoing_school_id").alias("outgoing_school_source_id"),
        F.col("incoming_school_id").alias("incoming_school_source_id"),
        "transfer_status", "appointment_minute_number", "is_inter_district", "days_at_outgoing_station",
        days_between(F.col("reporting_date"), F.col("posting_date")).alias("days_to_report"),
        "posting_date", "reporting_date",
    )
