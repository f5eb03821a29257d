"""Mart runs: ordered steps, written tables, audit rows."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusmart.functions.calendar import calendar_dim
from censusmart.operators.hierarchy import district_map, reach
from censusmart.operators.quality import raise_on_failure
from censusmart.operators.scd2 import require_later
from censusmart.plans import (
    enrolment, indicators, infrastructure, lookups, schools, staff, subjects, suites, teachers, transfers,
)
from censusmart.plans.common import Tables
from censusmart.sources.schemas import schema
from censusmart.sources.warehouse import Warehouse

log = logging.getLogger(__name__)
YEAR = "academic_year"

# Columns that hold the time of writing.
STAMPS = ("load_time", "location_time", "date_computed", "date_loaded")


class Workspace(dict):
    """Source tables by name, everything else from the warehouse as last written."""

    def __init__(self, sources: Tables, warehouse: Warehouse):
        super().__init__()
        self.sources, self.warehouse = sources, warehouse

    def __missing__(self, name: str) -> DataFrame:
        return self.sources[name] if name.startswith("src.") else self.warehouse.read(name)


@dataclass(frozen=True)
class Step:
    """Build ``table`` and write it: ``refresh``, ``absent`` or ``upsert`` on ``keys``.

    ``versioned`` names a dimension's current flag: its merge is refused for a date it already
    covers and rewrites the current rows only, and its surrogate ids are checked for uniqueness.
    ``staged`` names the staging table of an ``absent`` fact that holds its natural key (columns
    renamed by ``staged_names``): rows already loaded are taken out there, so that only new rows
    go through the fact's joins.
    """

    table: str
    build: Callable[[Tables, date], DataFrame]
    write: str = "refresh"
    keys: tuple[str, ...] = ()
    updates: tuple[str, ...] = ()
    partition: str | None = None
    versioned: str | None = None
    staged: str | None = None
    staged_names: tuple[tuple[str, str], ...] = ()


def _plain(build: Callable[[Tables], DataFrame]) -> Callable[[Tables, date], DataFrame]:
    return lambda t, as_of: build(t)


def _fact(table: str, build, keys, staged: str, **names: str) -> Step:
    return Step(table, _plain(build), "absent", tuple(keys), partition=YEAR, staged=staged,
                staged_names=tuple(names.items()))


def _upserted(table: str, build, keys, updates, partition: str | None = None) -> Step:
    return Step(table, _plain(build), "upsert", tuple(keys), tuple(updates), partition)


def _dimension(table: str, build, current: str = "is_current") -> Step:
    return Step(table, build, versioned=current)


def _map(t: Tables) -> DataFrame:
    return district_map(t["dw.schools_dim"], reach(t["dw.unit_ancestor"]))


# Units are versioned before the schools that point at them; population is loaded before the
# indicators that divide by it.
MARTS: dict[str, list[Step]] = {
    "schools": [
        Step("stg.schools_raw", _plain(schools.extract_schools)),
        Step("stg.school_location_details_raw", _plain(schools.extract_locations)),
        Step("stg.admin_units_raw", _plain(schools.extract_admin_units)),
        _dimension("dw.admin_units_dim", schools.merge_admin_units, "current_status"),
        Step("dw.unit_ancestor", _plain(schools.unit_ancestors)),
        Step("stg.schools_flat", schools.flatten_schools),
        _dimension("dw.schools_dim", schools.merge_schools),
        _dimension("dw.school_location_details_dim", schools.merge_locations),
        Step("dw.school_fact", schools.school_snapshot, "absent", ("school_id", "date_id"), partition="date_id"),
        Step("dw.school_district_map", _plain(_map)),
    ],
    "enrolment": [
        Step("stg.learners_raw", _plain(enrolment.extract_learners)),
        Step("stg.learner_disabilities_raw", _plain(enrolment.extract_disabilities)),
        Step("stg.enrolments_raw", _plain(enrolment.extract_enrolments)),
        Step("stg.enrolments_subtype_raw", _plain(enrolment.extract_subtypes)),
        Step("stg.learner_promotions_raw", _plain(enrolment.extract_promotions)),
        Step("stg.learner_transitions_raw", _plain(enrolment.extract_transitions)),
        Step("stg.enrolments_flat", enrolment.flatten_enrolments),
        _dimension("dw.learner_dim", enrolment.merge_learners),
        _fact("dw.enrolment_fact", enrolment.enrolment_fact, enrolment.NATURAL_KEY, "stg.enrolments_flat"),
    ],
    "teachers": [
        Step("dw.teacher_type_dim", _plain(lookups.teacher_types)),
        Step("dw.qualification_dim", _plain(lookups.qualifications)),
        Step("dw.designation_dim", _plain(lookups.designations)),
        Step("stg.teachers_raw", _plain(teachers.extract_teachers)),
        Step("stg.teacher_subjects_raw", _plain(teachers.extract_teacher_subjects)),
        Step("stg.teacher_school_raw", _plain(teachers.extract_deployments)),
        Step("stg.teachers_flat", teachers.flatten_teachers),
        _dimension("dw.teacher_dim", teachers.merge_teachers),
        _fact("dw.hr_fact", teachers.hr_fact, teachers.NATURAL_KEY, "stg.teachers_flat",
              school_source_id="school_id"),
    ],
    "non_teaching_staff": [
        Step("dw.staff_category_dim", _plain(lookups.staff_categories)),
        Step("dw.staff_role_dim", _plain(lookups.staff_roles)),
        Step("stg.non_teaching_staff_raw", _plain(staff.extract_staff)),
        Step("stg.non_teaching_staff_flat", staff.flatten_staff),
        _dimension("dw.non_teaching_staff_dim", staff.merge_staff),
        _fact("dw.non_teaching_staff_fact", staff.staff_fact, staff.NATURAL_KEY,
              "stg.non_teaching_staff_flat", school_source_id="school_id"),
    ],
    "infrastructure": [
        Step("dw.infrastructure_type_dim", _plain(infrastructure.merge_types)),
        Step("stg.infrastructure_raw", _plain(infrastructure.extract_buildings)),
        _upserted("dw.infrastructure_fact", infrastructure.infrastructure_fact, infrastructure.NATURAL_KEY,
                  infrastructure.FACT_UPDATES, YEAR),
    ],
    "teaching_subjects": [
        Step("stg.subject_dim_raw", _plain(subjects.subject_list)),
        Step("stg.teaching_subject_flat", _plain(subjects.flatten_teaching)),
        Step("dw.subject_dim", _plain(subjects.merge_subjects)),
        Step("dw.teaching_subject_fact", subjects.teaching_fact, "upsert", tuple(subjects.NATURAL_KEY),
             tuple(subjects.FACT_UPDATES)),
    ],
    "teacher_transfers": [
        Step("stg.teacher_transfers_raw", _plain(transfers.extract_transfers)),
        _upserted("dw.teacher_transfer_fact", transfers.transfer_fact, transfers.NATURAL_KEY, transfers.FACT_UPDATES),
    ],
    "indicators": [
        Step("stg.population_raw", _plain(indicators.population_raw)),
        _upserted("dw.population_fact", indicators.population_fact, indicators.POPULATION_KEY,
                  indicators.POPULATION_UPDATES),
        Step("stg.enrolment_indicator_raw", _plain(indicators.enrolment_indicators)),
        Step("stg.school_indicator_raw", _plain(indicators.school_indicators)),
        Step("dw.enrolment_indicator_fact", _plain(indicators.enrolment_indicator_fact)),
        _upserted("dw.school_indicator_fact", indicators.school_indicator_rows, indicators.SCHOOL_KEY,
                  indicators.SCHOOL_UPDATES, YEAR),
    ],
}

# Suites that end each mart, and whether a failed check stops the run.
MART_SUITES = {m: [m] for m in MARTS} | {
    "schools": ["schools", "schools_nightly"], "indicators": ["indicators", "supplementary"],
}
STRICT = {"enrolment", "teachers", "non_teaching_staff"}


def prepare(spark: SparkSession, warehouse: Warehouse) -> None:
    """Write the calendar and the fixed lookup dimensions if they are missing."""
    fixed = {
        "dw.date_dim": calendar_dim, "dw.grade_dim": lookups.grade_dim,
        "dw.enrolment_type_dim": lookups.enrolment_type_dim, "dw.orphan_type_dim": lookups.orphan_type_dim,
        "dw.disability_type_dim": lookups.disability_type_dim,
    }
    for table, build in fixed.items():
        if not warehouse.exists(table):
            warehouse.refresh(table, build(spark).coalesce(1))


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _not_loaded(staged: DataFrame, fact: DataFrame, step: Step) -> DataFrame:
    """Staged rows whose natural key the fact lacks; only the touched partitions are looked at."""
    names = dict(step.staged_names)
    loaded = fact.select(*[F.col(k).alias(names.get(k, k)) for k in step.keys])
    loaded = loaded.join(staged.select(step.partition).distinct(), step.partition, "left_semi")
    return staged.join(loaded, [names.get(k, k) for k in step.keys], "left_anti").select(staged.columns)


def _write(space: Workspace, step: Step, as_of: date, rerun: bool) -> DataFrame:
    store = space.warehouse
    if step.versioned and not rerun:
        require_later(store.read(step.table), as_of, step.versioned)
    if step.versioned:
        # The merge sees the current versions only; the history stays where it is.
        space = Workspace(space.sources, store)
        space[step.table] = store.read(step.table).filter(step.versioned)
    if step.staged:
        space = Workspace(space.sources, store)
        space[step.staged] = _not_loaded(store.read(step.staged), store.read(step.table), step)
    df = step.build(space, as_of)
    stamps = [c for c in STAMPS if c in schema(step.table).names and c not in df.columns]
    df = df.withColumns({c: F.current_timestamp() for c in stamps})
    if step.staged:
        return store.append_batch(step.table, df, [step.partition])
    if step.write == "absent":
        return store.load_absent(step.table, df, step.keys, [step.partition] if step.partition else [])
    if step.write == "upsert":
        return store.load_upsert(step.table, df, step.keys, [*step.updates, *stamps], step.partition)
    if step.versioned:
        return store.load_versions(step.table, df, step.versioned, as_of)
    return store.refresh(step.table, df)


def run_mart(
    spark: SparkSession, name: str, sources: Tables, warehouse: Warehouse, as_of: date, run_id: int,
    rerun: bool = False,
) -> dict[str, int]:
    """Run one mart's steps in order and then its checks; the first error stops it.

    Every step reads what earlier steps wrote, so no lineage grows across steps and a lost
    executor costs at most the step at hand. Returns the row count per table. The run's row says RUNNING until
    the run ends; step and check rows are appended whether it succeeds or not. A step's rows are those
    it wrote or changed, observed during the write: inserted and expired versions, the rows of an upsert's batch.
    """
    prepare(spark, warehouse)
    space = Workspace(sources, warehouse)
    started, counts, steps, error = _now(), {}, [], None
    _log_run(spark, warehouse, (run_id, name, as_of, started, None, "RUNNING", None, None))
    try:
        for step in MARTS[name]:
            began, clock = _now(), time.monotonic()
            rows = _write(space, step, as_of, rerun).count()
            counts[step.table] = rows
            done = warehouse.affected[step.table]
            changed = done["inserted"] + done["expired"] if step.versioned else done["rows"]
            steps.append((run_id * 1000 + len(steps), run_id, step.table, began, _now(), "SUCCESS", changed, json.dumps(done)))
            log.info("%s %s: %d rows in %.1fs", name, step.table, rows, time.monotonic() - clock)
        for suite in MART_SUITES[name]:
            _check(space, suite, as_of, run_id, raise_failed=name in STRICT)
    except Exception as failure:
        error = str(failure)
        if len(counts) < len(MARTS[name]):
            failed = MARTS[name][len(counts)].table
            steps.append((run_id * 1000 + len(steps), run_id, failed, began, _now(), "FAILED", None, error))
        raise
    finally:
        status = "FAILED" if error else "SUCCESS"
        _log_run(spark, warehouse, (run_id, name, as_of, started, _now(), status, json.dumps(counts), error))
        _audit(spark, warehouse, "dw_audit.etl_step_log", steps)
    return counts


def _log_run(spark: SparkSession, warehouse: Warehouse, row: tuple) -> None:
    """Write or update the run's one row; the table has a row per run and is replaced as a whole."""
    declared = schema("dw_audit.etl_run")
    warehouse.load_upsert("dw_audit.etl_run", spark.createDataFrame([row], declared).coalesce(1), ["run_id"], declared.names[1:])


def _audit(spark: SparkSession, warehouse: Warehouse, table: str, rows: list[tuple]) -> None:
    if rows:
        warehouse.append(table, spark.createDataFrame(rows, schema(table)).coalesce(1))


def _check(space: Workspace, suite: str, as_of: date, run_id: int, raise_failed: bool) -> None:
    """Append the suite's log rows first and raise afterwards, so that they survive a failure."""
    result = suites.SUITES[suite](space, as_of)
    rows = result.run(as_of, F.lit(run_id)).withColumn("logged_at", F.current_timestamp())
    written = space.warehouse.append("dw_audit.dq_check_log", rows.coalesce(1))
    if raise_failed:
        raise_on_failure(written.filter(F.col("run_id") == run_id), result.mart)


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` runs with their duration in minutes."""
    seconds = F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")
    return runs.withColumn("duration_mins", seconds / 60).orderBy(F.col("run_id").desc()).limit(n)


def steps_of(steps: DataFrame, run_id: int) -> DataFrame:
    return steps.filter(F.col("run_id") == run_id).orderBy("step_log_id")


def recent_checks(checks: DataFrame, since: date) -> DataFrame:
    return checks.filter(F.col("logged_at") >= F.lit(since)).orderBy(F.col("logged_at").desc())
