"""All marts in order on derived sources, written to a warehouse folder, then reports and a rerun."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from censusmart.operators.keys import duplicates
from censusmart.plans import indicators, runner
from censusmart.plans.schools import by_operational_status
from censusmart.reports import DATASETS
from censusmart.sources.warehouse import Warehouse
from tests.conftest import SF
from workload.world import World

ORDER = [
    "schools", "enrolment", "teachers", "non_teaching_staff", "infrastructure", "teaching_subjects",
    "teacher_transfers", "indicators",
]
FIRST, SECOND = date(2024, 9, 2), date(2025, 1, 15)


class Sources(World):
    """Derived source tables under the names the extracts read."""

    ALIASES = {
        "src.school_location_details": "stg.school_location_details_raw", "src.admin_units": "stg.admin_units_raw",
    }

    def __missing__(self, name):
        return self[self.ALIASES[name]] if name in self.ALIASES else super().__missing__(name)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    sources = Sources(spark, SF)
    # Units start in the hierarchy's own shape: the parent is the source id one level up.
    store = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    counts = {}
    for i, mart in enumerate(ORDER, 1):
        counts[mart] = runner.run_mart(spark, mart, sources, store, FIRST, run_id=i)
    return sources, store, counts


def test_every_table_is_filled(loaded):
    _, store, counts = loaded
    empty_ok = set()
    for mart, tables in counts.items():
        for table, n in tables.items():
            assert n > 0 or table in empty_ok, (mart, table)
            assert store.exists(table)


FACTS = {
    "dw.enrolment_fact": ["learner_source_id", "school_source_id", "academic_year", "term"],
    "dw.hr_fact": ["person_id", "school_source_id", "academic_year", "term"],
    "dw.non_teaching_staff_fact": ["person_id", "school_source_id", "academic_year", "term"],
    "dw.infrastructure_fact": ["school_source_id", "building_source_id", "academic_year", "term"],
    "dw.teaching_subject_fact": ["person_id", "subject_source_id", "subject_level"],
    "dw.teacher_transfer_fact": ["person_id", "transfer_source_id"],
    "dw.population_fact": ["district_id", "year", "sex"],
    "dw.enrolment_indicator_fact": ["district_id", "school_level", "academic_year", "gender"],
    "dw.school_indicator_fact": ["school_source_id", "academic_year", "term"],
    "dw.school_fact": ["school_id", "date_id"],
}


@pytest.mark.parametrize("table", FACTS)
def test_natural_keys_are_unique(loaded, table):
    assert duplicates(loaded[1].read(table), FACTS[table]).count() == 0


def test_initial_load_resolves_through_the_earliest_versions(loaded):
    """Facts carry term dates of other years than the load date, so all rows need the fallback
    unless their term starts on or after the first load."""
    store = loaded[1]
    fact, dim = store.read("dw.enrolment_fact"), store.read("dw.learner_dim")
    assert fact.join(dim.select(F.col("id").alias("learner_id")), "learner_id", "left_anti").count() == 0
    assert dim.filter("not is_current").count() == 0


def test_reports_run_on_the_warehouse(loaded):
    _, store, _ = loaded
    empty = [name for name, dataset in DATASETS.items() if dataset(store).isEmpty()]
    assert empty == []


def test_totals_equal_the_sum_of_both_genders(loaded):
    fact = loaded[1].read("dw.enrolment_indicator_fact")
    known = F.upper("gender").isin("M", "F", "MALE", "FEMALE")
    per = fact.groupBy("district_id", "school_level", "academic_year").agg(
        F.sum(F.when(known, F.col("total_enrolment"))).alias("a"),
        F.sum(F.when(F.col("gender") == "TOTAL", F.col("total_enrolment"))).alias("b"),
    )
    assert per.filter("a <> b or (a is null) <> (b is null)").count() == 0


def test_audit_rows(loaded):
    store = loaded[1]
    runs = runner.recent_runs(store.read("dw_audit.etl_run"), 10).collect()
    assert [r.run_id for r in runs] == [8, 7, 6, 5, 4, 3, 2, 1]
    assert {r.status for r in runs} == {"SUCCESS"} and all(r.duration_mins >= 0 for r in runs)
    steps = runner.steps_of(store.read("dw_audit.etl_step_log"), 2).collect()
    assert [s.step_name for s in steps] == [s.table for s in runner.MARTS["enrolment"]]
    checks = store.read("dw_audit.dq_check_log")
    assert checks.select("mart").distinct().count() == 10
    assert checks.count() == 7 + 7 + 9 + 8 + 8 + 9 + 8 + 10 + 10 + 6


def test_second_merge_on_the_same_day_is_refused(loaded, spark):
    sources, store, _ = loaded
    with pytest.raises(ValueError, match="already holds versions"):
        runner.run_mart(spark, "schools", sources, store, FIRST, run_id=90)
    failed = store.read("dw_audit.etl_run").filter("run_id = 90").collect()
    assert [r.status for r in failed] == ["FAILED"] and "already holds" in failed[0].error_message
    step = store.read("dw_audit.etl_step_log").filter("run_id = 90 and status = 'FAILED'").collect()
    assert len(step) == 1 and "already holds" in step[0].message


def test_rerun_and_later_change(loaded, spark):
    """The same sources on a later day change no version; a changed source expires exactly its rows."""
    sources, store, counts = loaded
    before = store.read("dw.schools_dim").count()
    again = runner.run_mart(spark, "schools", sources, store, SECOND, run_id=20)
    assert again["dw.schools_dim"] == before
    assert again["dw.school_fact"] == 2 * counts["schools"]["dw.school_fact"]
    assert by_operational_status(store, SECOND).agg(F.sum("school_count")).first()[0] == before

    flat = store.read("dw.enrolment_fact").count()
    assert runner.run_mart(spark, "enrolment", sources, store, SECOND, run_id=21)["dw.enrolment_fact"] == flat

    moved = Sources(spark, SF)
    moved["src.schools"] = sources["src.schools"].withColumn(
        "name", F.when(F.col("id") == 4, "A new name").otherwise(F.col("name"))
    )
    later = date(2025, 2, 1)
    after = runner.run_mart(spark, "schools", moved, store, later, run_id=22)
    assert after["dw.schools_dim"] == before + 1
    steps = {s.step_name: s for s in store.read("dw_audit.etl_step_log").filter("run_id = 22").collect()}
    assert steps["dw.schools_dim"].rows_affected == 2 and json.loads(steps["dw.schools_dim"].message)["expired"] == 1
    assert steps["dw.admin_units_dim"].rows_affected == 0
    versions = store.read("dw.schools_dim").filter("source_id = 4").orderBy("effective_date").collect()
    assert [v.is_current for v in versions] == [False, True]
    assert versions[0].expiration_date == date(2025, 1, 31) and versions[1].effective_date == later
    assert versions[1].change_reason == "School renamed" and versions[1].changed_fields == "name"


def test_upserted_facts_do_not_grow_on_a_rerun(loaded, spark):
    sources, store, counts = loaded
    for mart, table in [("infrastructure", "dw.infrastructure_fact"), ("teacher_transfers", "dw.teacher_transfer_fact"),
                        ("teaching_subjects", "dw.teaching_subject_fact")]:
        assert runner.run_mart(spark, mart, sources, store, SECOND, run_id=30)[table] == counts[mart][table]


def test_steps_tell_what_they_changed(loaded):
    _, store, counts = loaded
    steps = {s.step_name: s for s in store.read("dw_audit.etl_step_log").filter("run_id = 1").collect()}
    assert steps["dw.schools_dim"].rows_affected == counts["schools"]["dw.schools_dim"]
    assert json.loads(steps["dw.schools_dim"].message)["inserted"] == counts["schools"]["dw.schools_dim"]


def test_a_run_says_running_until_it_ends(loaded, spark, monkeypatch):
    sources, store, _ = loaded
    seen = []

    def watching(space, step, as_of, rerun):
        seen.append(Warehouse(spark, store.root).read("dw_audit.etl_run").filter("run_id = 91").first().status)
        raise RuntimeError("stopped here")

    monkeypatch.setattr(runner, "_write", watching)
    with pytest.raises(RuntimeError, match="stopped here"):
        runner.run_mart(spark, "infrastructure", sources, store, SECOND, run_id=91)
    runs = store.read("dw_audit.etl_run").filter("run_id = 91").collect()
    assert seen == ["RUNNING"] and [(r.status, r.error_message) for r in runs] == [("FAILED", "stopped here")]


def test_changed_groups_refresh_their_years_only(loaded, spark):
    """One school's learners of one year arrive again: its groups equal a full computation, other years keep their files."""
    sources, store, _ = loaded
    space = runner.Workspace(sources, store)
    fact = store.read("dw.enrolment_fact")
    place = indicators.placed_schools(space).filter("school_level is not null").select("school_id")
    one = fact.join(place, "school_id", "left_semi").filter("academic_year = 2025").orderBy("school_id", "id").select("school_id").first().school_id
    batch = fact.filter((F.col("school_id") == one) & (F.col("academic_year") == 2025))
    table, key = "dw.enrolment_indicator_fact", indicators.ENROLMENT_KEY
    columns = [*key, "total_enrolment", "ger", "gpi_ger"]
    full = {tuple(r) for r in store.read(table).select(columns).collect()}
    before = store.read(table).filter("academic_year <> 2025").inputFiles()
    stale = store.read(table).withColumn("total_enrolment", F.when(F.col("academic_year") == 2025, 0).otherwise(F.col("total_enrolment")))
    store.load_upsert(table, stale.filter("academic_year = 2025 and school_level is not null"), key, ["total_enrolment"], "academic_year")
    indicators.load_changed_groups(space, batch, store)
    groups = {tuple(r) for r in indicators.changed_groups(space, batch).collect()}
    after = {tuple(r) for r in store.read(table).select(columns).collect()}
    own = {r for r in full if r[:3] in groups}
    assert own and own <= after and {r for r in after if r[2] == 2025 and r[1] is not None and r[:3] not in groups and r[4] != 0} == set()
    assert {r for r in after if r[2] != 2025} == {r for r in full if r[2] != 2025}
    assert set(before) <= set(store.read(table).filter("academic_year <> 2025").inputFiles())
