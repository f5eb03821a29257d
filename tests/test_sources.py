"""Reads, rejects, and the warehouse's writes."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusmart.plans import lookups, schools
from censusmart.plans.runner import Workspace
from censusmart.session import cut_lineage
from censusmart.sources import files
from censusmart.sources.schemas import DDL, schema
from censusmart.sources.warehouse import Warehouse


def test_every_schema_parses(spark):
    for table in DDL:
        names = schema(table).names
        assert len(names) == len(set(names)), table


def test_surrogates_are_long(spark):
    for table in DDL:
        for f in schema(table).fields:
            if f.name == "id" or (f.name.endswith("_id") and f.dataType.typeName() != "string"):
                assert isinstance(f.dataType, T.LongType), (table, f.name)


def test_csv_reads_empty_text_as_null(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_text("1,a\n2,\n3,\"\"\n")
    got = files.read_csv(spark, str(tmp_path / "x.csv"), T.StructType.fromDDL("id int, v string"))
    assert rows(got) == [(1, "a"), (2, None), (3, None)]


def test_json_rows_are_copied_or_rejected(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"id": 1, "v": "a"}\n{"id": "no number", "v": "b"}\n{broken\n{"id": 4}\n')
    read = files.read_json_rows(spark, str(path), T.StructType.fromDDL("id int, v string")).cache()
    good, bad = files.split_rejects(read)
    assert sorted((r.id, r.v) for r in good.collect()) == [(1, "a"), (4, None)]
    assert bad.count() == 2
    assert files.copy_counts(read).first().asDict() == {"copied": 2, "skipped": 2}


def test_extract_blanks_and_columns(frame):
    t = {"src.schools": frame("id bigint, name string, emis_number string, unused string", (1, "", "E1", "x"))}
    row = schools.extract_schools(t).first()
    assert row.name is None and row.emis_number == "E1" and "unused" not in row.asDict()
    units = {"src.admin_units": frame("parent_id bigint, admin_unit_type string, source_id bigint", (1, " DISTRICT", 5))}
    assert schools.extract_admin_units(units).first().admin_unit_type == "District"


def test_population_list(spark):
    stated = lookups.stated_population(spark)
    assert stated.count() == 27 * 3
    both = stated.groupBy("district_name").pivot("sex", ["M", "F", "TOTAL"]).sum("total_population")
    assert both.filter("M + F <> TOTAL").count() == 0


def test_fixed_dimensions(spark):
    assert lookups.grade_dim(spark).count() == 20
    assert [r.enrolment_type for r in lookups.enrolment_type_dim(spark).orderBy("source_id").collect()] == [
        "BASELINE", "NEW", "CONTINUING", "TRANSFER"]
    assert lookups.orphan_type_dim(spark).count() == 4 and lookups.disability_type_dim(spark).count() == 6


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"))



def fact(frame, *rows_):
    return frame("school_source_id bigint, academic_year int, term string, total_teachers int", *rows_)


TABLE, KEY = "dw.school_indicator_fact", ["school_source_id", "academic_year", "term"]


def test_unwritten_tables_are_empty_with_their_schema(store):
    df = store.read("dw.schools_dim")
    assert df.schema.names == schema("dw.schools_dim").names and df.count() == 0
    assert not store.exists("dw.schools_dim")


def test_refresh_may_read_the_table_it_replaces(store, frame, rows):
    store.refresh(TABLE, fact(frame, (1, 2023, "TERM 1", 5)))
    store.refresh(TABLE, store.read(TABLE).withColumn("total_teachers", F.col("total_teachers") + 1))
    assert rows(store.read(TABLE), "total_teachers") == [(6,)]
    again = Warehouse(store.spark, store.root)
    assert rows(again.read(TABLE), "total_teachers") == [(6,)]


def test_absent_rows_are_appended_once(store, frame, rows):
    first = fact(frame, (1, 2023, "TERM 1", 5), (1, 2024, "TERM 1", 6))
    store.load_absent(TABLE, first, KEY, ["academic_year"])
    more = fact(frame, (1, 2024, "TERM 1", 99), (1, 2024, "TERM 2", 7))
    for _ in range(2):
        store.load_absent(TABLE, more, KEY, ["academic_year"])
    assert rows(store.read(TABLE), "academic_year", "term", "total_teachers") == [
        (2023, "TERM 1", 5), (2024, "TERM 1", 6), (2024, "TERM 2", 7)]


def test_upsert_rewrites_touched_partitions_only(store, frame, rows, tmp_path):
    store.load_upsert(TABLE, fact(frame, (1, 2023, "TERM 1", 5), (1, 2024, "TERM 1", 6)), KEY, ["total_teachers"], "academic_year")
    untouched = sorted(p.name for p in (tmp_path / "w").rglob("academic_year=2023/*.parquet"))
    change = fact(frame, (1, 2024, "TERM 1", 60), (2, 2024, "TERM 1", 8), (1, 2025, "TERM 1", 9))
    for _ in range(2):
        store.load_upsert(TABLE, change, KEY, ["total_teachers"], "academic_year")
    assert rows(store.read(TABLE), "school_source_id", "academic_year", "total_teachers") == [
        (1, 2023, 5), (1, 2024, 60), (1, 2025, 9), (2, 2024, 8)]
    assert untouched and set(untouched) <= {p.name for p in (tmp_path / "w").rglob("academic_year=2023/*.parquet")}


def test_workspace_prefers_sources_for_source_names(store, frame):
    space = Workspace({"src.schools": frame("id int", (1,))}, store)
    assert space["src.schools"].count() == 1 and space["dw.schools_dim"].count() == 0


def test_cut_lineage(frame):
    df = frame("a int", (1,), (2,))
    cut = cut_lineage(df.withColumn("b", F.col("a") * 2))
    assert sorted(tuple(r) for r in cut.collect()) == [(1, 2), (2, 4)]
    assert "Project" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_versions_keep_history_and_replace_current_rows(store, frame, rows, tmp_path):
    columns = "id bigint, source_id bigint, name string, effective_date date, is_current boolean"
    d = [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
    table = "dw.schools_dim"
    store.refresh(table, frame(columns, (1, 1, "a", d[0], True), (9, 9, "gone", d[0], False)))
    store.load_versions(table, frame(columns, (1, 1, "a", d[0], False), (2, 1, "b", d[1], True)), "is_current", d[1])
    got = store.load_versions(table, frame(columns, (2, 1, "b", d[1], False), (3, 1, "c", d[2], True)), "is_current", d[2])
    assert rows(got, "id", "is_current") == [(1, False), (2, False), (3, True), (9, False)]
    assert got.columns == schema(table).names
    plan = got.filter("is_current")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    assert rows(Warehouse(store.spark, store.root).read(table), "id") == [(1,), (2,), (3,), (9,)]
    with pytest.raises(ValueError, match="repeats"):
        clash = frame(columns, (3, 1, "c", d[2], False), (1, 2, "x", date(2024, 4, 1), True))
        store.load_versions(table, clash, "is_current", date(2024, 4, 1))
    assert rows(store.read(table), "id") == [(1,), (2,), (3,), (9,)]


def test_upsert_that_dies_before_the_switch_loses_nothing(store, frame, rows, monkeypatch):
    store.load_upsert(TABLE, fact(frame, (1, 2023, "TERM 1", 5), (1, 2024, "TERM 1", 6)), KEY, ["total_teachers"], "academic_year")
    change = fact(frame, (1, 2024, "TERM 1", 60), (2, 2025, "TERM 1", 8))
    dying = Warehouse(store.spark, store.root)
    point = dying._point

    def fails(table, *args, **kwargs):
        if table == TABLE:
            raise OSError("lost")
        point(table, *args, **kwargs)

    monkeypatch.setattr(dying, "_point", fails)
    with pytest.raises(OSError):
        dying.load_upsert(TABLE, change, KEY, ["total_teachers"], "academic_year")
    columns = ["school_source_id", "academic_year", "total_teachers"]
    again = Warehouse(store.spark, store.root)
    assert rows(again.read(TABLE), *columns) == [(1, 2023, 5), (1, 2024, 6)]
    again.load_upsert(TABLE, change, KEY, ["total_teachers"], "academic_year")
    assert rows(again.read(TABLE), *columns) == [(1, 2023, 5), (1, 2024, 60), (2, 2025, 8)]
    assert again.affected[TABLE] == {"rows": 2}


def test_partitions_without_a_value_are_upserted_too(store, frame, rows):
    for teachers in (5, 7):
        batch = fact(frame, (1, None, "TERM 1", teachers), (2, 2024, "TERM 1", teachers))
        store.load_upsert(TABLE, batch, ["school_source_id"], ["total_teachers"], "academic_year")
    assert rows(store.read(TABLE), "school_source_id", "academic_year", "total_teachers") == [(1, None, 7), (2, 2024, 7)]


def test_a_second_writer_is_refused(store, frame):
    store.refresh(TABLE, fact(frame, (1, 2023, "TERM 1", 5)))
    late = Warehouse(store.spark, store.root)
    assert late.read(TABLE).count() == 1
    store.refresh(TABLE, fact(frame, (1, 2023, "TERM 1", 6)))
    with pytest.raises(RuntimeError, match="another job"):
        late.refresh(TABLE, fact(frame, (1, 2023, "TERM 1", 7)))
    assert Warehouse(store.spark, store.root).read(TABLE).first().total_teachers == 6


def test_reading_one_year_of_an_upserted_table_prunes_folders(store, frame):
    for year in (2023, 2024, 2025):
        store.load_upsert(TABLE, fact(frame, (1, year, "TERM 1", 5)), KEY, ["total_teachers"], "academic_year")
    plan = store.read(TABLE).filter("academic_year = 2024")._jdf.queryExecution().optimizedPlan().toString()
    assert store.read(TABLE).filter("academic_year = 2024").count() == 1 and plan.count("Relation") <= 3
    assert len(store.read(TABLE).filter("academic_year = 2024").inputFiles()) <= 3


def test_a_hot_partition_is_split_and_small_ones_are_merged(store, spark, tmp_path):
    many = spark.range(0, 400_000, 1, 16).selectExpr(
        "id AS school_source_id", "CAST(CASE WHEN id % 50 = 0 THEN 2020 + id % 4 ELSE 2024 END AS INT) AS academic_year",
        "sha2(CAST(id AS STRING), 256) AS term", "CAST(id AS INT) AS total_teachers")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "4m")
    try:
        store.refresh(TABLE, many, ["academic_year"])
    finally:
        spark.conf.unset(size)
    files_ = {year: sorted(p.stat().st_size for p in (tmp_path / "w").rglob(f"academic_year={year}/*.parquet")) for year in (2020, 2022, 2024)}
    assert len(files_[2024]) > 2 and max(files_[2024]) < 0.6 * sum(files_[2024])
    assert len(files_[2020]) + len(files_[2022]) <= len(files_[2024]) + 2 < 2 * 16
    assert store.affected[TABLE] == {"rows": 400_000}


def test_affected_versions_are_observed(store, frame):
    columns = "id bigint, source_id bigint, name string, effective_date date, expiration_date date, is_current boolean"
    first, second, end = date(2024, 1, 1), date(2024, 2, 1), date(9999, 12, 31)
    table = "dw.schools_dim"
    store.load_versions(table, frame(columns, (1, 1, "a", first, end, True), (2, 2, "b", first, end, True)), "is_current", first)
    assert store.affected[table] == {"rows": 2, "inserted": 2, "expired": 0, "unchanged": 0}
    merged = frame(columns, (1, 1, "a", first, date(2024, 1, 31), False), (3, 1, "c", second, end, True), (2, 2, "b", first, end, True))
    store.load_versions(table, merged, "is_current", second)
    assert store.affected[table] == {"rows": 3, "inserted": 1, "expired": 1, "unchanged": 1}
