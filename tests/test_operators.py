import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from censusmart.operators import asof, distinct, hierarchy, keys, lookup, quality, scd2, shape, upsert
from censusmart.streaming.incremental import advance, incremental, last_success

D1, D2, D3 = date(2024, 1, 1), date(2024, 6, 1), date(2024, 9, 1)


# ----------------------------------------------------------------------------- keys

def test_first_per_key_puts_nulls_last(frame, rows):
    df = frame("k int, ts date, id int", (1, None, 1), (1, D1, 2), (1, D2, 3), (1, D2, 4), (2, None, 5))
    got = keys.first_per_key(df, ["k"], [F.col("ts").desc_nulls_last(), F.col("id")])
    assert rows(got, "k", "id") == [(1, 3), (2, 5)]


def test_unique_or_null_drops_every_row_of_a_repeated_key(frame, rows):
    df = frame("id int, emis string", (1, None), (2, None), (3, "a"), (4, "b"), (5, "b"))
    assert rows(keys.unique_or_null(df, "emis"), "id") == [(1,), (2,), (3,)]


def test_require_unique(frame):
    df = frame("a int, b int", (1, 1), (1, 2))
    assert keys.require_unique(df, ["a", "b"], "t") is df
    with pytest.raises(ValueError, match="repeats"):
        keys.require_unique(df, ["a"], "t")


def test_limit_per_key_runs_before_the_shuffle(frame):
    df = frame("k int, v int", (1, 1))
    plan = keys.first_per_key(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


# ----------------------------------------------------------------------------- versions

SPEC = scd2.Versioned(keys=["source_id"], tracked={"name": "", "ok": "false"}, reasons=[("name", "Renamed")])
DIM = ("id bigint, source_id int, name string, ok boolean, extra string, effective_date date, expiration_date date, "
       "is_current boolean, change_hash string, change_reason string, changed_fields string")
STAGED = "source_id int, name string, ok boolean, extra string"


def load(frame, dim, day, *staged, spec=SPEC):
    return scd2.scd2_merge(dim, frame(STAGED, *staged), spec, day)


@pytest.fixture
def dim(frame):
    first = load(frame, frame(DIM), D1, (1, "a", True, "x"), (2, "b", None, "x"), (3, None, False, "x"), (4, "d", True, "x"))
    return load(frame, first, D2, (1, "a", True, "new"), (2, "B", None, "x"), (3, "c", False, "x"), (5, "e", True, "x"))


def test_merge_outcomes(dim):
    got = {(r.source_id, r.effective_date): r for r in dim.collect()}
    columns = ["name", "expiration_date", "is_current", "change_reason", "changed_fields"]
    first = ("INITIAL_LOAD", "INITIAL_LOAD")
    ended = date(2024, 5, 31)
    assert {k: tuple(r[c] for c in columns) for k, r in got.items()} == {
        (1, D1): ("a", scd2.FOREVER, True, *first),       # unchanged, though an untracked column differs
        (2, D1): ("b", ended, False, *first),
        (2, D2): ("B", scd2.FOREVER, True, "Renamed", "name"),
        (3, D1): (None, ended, False, *first),
        (3, D2): ("c", scd2.FOREVER, True, "Renamed", "name"),   # NULL → value
        (4, D1): ("d", scd2.FOREVER, True, *first),       # absent from staging: kept
        (5, D2): ("e", scd2.FOREVER, True, *first),
    }
    assert got[(1, D1)].extra == "x"


def test_merge_is_idempotent(frame, dim, rows):
    again = load(frame, dim, D3, (1, "a", True, "new"), (2, "B", None, "x"), (3, "c", False, "x"), (5, "e", True, "x"))
    assert rows(again) == rows(dim)


def test_one_current_row_and_no_overlap(dim):
    assert dim.filter("is_current").groupBy("source_id").count().filter("count <> 1").count() == 0
    assert scd2.version_gaps(dim, ["source_id"]).count() == 0


def test_ids_are_unique_and_stable(dim):
    assert dim.select("id").distinct().count() == dim.count()


def test_literal_rules(frame, rows):
    base = load(frame, frame(DIM), D1, (1, None, True, "x"))
    unsafe = scd2.Versioned(keys=["source_id"], tracked=SPEC.tracked, reasons=SPEC.reasons, compat="unsafe", named=["name"])
    row = load(frame, base, D2, (1, "a", True, "x"), spec=unsafe).filter("is_current").first()
    assert (row.change_reason, row.changed_fields) == ("ATTRIBUTE_CHANGE", "")
    initial = scd2.Versioned(keys=["source_id"], tracked=SPEC.tracked, compat="initial")
    row = load(frame, base, D2, (1, "a", True, "x"), spec=initial).filter("is_current").first()
    assert (row.change_reason, row.changed_fields) == ("INITIAL_LOAD", "INITIAL_LOAD")


def test_counts_and_refusal(dim):
    assert scd2.merge_counts(dim, D2).first().asDict() == {"expired": 2, "inserted": 3, "current": 5}
    assert scd2.version_counts(dim).first().asDict() == {"total": 7, "current": 5, "historical": 2}
    scd2.require_later(dim, D3)
    with pytest.raises(ValueError):
        scd2.require_later(dim, D2)


def test_history(dim):
    assert [r.name for r in scd2.history_of(dim, "source_id", 2).collect()] == ["b", "B"]
    assert scd2.versions_changing(dim, "name").count() == 2


# ----------------------------------------------------------------------------- along time

VERSIONS = "id int, source_id int, effective_date date, expiration_date date"


@pytest.fixture
def versions(frame):
    return frame(VERSIONS, (10, 1, D1, date(2024, 5, 31)), (11, 1, D2, scd2.FOREVER), (20, 2, D2, scd2.FOREVER))


def test_version_window_is_half_open(frame, versions, rows):
    facts = frame("f int, k int, d date", (1, 1, D1), (2, 1, date(2024, 5, 30)), (3, 1, date(2024, 5, 31)), (4, 1, D2),
                  (5, 1, date(2023, 1, 1)), (6, 2, D2), (7, 9, D2))
    got = asof.version_at(facts, asof.Role(versions, "k", "v"), "d")
    assert rows(got, "f", "v") == [(1, 10), (2, 10), (4, 11), (6, 20)]


def test_fallback_takes_the_earliest_of_all_dimensions(frame, versions, rows):
    other = frame(VERSIONS, (70, 7, D1, date(2024, 7, 31)), (71, 7, date(2024, 8, 1), scd2.FOREVER))
    facts = frame("nk int, k int, o int, d date, src int",
                  (1, 1, 7, D2, 1),                    # both valid
                  (2, 1, 7, date(2024, 5, 31), 1),     # first dimension on its last day: both fall back
                  (3, 1, 7, date(2020, 1, 1), 1),      # before every version
                  (4, 9, 7, D2, 1),                    # unknown key: no row
                  (5, 1, 7, date(2020, 1, 1), 1), (5, 1, 7, D3, 2))   # one natural key: the valid row wins
    roles = [asof.Role(versions, "k", "v"), asof.Role(other, "o", "w")]
    got = asof.version_or_earliest(facts, roles, "d", ["nk"], [F.col("src")])
    assert rows(got, "nk", "v", "w", "load_phase", "src") == [
        (1, 11, 70, 1, 1), (2, 10, 70, 2, 1), (3, 10, 70, 2, 1), (5, 11, 71, 1, 2)]


@pytest.mark.parametrize("slice_days", [1, 7, 366])
def test_latest_before_matches_brute_force(spark, frame, slice_days):
    rng = random.Random(slice_days)
    days = [date.fromordinal(D1.toordinal() + rng.randrange(60)) for _ in range(400)]
    history = [(rng.randrange(3), d) for d in days[:200]] + [(None, D1), (1, None)]
    events = [(i, rng.choice([0, 0, 0, 1, 2, 3, None]), d) for i, d in enumerate(days[200:])] + [(999, 0, None)]
    expected = {
        i: max((h for k, h in history if k is not None and k == key and h is not None and d is not None and h < d), default=None)
        for i, key, d in events
    }
    got = asof.latest_before(frame("i int, k int, d date", *events), frame("k int, h date", *history), ["k"], "d", "h", "prev", slice_days)
    assert {r.i: r.prev for r in got.collect()} == expected
    assert got.columns == ["i", "k", "d", "prev"]


# ----------------------------------------------------------------------------- keyed writes

def test_insert_absent_keeps_the_target(frame, rows):
    target = frame("k int, v string", (1, "old"))
    new = frame("k int, v string", (1, "new"), (2, "b"), (2, "a"))
    got = upsert.insert_absent(target, new, ["k"], [F.col("v")])
    assert rows(got) == [(1, "old"), (2, "a")]
    assert rows(upsert.insert_absent(got, new, ["k"], [F.col("v")])) == rows(got)


def test_upsert_updates_listed_columns_only(frame, rows):
    target = frame("k int, a string, b string, c string", (1, "a1", "b1", "c1"), (2, "a2", "b2", "c2"))
    new = frame("k int, a string, b string", (1, None, "B1"), (3, "A3", "B3"))
    got = upsert.upsert(target, new, ["k"], ["a"])
    assert rows(got) == sorted([(1, None, "b1", "c1"), (2, "a2", "b2", "c2"), (3, "A3", "B3", None)], key=lambda t: t[0])
    assert rows(upsert.upsert(got, new, ["k"], ["a"])) == rows(got)


# ----------------------------------------------------------------------------- hierarchy and lookups

UNITS = "id int, source_id int, child_id int, admin_unit_type string, name string, current_status boolean"


def test_climb(frame, rows):
    units = frame(
        UNITS, (1, 1, None, "District", "D1", True), (2, 2, None, "District", "D2", True), (3, 10, 1, "County", "C", True),
        (4, 20, 10, "Sub County", "S", True), (5, 30, 20, "Parish", "P", True), (6, 31, 20, "Ward", "W", True),
        (7, 21, 10, "Town Council", "T", True), (8, 11, 2, "Municipality", "M", True), (9, 12, 2, "City", "Ci", True),
        (10, 13, 1, "Village", "V", True), (11, 32, 20, "Parish", "gone", False), (12, 14, 99, "County", "lost", True),
        (13, 10, 2, "City", "shares the county's id", True))
    got = rows(hierarchy.climb(units), "unit_dim_id", "district_name")
    assert sorted(got) == sorted([
        (1, "D1"), (2, "D2"), (3, "D1"), (8, "D2"), (9, "D2"), (13, "D2"),
        (4, "D1"), (4, "D2"), (7, "D1"), (7, "D2"), (5, "D1"), (5, "D2"), (6, "D1"), (6, "D2")])
    assert rows(hierarchy.several_districts(hierarchy.climb(units)), "unit_dim_id") == [(4,), (5,), (6,), (7,)]
    assert sorted(rows(hierarchy.reach(hierarchy.ancestors(units)), "unit_dim_id", "district_name")) == sorted(got)


def test_ancestors_are_refreshed_for_changed_units_only(frame, rows):
    old = [(1, 1, None, "District", "D1", True), (2, 2, None, "District", "D2", True), (3, 10, 1, "County", "C", True),
           (4, 20, 10, "Sub County", "S", True), (5, 30, 20, "Parish", "P", True), (6, 11, 2, "City", "Ci", True), (7, 21, 12, "Sub County", "lost", True)]
    stored = hierarchy.ancestors(frame(UNITS, *old))
    assert rows(stored.filter("unit_dim_id = 5"), "ancestor_dim_id", "depth") == [(1, 3), (3, 2), (4, 1), (5, 0)]
    # The county moves as a new version, a new city becomes the parent of the unit without one, one city goes.
    new = [*old[:2], (3, 10, 1, "County", "C", False), (13, 10, 2, "County", "C", True), *old[3:5], (6, 11, 2, "City", "Ci", False), old[6],
           (14, 12, 1, "City", "new", True)]
    units = frame(UNITS, *new)
    # A mark in the rows of an unchanged unit shows that they are kept.
    marked = stored.withColumn("ancestor_name", F.when(F.col("unit_dim_id") == 2, "kept").otherwise(F.col("ancestor_name")))
    got = hierarchy.refreshed_ancestors(marked, units)
    assert rows(got.filter("unit_dim_id <> 2")) == rows(hierarchy.ancestors(units).filter("unit_dim_id <> 2"))
    assert rows(got.filter("unit_dim_id = 2"), "ancestor_name") == [("kept",)]
    assert rows(hierarchy.refreshed_ancestors(stored.limit(0), units)) == rows(hierarchy.ancestors(units))


def test_cycles_of_units_are_found(frame, rows):
    units = frame(UNITS, (1, 1, 2, "District", "a", True), (2, 2, 1, "County", "b", True), (3, 3, 1, "County", "c", True), (4, 4, 4, "Parish", "d", True))
    assert rows(hierarchy.above_themselves(hierarchy.ancestors(units))) == [(1,), (2,), (4,)]


def test_first_available_prefers_order_then_lowest(frame, rows):
    df = frame("r int, a int, b int", (1, 5, 6), (2, 99, 6), (3, None, None))
    table = frame("key int, id int", (5, 52), (5, 51), (6, 60))
    assert rows(lookup.first_available(df, ["a", "b"], table, "found", "key", "id"), "r", "found") == [(1, 51), (2, 60), (3, None)]
    # Ids that resolve to NULL pass their turn on; rows without any id, repeated rows and equal tuples stay as they are.
    df = frame("r int, a int, b int", (1, 7, 6), (1, 7, 6), (2, None, None), (3, None, 5), (4, 6, None))
    table = frame("key int, id int", (5, 52), (6, 60), (7, None), (None, 9))
    got = rows(lookup.first_available(df, ["a", "b"], table, "found", "key", "id"))
    assert got == [(1, 7, 6, 60), (1, 7, 6, 60), (2, None, None, None), (3, None, 5, 52), (4, 6, None, 60)]


def test_expand_periods(frame, rows):
    people = frame("p int, school int", (1, 7), (2, 8))
    periods = frame("term string, only int", ("T1", None), ("T2", None), ("X", 8))
    got = lookup.expand_periods(people, periods, "school", "only")
    assert rows(got, "p", "term") == [(1, "T1"), (1, "T2"), (2, "T1"), (2, "T2"), (2, "X")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


# ----------------------------------------------------------------------------- shapes

def test_keyword_flags(frame, rows):
    df = frame("k int, t string", (1, "Self Care"), (1, "hearing loss"), (2, "SELF_CARE"), (3, None))
    flags = {"care": ["%SELF%CARE%", "%SELF_CARE%"], "hearing": ["%HEARING%"]}
    assert rows(shape.keyword_flags(df, "k", "t", flags)) == [(1, True, True), (2, True, False), (3, None, None)]


def test_totals_and_parity(frame, rows):
    df = frame("d int, g string, n bigint", (1, "F", 6), (1, "M", 4), (1, "?", 9), (2, "F", 5), (3, "M", 0), (3, "F", 2))
    full = shape.with_totals(df, ["d"], ["n"], "g", members=F.col("g").isin("M", "F"))
    assert rows(full.filter("g = 'TOTAL'"), "d", "n") == [(1, 10), (2, 5), (3, 2)]
    got = shape.parity(full.withColumn("p", F.lit(None).cast("decimal(8,4)")), ["d"], "g", {"p": "n"}, ["F"], ["M"])
    found = {(r.d, r.g): r.p for r in got.collect()}
    assert str(found[(1, "TOTAL")]) == "1.5000"
    assert found[(2, "TOTAL")] is None and found[(3, "TOTAL")] is None and found[(1, "F")] is None


def test_attach_max_groups_nulls(frame, rows):
    df = frame("k int, v int", (1, 1), (1, 3), (None, 5), (None, 2))
    got = shape.attach_max(df, ["k"], {"top": (F.col("v") > 0, F.col("v"))})
    assert rows(got, "v", "top") == [(1, 3), (2, 5), (3, 3), (5, 5)]


# ----------------------------------------------------------------------------- quality

def test_rules(frame):
    counts = frame(quality.COUNT_COLUMNS, ("empty", 0, None), ("low", 5, None), ("enough", 50, None), ("bad", 1, None), ("tolerated", 9, None),
                   ("note", 3, None), ("near", 1, 1000), ("far", 20, 1000), ("nothing", 0, 0))
    near = quality.VarianceRule(bad="WARNING")
    rules = {
        "empty": quality.non_empty(soft_floor=10), "low": quality.non_empty(soft_floor=10), "enough": quality.non_empty(soft_floor=10),
        "bad": quality.none_allowed("WARN"), "tolerated": quality.Rule(bad="WARN", at_most=10), "note": quality.informative("INFO"),
        "near": near, "far": near, "nothing": near,
    }
    log = quality.run_checks("M", [counts], rules, D1)
    assert {r.check_name: r.status for r in log.collect()} == {
        "empty": "FAIL", "low": "WARN", "enough": "PASS", "bad": "WARN", "tolerated": "PASS", "note": "INFO", "near": "PASS",
        "far": "WARNING", "nothing": "WARNING"}
    assert quality.summarise(log).first().asDict() == {
        "run_date": D1, "mart": "M", "passed": 3, "warned": 4, "failed": 1, "info": 1}
    with pytest.raises(RuntimeError, match="empty"):
        quality.raise_on_failure(log, "M")
    quality.raise_on_failure(log.filter("check_name <> 'empty'"), "M")


def test_counting_functions(frame):
    parent = frame("id int", (1,), (2,))
    child = frame("ref int", (1,), (1,), (3,), (3,), (None,))

    def n(df):
        return df.first().row_count

    assert n(quality.orphans("c", child, "ref", parent)) == 3
    assert n(quality.uncovered("c", parent, ["id"], child, ["ref"])) == 1
    assert n(quality.repeated("c", child, ["ref"])) == 2
    assert n(quality.distinct_values("c", child, "ref")) == 2
    v = quality.variance("c", parent, child).first()
    assert (v.row_count, v.base) == (3, 5)
    t = quality.tally(child, {"a": F.col("ref").isNull(), "b": F.lit(True)})
    assert {r.check_name: r.row_count for r in t.collect()} == {"a": 1, "b": 5}


def test_reconcile(frame):
    staged = frame("a int, b string", (1, "x"), (2, "y"), (2, "z"))
    fact = frame("k int, c string", (1, "x"), (2, "y"))
    assert quality.reconcile(staged, fact, {"a": "k", "b": "c"}).first().asDict() == {
        "fact_total": 2, "staged_total": 3, "unresolved": 1}


def test_differences_are_found_by_key(frame, rows):
    schema = "year int, k int, a string, b double"
    staged = frame(schema, (1, 1, "x", 1.0), (1, 2, None, 2.0), (2, 3, "z", None), (2, 4, "w", 4.0), (None, 5, "n", 5.0), (3, 6, "v", 6.0), (3, 6, "v", 6.0))
    fact = frame("y bigint, id bigint, a string, b double", (1, 1, "x", 1.0), (1, 2, "2.0", None), (2, 3, "z", None), (2, 7, "w", 4.0), (None, 5, "n", 5.5), (3, 6, "v", 6.0))
    got = quality.differences(staged, fact, {"year": "y", "k": "id"}, {"a": "a", "b": "b"}, "year", buckets=2)
    assert rows(got, "k", "difference") == [(2, "changed"), (4, "missing"), (5, "changed"), (6, "changed"), (7, "extra")]
    assert quality.differences(staged, staged, {"year": "year", "k": "k"}, {"a": "a", "b": "b"}, "year").count() == 0
    assert quality.differences(staged, fact.limit(0), {"year": "y", "k": "id"}, {}, "year").count() == 6
    # Values that two keys exchange leave all counts and column sums as they were.
    swapped = frame(schema, (1, 1, None, 2.0), (1, 2, "x", 1.0))
    got = quality.differences(staged.filter("year = 1"), swapped, {"year": "year", "k": "k"}, {"a": "a", "b": "b"}, "year")
    assert rows(got, "k", "difference") == [(1, "changed"), (2, "changed")]


# ----------------------------------------------------------------------------- distinct counts

def test_dense_numbers_are_unique_and_near(frame, rows):
    df = frame("id long, place int", *[(i * 7919 % 1000, i % 5) for i in range(1000)], (None, 1), (3, 9))
    got = distinct.dense_numbers(df.repartition(7), "id", near="place").collect()
    assert sorted(r.id for r in got) == list(range(1000)) and len({r.number for r in got}) == 1000
    assert len({r.number // 32768 for r in got}) <= 8


def test_distinct_counts_equal_count_distinct(spark, frame, rows):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-3, 40)]), rng.choice([None, *range(90_000, 90_900)]), rng.choice([None, 1, 2]))
            for _ in range(3000)] + [("only nulls", None, None, None), ("one", 1, 90_000, 4), ("one", 1, 90_000, 4)]
    df = frame("k string, x long, y long, v int", *data)
    plain = df.groupBy("k").agg(F.count_distinct("x").alias("xs"), F.count_distinct("y").alias("ys"), F.sum("v").alias("v"))
    both = distinct.numbered(distinct.numbered(df, "x", "x_no"), "y", "y_no", near="x")
    got = distinct.distinct_counts(both, ["k"], {"xs": F.col("x_no"), "ys": F.col("y_no")}, {"v": F.col("v")})
    assert rows(got.select(plain.columns)) == rows(plain)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    # Numbers that lie thousands of bitmaps apart, and no keys at all.
    wide = distinct.distinct_counts(df, [], {"ys": F.col("y") * 1_000_003})
    assert wide.first().ys == df.agg(F.count_distinct("y")).first()[0]
    assert distinct.distinct_counts(df.limit(0), [], {"ys": F.col("y")}).first().ys == 0
    assert distinct.distinct_counts(df.limit(0), ["k"], {"ys": F.col("y")}).count() == 0


def test_distinct_counts_roll_up(frame, rows):
    df = frame("school int, district string, teacher long, pay int", (1, "A", 10, 5), (1, "A", 11, 5), (2, "A", 10, 7), (3, "B", 10, 1),
               (3, "B", 10, 1), (4, None, 12, 2))
    maps = distinct.bitmaps(distinct.numbered(df, "teacher", "no", near="school"), ["school", "district"], {"teachers": F.col("no")}, {"pay": F.col("pay")})
    got = distinct.roll_up(maps, {"school": F.col("school"), "district": F.col("district"), "nation": F.lit("all")}, ["teachers"], ["pay"])
    assert sorted((r.level, r.place or "", r.teachers, r.pay) for r in got.collect()) == [
        ("district", "", 1, 2), ("district", "A", 2, 17), ("district", "B", 1, 2), ("nation", "all", 3, 21),
        ("school", "1", 2, 10), ("school", "2", 1, 7), ("school", "3", 1, 2), ("school", "4", 1, 2)]


# ----------------------------------------------------------------------------- watermarks

def test_watermark(frame):
    marks = frame("source_name string, last_success_ts timestamp, last_run_id int")
    rows_ = frame("id int, ts timestamp", *[(i, datetime(2024, 1, i)) for i in (1, 2, 3)])
    assert incremental(rows_, "ts", last_success(marks, "s")).count() == 3
    marks = advance(marks, "s", rows_.filter("id < 3"), "ts", 7)
    assert marks.first().last_run_id == 7
    assert [r.id for r in incremental(rows_, "ts", last_success(marks, "s")).collect()] == [2, 3]
    back = advance(marks, "s", rows_.filter("id = 1"), "ts", 8)
    assert back.first().last_success_ts.day == 2
    assert advance(marks, "s", rows_.filter("id > 9"), "ts", 9).first().last_run_id == 7
