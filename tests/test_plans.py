"""The shape of the physical plans: what is scanned, limited, shuffled, and never crossed."""

import re

import pytest
from pyspark.sql import functions as F

from censusmart.operators import asof, keys, shape
from tests.conftest import SF
from workload import QUERIES
from workload.world import World


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


NO_CROSS = [
    "period_expand", "teachers_flatten", "staff_flatten", "enrolments_flatten", "latest_before", "asof_fallback_fact",
    "teaching_subject_fact", "transfer_fact", "hierarchy_rollup", "enrolment_indicators", "school_indicators",
]


@pytest.mark.parametrize("name", NO_CROSS)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](World(spark, SF)))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in plan


def test_scan_reads_needed_columns_and_pushes_filters(spark):
    plan = QUERIES["incremental_pull"](World(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "props" not in plan
    plan = plan_of(QUERIES["latest_per_key"](World(spark, SF)))
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan


def test_merge_joins_once(spark):
    plan = plan_of(QUERIES["learners_merge"](World(spark, SF)))
    assert len(re.findall(r"(SortMergeJoin|HashJoin).*FullOuter", plan)) == 1


def test_conditional_distinct_counts_do_not_expand(spark):
    for name in ("teachers_district_leaderboard", "leaderboard", "teachers_trend_over_time", "nts_district_leaderboard",
                 "teachers_ptr_by_district", "subjects_by_category", "subjects_by_level", "distinct_rollup"):
        assert "Expand" not in plan_of(QUERIES[name](World(spark, SF)))


def test_totals_scan_their_input_once(spark):
    w = World(spark, SF)
    detail = w["orders"].groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    plan = plan_of(shape.with_totals(detail, ["o_custkey"], ["n"], "o_orderstatus"))
    assert plan.count("FileScan") == 1


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key, another third have none."""
    n = F.col("id")
    return spark.range(60_000).select(
        F.when(n % 3 == 0, F.lit(7)).when(n % 3 == 1, n + 1000).alias("k"), n.alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 900).cast("int")).alias("d"))


def rows_through_shuffles(spark, df) -> int:
    """Rows written by all hash exchanges of a finished plan."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if name == "Exchange" and node.metrics().contains("shuffleRecordsWritten"):
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_hot_key_is_limited_before_the_shuffle(spark, skewed):
    hot = skewed.filter("k = 7")
    first = keys.first_per_key(hot, ["k"], [F.col("d"), F.col("id")])
    assert rows_through_shuffles(spark, first) <= 8       # one row per map task, of 20 000
    assert first.first().id == 0


def test_null_keys_stay_out_of_the_join(spark, skewed):
    got = keys.unique_or_null(skewed.select("k", "id"), "k")
    assert got.count() == 40_000 and got.filter("k is null").count() == 20_000
    keyless, keyed = plan_of(got).split("Union")[1].split(":- ")[1].split("+- ", 1)[0], plan_of(got)
    assert "Join" not in keyless and "Join" in keyed


def test_backward_join_shuffles_points_not_rows(spark, skewed):
    """900 days exist: however many rows a hot key has, its windows hold at most those points."""
    events, history = skewed.select("id", "k", "d"), skewed.filter("id % 2 = 0").select("k", F.col("d").alias("h"))
    got = asof.latest_before(events, history, ["k"], "d", "h", "prev")
    expected = skewed.filter("k = 7 and id % 2 = 0").select("d").distinct()
    day = F.lit("2025-06-01").cast("date")
    want = expected.filter(F.col("d") < day).agg(F.max("d")).first()[0]
    assert got.filter((F.col("k") == 7) & (F.col("d") == day)).select("prev").distinct().collect() in ([], [(want,)])
    assert got.count() == 60_000 and got.filter("k is null and prev is not null").count() == 0


def test_reference_checks_of_a_suite_share_a_scan_and_a_join(spark):
    """With broadcasting off: every fact is read once for all its references."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "-1")
    try:
        plans = {name: plan_of(QUERIES[name](World(spark, SF))) for name in ("dq_enrolment", "dq_infrastructure")}
    finally:
        spark.conf.unset(limit)
    counts = {name: (len(re.findall(r"Exchange (?:hash|Single)", plan)), plan.count("FileScan")) for name, plan in plans.items()}
    assert counts["dq_enrolment"][0] < 24 and counts["dq_enrolment"][1] < 17
    assert counts["dq_infrastructure"][0] < 22 and counts["dq_infrastructure"][1] < 13
