"""Headline queries at one scale; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name …]

Each query runs to the end (every column of every row) into a sink that keeps nothing. The first
round warms the JVM up and is not counted; the figure per query is the median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from censusmart.session import local_session
from workload import QUERIES
from workload.world import World

HEADLINES = [
    "scd2_merge", "learners_merge", "asof_version_join", "asof_fallback_fact", "latest_before", "insert_absent",
    "upsert_partial", "latest_per_key", "unique_or_null_key", "window_pivot", "bool_or_flags", "schools_flatten",
    "enrolments_flatten", "enrolment_fact", "teachers_flatten", "hr_fact", "staff_fact", "infrastructure_fact",
    "transfers_extract", "enrolment_indicators", "school_indicators", "teachers_district_leaderboard",
    "teachers_ptr_by_district", "infra_full_leaderboard", "subjects_science_vs_arts_by_district", "leaderboard",
    "dq_enrolment", "dq_infrastructure",
]
RUNS = 3


def timed(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](World(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        timed(spark, sf_dir, name)
    seconds = {n: round(statistics.median(timed(spark, sf_dir, n) for _ in range(RUNS)), 3) for n in names}
    print(json.dumps({
        "metric": "census mart headline queries, total of medians", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
