"""Census tables derived from the given tables, one definition for both engines.

The given tables hold no school data, so the census tables are defined as views over them:
suppliers act as schools, customers as teachers, parts as staff, building types and subjects,
orders as learners and lineitems as enrolments, postings and status records; regions and nations
become lookups and administrative units. A definition is plain SQL that Spark and DuckDB both
read. ``World`` hands them to the library as DataFrames, ``statement`` puts them before an
independent SQL query as common table expressions.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from censusmart.operators.hierarchy import ancestors
from workload.definitions import VIEWS

# Declared schemas of the given tables that the queries read: no inference job per read.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
PLACEHOLDER = re.compile(r"\{(\w+)\}")


class World(dict):
    """Given tables (``orders``) and census tables (``dw.schools_dim``) as DataFrames, on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str, **replaced: DataFrame):
        super().__init__(replaced)
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name in GIVEN:
            df = self.spark.read.schema(GIVEN[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        elif name == "dw.unit_ancestor":
            # The SQL statements climb the units themselves, so the table comes from the library.
            df = ancestors(self["dw.admin_units_dim"])
        else:
            text = VIEWS[name.replace(".", "_", 1)]
            inputs = {n: self[n] for n in PLACEHOLDER.findall(text)}
            df = self.spark.sql(text, **inputs)
        self[name] = df
        return df


@cache
def _needed(name: str) -> tuple[str, ...]:
    """The views that ``name`` rests on, inner ones first, itself last."""
    order: list[str] = []
    for inner in PLACEHOLDER.findall(VIEWS[name]):
        if inner not in GIVEN:
            order += [n for n in _needed(inner) if n not in order]
    return (*order, name)


def statement(body: str) -> str:
    """``body`` with the views it mentions as ``{name}`` defined in front of it."""
    order: list[str] = []
    for name in PLACEHOLDER.findall(body):
        if name in VIEWS:
            order += [n for n in _needed(name) if n not in order]
    plain = PLACEHOLDER.sub(r"\1", body)
    if not order:
        return plain
    ctes = ",\n".join(f"{n} AS ({PLACEHOLDER.sub(r'\1', VIEWS[n])})" for n in order)
    if plain.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{plain.lstrip()[5:]}"
    return f"WITH {ctes}\n{plain}"
