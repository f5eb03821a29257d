"""Collects the queries with their SQL statements."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.world import World, statement

QUERIES: dict[str, Callable[[World], DataFrame]] = {}
SQL: dict[str, str] = {}

TODAY = date(2025, 1, 15)


def register(name: str, build: Callable[[World], DataFrame], sql: str | None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = build
    if sql is not None:
        SQL[name] = statement(sql)


def query(sql: str | None = None, name: str | None = None):
    """Register the decorated function under its own name, with the equivalent SQL."""
    def keep(build: Callable[[World], DataFrame]):
        register(name or build.__name__, build, sql)
        return build
    return keep


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles: DuckDB's decimal types differ from Spark's, the values do not."""
    wide = {f.name: F.col(f"`{f.name}`").cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(wide) if wide else df


def stack(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def pct(part: str, whole: str, scale: int, factor: int = 100) -> str:
    """SQL: ``round(part * factor / whole, scale)`` in whole numbers, half away from zero; NULL on 0.

    Integer arithmetic keeps the oracle exact where a floating-point quotient sits on a tie.
    """
    shift = 10 ** scale
    n, d = f"CAST({part} AS HUGEINT)", f"CAST(nullif({whole}, 0) AS HUGEINT)"
    return f"CAST((2 * {n} * {factor * shift} + {d}) // (2 * {d}) AS DOUBLE) / {shift}"


def mean(column: str, decimals: int, scale: int) -> str:
    """SQL: the average of a decimal column with ``decimals`` places, rounded exactly to ``scale``."""
    total = f"CAST(sum({column}) * {10 ** decimals} AS HUGEINT)"
    shift = 10 ** scale
    d = f"nullif(count({column}) * {10 ** decimals}, 0)"
    return f"CAST((2 * {total} * {shift} + {d}) // (2 * {d}) AS DOUBLE) / {shift}"
