"""Registered queries over the given tables, each with an independent SQL statement."""

from workload import operators, marts, reports, checks  # noqa: F401  (importing registers the queries)
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
