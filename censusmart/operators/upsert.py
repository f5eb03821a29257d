"""Keyed writes as DataFrame rewrites: insert-if-absent and partial update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.operators.keys import first_per_key


def absent(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key is not in ``target``: what an append has to write."""
    return new.join(target.select(*keys), list(keys), "left_anti").select(new.columns)


def insert_absent(
    target: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None
) -> DataFrame:
    """``target`` plus the rows of ``new`` with unseen keys; existing rows stay untouched.

    With ``order_by`` a key that repeats inside ``new`` keeps its first row in that order.
    """
    batch = new if order_by is None else first_per_key(new, keys, order_by)
    return target.unionByName(absent(target, batch, keys), allowMissingColumns=True)


def upsert(
    target: DataFrame, new: DataFrame, keys: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """Update the listed columns of matching rows and insert the rest of ``new``.

    A matching row keeps its old value in every column that is not listed. ``new`` must hold one
    row per key (``first_per_key`` or ``require_unique`` beforehand).
    """
    columns = target.columns
    old = target.select(F.struct(*columns).alias("o"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    fresh = new.select(F.struct(*new.columns).alias("n"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    on = [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys]
    merged = old.join(fresh, on, "full_outer")
    has_old, has_new = F.col("o").isNotNull(), F.col("n").isNotNull()

    def value(name: str) -> Column:
        if name not in new.columns:
            return F.col(f"o.{name}")
        incoming = F.col(f"n.{name}").cast(target.schema[name].dataType)
        take_new = has_new if name in update_cols or name in keys else ~has_old
        return F.when(take_new, incoming).otherwise(F.col(f"o.{name}"))

    return merged.select(*[value(c).alias(c) for c in columns])
