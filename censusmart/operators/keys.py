"""One row per key, unique keys and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    ``row_number() = 1`` lets Spark limit each key inside the map tasks (WindowGroupLimit), so a
    hot key sends one row per map task over the network, not all of its rows. End ``order_by``
    with a unique column: ties are otherwise broken by arrival.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def unique_or_null(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is NULL or occurs exactly once; every row of a repeated key goes.

    Only the repeated keys (counted with a map-side combine) meet the rows in a join, and the
    NULL keys stay out of it: a window over the key would send all NULLs to one task.
    """
    repeated = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    keyed = df.filter(F.col(key).isNotNull()).join(repeated.select(key), key, "left_anti")
    return df.filter(F.col(key).isNull()).unionByName(keyed.select(df.columns))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` itself; raises when a key repeats. Runs one aggregation job."""
    clash = duplicates(df, keys).limit(1).collect()
    if clash:
        raise ValueError(f"{what}: key {tuple(keys)} repeats, e.g. {clash[0].asDict()}")
    return df


def surrogate_key(*natural: Column) -> Column:
    """64-bit hash of the natural key: needs no global numbering and is stable across reruns.

    Two of n keys collide with probability about n² / 2⁶⁵, so ``require_unique`` checks every new
    dimension before it is used; facts carry their natural keys and are never joined by this id.
    """
    return F.xxhash64(*natural)
