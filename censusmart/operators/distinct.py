"""Exact distinct counts of several columns in one pass, by bitmaps over dense numbers.

Several ``count_distinct`` of one aggregation replicate every row once per column. Here each counted value has a dense
number, and an aggregation keeps one bit per number: 4 KB for 32,768 of them. Bitmaps of a school add up (by OR) to
those of its district and of the nation, which counts do not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dense_numbers(df: DataFrame, column: str, near: str | None = None) -> DataFrame:
    """Every different value of ``column`` with a ``number``; NULL has none.

    Values are numbered in the order of the smallest ``near`` they occur with, so that the values of one school lie in few
    bitmaps. Tasks number their own range of values: each starts at a multiple of 2³³ and counts on, and a range that
    is computed again after a lost executor gets the same numbers. Two calls may number differently.
    """
    first = F.min(near) if near else F.lit(None).cast("long")
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(first.alias("_near"))
    ordered = values.repartitionByRange("_near", column).sortWithinPartitions("_near", column)
    return ordered.select(column, F.monotonically_increasing_id().alias("number"))


def numbered(df: DataFrame, column: str, name: str, near: str | None = None) -> DataFrame:
    """``df`` with the dense number of ``column`` as ``name``, NULL for NULL."""
    numbers = dense_numbers(df, column, near).select(F.col(column).alias("_value"), F.col("number").alias(name))
    return df.join(numbers, F.col(column) == F.col("_value"), "left").drop("_value")


def bitmaps(
    df: DataFrame, keys: Sequence[str], numbers: Mapping[str, Column], sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """Per key the bitmaps of every counted column: rows ``(*keys, counted, bucket, bitmap, *sums)``.

    ``numbers`` gives ``{count: dense number}``; ``sums`` are summed on the way, on the rows of the first count. The rows
    are combined inside the map tasks to one row per key and combination of buckets, which then holds one bitmap per
    count. So one of the columns may have very many values, or several that are numbered near each other.
    """
    sums = sums or {}
    slots = {name: f"_slot_{i}" for i, name in enumerate(numbers)}
    reduced = df.groupBy(*keys, *[F.bitmap_bucket_number(n).alias(slots[name]) for name, n in numbers.items()]).agg(
        *[F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias(f"_map_{name}") for name, n in numbers.items()],
        *[F.sum(v).alias(s) for s, v in sums.items()],
    )
    entries = [
        F.struct(
            F.lit(name).alias("counted"), F.col(slots[name]).alias("bucket"), F.col(f"_map_{name}").alias("bitmap"),
            *[F.when(F.lit(i == 0), F.col(s)).alias(s) for s in sums],
        )
        for i, name in enumerate(numbers)
    ]
    return reduced.select(*keys, F.inline(F.array(*entries)))


def counts(maps: DataFrame, keys: Sequence[str], names: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """The counts ``names`` and the ``sums`` per key, from bitmaps of the same or of finer keys."""
    merged = maps.groupBy(*keys, "counted", "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"), *[F.sum(s).alias(s) for s in sums]
    )
    bits = F.bitmap_count("bitmap")
    return merged.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("counted") == n, bits)), F.lit(0)).alias(n) for n in names],
        *[F.sum(s).alias(s) for s in sums],
    )


def distinct_counts(
    df: DataFrame, keys: Sequence[str], numbers: Mapping[str, Column], sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """Per key the number of different values of every column in ``numbers``, with sums."""
    return counts(bitmaps(df, keys, numbers, sums), keys, list(numbers), list(sums or {}))


def roll_up(
    maps: DataFrame, levels: Mapping[str, Column], names: Sequence[str], sums: Sequence[str] = ()
) -> DataFrame:
    """Counts at several levels, rows ``(level, place, …)``; ``levels`` gives the place of a bitmap row at each level.

    The bitmaps are computed once and sent to all their levels, where the map tasks combine them.
    """
    at = F.array(*[F.struct(F.lit(level).alias("level"), place.cast("string").alias("place")) for level, place in levels.items()])
    sent = maps.select("counted", "bucket", "bitmap", *sums, F.inline(at))
    return counts(sent, ["level", "place"], names, sums)
