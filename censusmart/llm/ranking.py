"""Ranks over a whole table without one task for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from censusmart.llm.storage import saved


def with_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df``, saved, with its rows numbered from 0 in ``order`` (which should leave no ties).

    The rows are range-partitioned and sorted by Spark; a row's number is its place in its partition and the rows of the
    partitions before it. Only the partitions' row counts meet in one window.
    """
    place = 1 << 33  # Fixed value: monotonically_increasing_id is the partition times 2**33 and the row's place in it.
    rows = saved(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.floor(F.col("_at") / place).cast("long")
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (rows.withColumn("_part", part).join(offsets, "_part")
            .withColumn(name, F.col("_before") + F.col("_at") - F.col("_part") * place).drop("_part", "_at", "_before"))
