"""Running totals over groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from censusmart.llm.storage import saved

ROWS_PER_RANGE = 16384
MANY_RANGES = 4096
MOST_ROWS_PER_RANGE = 1 << 20


def ranged(df: DataFrame, n_rows: int, order: list, name: str) -> DataFrame:
    """``df``, saved, with ``_range``: the number of the row's range in ``order``, which should leave no ties.

    Spark samples the order and cuts it into ranges of nearly equal numbers of rows, whatever the values are. A range
    has about ``ROWS_PER_RANGE`` rows; beyond ``MANY_RANGES`` ranges, which are tasks, up to ``MOST_ROWS_PER_RANGE``. The frame
    is written, since a second evaluation would sample again.
    """
    n = max(min(-(-n_rows // ROWS_PER_RANGE), MANY_RANGES), -(-n_rows // MOST_ROWS_PER_RANGE), 1)
    return saved(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), name)


def running_total(df: DataFrame, by: list[str], bucket: Column, order: list, value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same ``by`` up to and with this row.

    ``bucket`` must not fall along ``order`` and should hold a bounded number of rows per value. Buckets are
    summed first (map-side), their sums accumulated over the few bucket rows of a group, and a
    window runs inside each bucket only; so a group that holds most rows is spread over its buckets.
    ``by`` columns must not be null.
    """
    placed = df.withColumn("_bucket", bucket)
    keys = [*by, "_bucket"]
    sums = placed.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (placed.join(offsets, keys)
            .withColumn(name, F.col("_before") + F.sum(value).over(inside))
            .drop("_bucket", "_before"))
