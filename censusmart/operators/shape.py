"""Group-wise reshaping: attribute pivots, keyword flags, totals, parity, report metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from censusmart.functions.labels import matches_any
from censusmart.functions.numbers import ratio


def pivot_max(
    df: DataFrame, keys: Sequence[str], picks: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Per key, ``{name: max of value where predicate}`` for each ``(predicate, value)`` pick."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(test, value)).alias(name) for name, (test, value) in picks.items()]
    )


def attach_max(
    df: DataFrame, keys: Sequence[str], picks: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Every row of ``df`` with its key's ``pivot_max`` values (a partition-wide window maximum).

    The maxima come from a combined aggregation joined back, so a hot key never sorts into one
    window task; NULL keys form a group of their own.
    """
    tops = pivot_max(df, keys, picks)
    side = tops.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *picks
    )
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(side, on, "left").drop(*[f"_k_{k}" for k in keys])


def keyword_flags(
    df: DataFrame, key: str, text: str, flags: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Per key, one boolean per flag: whether any text matches one of the flag's patterns."""
    return df.groupBy(key).agg(
        *[F.bool_or(matches_any(F.col(text), p)).alias(name) for name, p in flags.items()]
    )


def with_totals(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], over: str, label: str = "TOTAL",
    members: Column | None = None,
) -> DataFrame:
    """Detail rows plus one ``label`` row per key that sums the ``members`` of column ``over``.

    ``df`` holds one row per key and ``over``. Every member row is sent out twice, under its own
    value and under the label, and one aggregation sums both: the input, often a large aggregate
    itself, is computed once, where a union of detail and total would compute it twice.
    """
    own = F.col(over)
    both = F.array(own, F.lit(label))
    if members is not None:
        both = F.when(members, both).otherwise(F.array(own))
    sent = df.select(*keys, *measures, F.explode(both).alias(over))
    return sent.groupBy(*keys, over).agg(*[F.sum(m).alias(m) for m in measures]).select(df.columns)


def parity(
    df: DataFrame, keys: Sequence[str], over: str, measures: Mapping[str, str],
    top: Sequence[str], bottom: Sequence[str], label: str = "TOTAL", scale: int = 4,
) -> DataFrame:
    """Fill ``{output: measure}`` on the ``label`` rows with measure(top) / measure(bottom).

    ``df`` holds one row per key and ``over``, so a key's window is a handful of rows and both
    genders are read in one pass. The output stays as it was where a key lacks one of them.
    """
    per_key = Window.partitionBy(*keys)

    def pick(names: Sequence[str], measure: str) -> Column:
        side = F.upper(F.col(over)).isin(*names)
        return F.max(F.when(side, F.struct(F.lit(True).alias("present"), F.col(measure).alias("m")))).over(per_key)

    for o, m in measures.items():
        df = df.withColumns({"_top": pick(top, m), "_bottom": pick(bottom, m)})
        both = F.col("_top").isNotNull() & F.col("_bottom").isNotNull()
        numerator, denominator = F.coalesce(F.col("_top.m"), F.lit(0)), F.col("_bottom.m")
        value = F.when(denominator > 0, ratio(numerator, denominator, scale)).cast(df.schema[o].dataType)
        is_total = F.upper(F.col(over)) == label
        df = df.withColumn(o, F.when(is_total & both, value).otherwise(F.col(o))).drop("_top", "_bottom")
    return df


# The aggregates a report metric may name.
METRICS = {
    "MAX": F.max, "MIN": F.min, "SUM": F.sum, "AVG": F.avg, "COUNT": F.count,
    "COUNT_DISTINCT": F.count_distinct,
}


def apply_metric(
    dataset: DataFrame, dims: Sequence[str], metrics: Sequence[tuple[str, str]], series: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """A chart's query over a dataset: aggregates by dimensions and series, largest first metric first.

    A metric is ``(aggregate, column)``; its result carries the column's name.
    """
    keys = [*dims, *series]
    grouped = dataset.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        *[METRICS[how](F.col(f"`{column}`")).alias(column) for how, column in metrics]
    )
    if limit is None:
        return grouped
    first = F.col(f"`{metrics[0][1]}`")
    return grouped.orderBy(first.desc_nulls_last(), *[F.col(f"`{k}`").asc_nulls_last() for k in keys]).limit(limit)
