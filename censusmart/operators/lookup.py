"""Lookup joins. No join here carries a broadcast hint: Spark compares the lookup's size with
``spark.sql.autoBroadcastJoinThreshold`` and shuffles (with AQE skew handling) beyond it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: str | Column,
    take: Mapping[str, str],
    key: str = "id",
    how: str = "left",
) -> DataFrame:
    """Attach columns of ``table`` (``{column: new name}``) where ``table.key`` equals ``on``."""
    value = F.col(on) if isinstance(on, str) else on
    side = table.select(
        F.col(key).alias("_lookup_key"), *[F.col(c).alias(name) for c, name in take.items()]
    )
    return df.join(side, value == F.col("_lookup_key"), how).drop("_lookup_key")


def decode_ids(df: DataFrame, steps: Sequence[tuple[DataFrame, str, Mapping[str, str]]]) -> DataFrame:
    """A chain of left lookups: ``[(table, id column of df, {column: new name}), …]``."""
    for table, on, take in steps:
        df = lookup(df, table, on, take)
    return df


def first_available(
    df: DataFrame, ids: Sequence[str], table: DataFrame, name: str, key: str, value: str,
    age: str | None = None,
) -> DataFrame:
    """The lookup value of the first id column that resolves.

    The lookup is reduced to one value per key first (the lowest, or the one of the lowest
    ``age``), so the result keeps one row per input row. The different id tuples send out their ids
    with the turn of each; these meet the lookup in a single join, NULL ids not at all, and the
    earliest turn that resolves goes back to the rows.
    """
    rank = F.struct(*([F.col(age)] if age else []), F.col(value).alias("v"))
    one = table.groupBy(F.col(key).alias("_k")).agg(F.min(rank)["v"].alias("_v")).filter("_v is not null")
    asked = F.when(F.coalesce(*[F.col(c) for c in ids]).isNotNull(), F.array(*[F.col(c).cast("bigint") for c in ids]))
    tuples = df.select(asked.alias("_ids")).dropna().distinct()
    turns = tuples.select("_ids", F.posexplode("_ids").alias("_turn", "_id")).dropna(subset=["_id"])
    found = turns.join(one, F.col("_id") == F.col("_k")).groupBy("_ids").agg(F.min_by("_v", "_turn").alias(name))
    return df.withColumn("_asked", asked).join(found, F.col("_asked") == F.col("_ids"), "left").drop("_asked", "_ids")


def expand_periods(
    people: DataFrame, periods: DataFrame, school: str = "school_id",
    period_school: str | None = None,
) -> DataFrame:
    """Every person row once per period row.

    The general periods travel as one array inside the plan and are exploded in place: no cross join
    and no shuffle of the people. The callers give one row per year and term, so the array's length follows from that
    key. School-specific periods, if ``period_school`` names their school column, become one array per school
    that joins on the school; both arrays are exploded together, so the people are planned once.
    """
    fields = [c for c in periods.columns if c != period_school]
    general = periods if period_school is None else periods.filter(F.col(period_school).isNull())
    listed = F.sort_array(F.collect_list(F.struct(*fields)))
    everywhere = general.agg(listed.alias("p")).scalar()
    if period_school is None:
        return people.withColumn("_p", F.explode(everywhere)).select("*", "_p.*").drop("_p")
    own = (periods.filter(F.col(period_school).isNotNull()).groupBy(F.col(period_school).alias("_period_school"))
           .agg(listed.alias("_own")))
    both = F.when(F.col("_own").isNull(), everywhere).otherwise(F.concat(everywhere, F.col("_own")))
    return (people.join(own, F.col(school) == F.col("_period_school"), "left").withColumn("_p", F.explode(both))
            .drop("_own", "_period_school").select("*", "_p.*").drop("_p"))
