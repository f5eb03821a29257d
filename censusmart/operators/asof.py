"""Joins along time: the version valid on a date, and the latest earlier record."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from censusmart.operators.keys import first_per_key


@dataclass(frozen=True)
class Role:
    """One dimension reference of a fact: join ``fact_key`` to ``dim_key``, deliver ``as_name``."""

    dim: DataFrame
    fact_key: str
    as_name: str
    dim_key: str = "source_id"
    dim_id: str = "id"


def version_at(facts: DataFrame, role: Role, on_date: str, how: str = "inner") -> DataFrame:
    """Facts with the id of the version valid on their date: effective ≤ date < expiration."""
    side = role.dim.select(
        F.col(role.dim_key).alias("_key"), F.col(role.dim_id).alias(role.as_name),
        F.col("effective_date").alias("_from"), F.col("expiration_date").alias("_to"),
    )
    valid = (
        (F.col(role.fact_key) == F.col("_key"))
        & (F.col(on_date) >= F.col("_from")) & (F.col(on_date) < F.col("_to"))
    )
    return facts.join(side, valid, how).drop("_key", "_from", "_to")


def earliest_version(dim: DataFrame, key: str = "source_id", id_col: str = "id") -> DataFrame:
    return first_per_key(dim, [key], [F.col("effective_date"), F.col(id_col)])


def _segments(role: Role) -> DataFrame:
    """The versions of a key as gap-free slices of the whole time axis.

    A slice runs from one version's start to the next one's; the first slice also covers all time
    before it, so a date falls into exactly one slice of its key. Each slice knows the key's
    earliest version.
    """
    by_key = Window.partitionBy("_key").orderBy("_from", "_id")
    return (
        role.dim.select(
            F.col(role.dim_key).alias("_key"), F.col(role.dim_id).alias("_id"),
            F.col("effective_date").alias("_from"), F.col("expiration_date").alias("_to"),
        )
        .withColumn("_first", F.first("_id").over(by_key))
        .withColumn("_slice_to", F.lead("_from").over(by_key))
        .withColumn("_slice_from", F.when(F.row_number().over(by_key) > 1, F.col("_from")))
    )


def version_or_earliest(
    facts: DataFrame, roles: Sequence[Role], on_date: str, natural_key: Sequence[str],
    order_by: Sequence[Column],
) -> DataFrame:
    """Resolve all roles as of the date, or all of them by their earliest version.

    A row whose dimensions all have a version valid on its date takes those ids (phase 1); any
    other row whose keys are all known takes the earliest version of *every* dimension (phase 2).
    One row per natural key survives, phase 1 before phase 2, then ``order_by``. Each dimension is
    joined once; ``load_phase`` tells how a row was resolved.
    """
    out = facts
    for i, role in enumerate(roles):
        s = _segments(role)
        s = s.select(*[F.col(c).alias(f"{c}{i}") for c in s.columns])
        day = F.col(on_date)
        inside = (
            (F.col(role.fact_key) == F.col(f"_key{i}"))
            & (F.col(f"_slice_from{i}").isNull() | (day >= F.col(f"_slice_from{i}")))
            & (F.col(f"_slice_to{i}").isNull() | (day < F.col(f"_slice_to{i}")))
        )
        valid = (day >= F.col(f"_from{i}")) & (day < F.col(f"_to{i}"))
        out = out.join(s, inside, "inner").withColumn(f"_asof{i}", F.when(valid, F.col(f"_id{i}")))
        out = out.drop(*[f"{c}{i}" for c in ("_key", "_id", "_from", "_to", "_slice_from", "_slice_to")])
    resolved = F.lit(True)
    for i in range(len(roles)):
        resolved = resolved & F.col(f"_asof{i}").isNotNull()
    out = out.withColumn("load_phase", F.when(resolved, 1).otherwise(2))
    for i, role in enumerate(roles):
        pick = F.when(F.col("load_phase") == 1, F.col(f"_asof{i}")).otherwise(F.col(f"_first{i}"))
        out = out.withColumn(role.as_name, pick).drop(f"_asof{i}", f"_first{i}")
    return first_per_key(out, natural_key, [F.col("load_phase"), *order_by])


def latest_before(
    events: DataFrame, history: DataFrame, keys: Sequence[str], event_time: str,
    history_time: str, as_name: str, slice_days: int = 31,
) -> DataFrame:
    """Each event with the latest history time of its key strictly before its own time.

    No event meets its key's whole history. The different event times and history times of a key
    are laid on one time axis that is cut into slices; a running maximum works inside one
    (key, slice) partition, and what came before a slice is carried in from a small table of
    per-slice maxima. The answers, one per key and time, then join the events. However hot a key
    is, its windows hold different points in time only, spread over its slices.
    """
    def points(df: DataFrame, time: str) -> DataFrame:
        at = df.select(*keys, F.col(time).alias("_t")).dropna().distinct()
        days = F.datediff(F.col("_t").cast("date"), F.lit("1970-01-01").cast("date"))
        return at.withColumn("_slice", F.floor(days / slice_days))

    asked, past = points(events, event_time), points(history, history_time)
    # An asked time sorts before an equal history time, so it sees strictly earlier times only.
    axis = past.withColumns({"_seen": F.col("_t"), "_is_history": F.lit(1)}).unionByName(
        asked.withColumns({"_seen": F.lit(None).cast(past.schema["_t"].dataType), "_is_history": F.lit(0)})
    )
    inside = (
        Window.partitionBy(*keys, "_slice").orderBy("_t", "_is_history")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = axis.withColumn("_seen", F.max("_seen").over(inside)).filter("_is_history = 0")

    # Carry: for every slice on the axis, the newest history of the slices before it.
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = axis.groupBy(*keys, "_slice").agg(F.max("_seen").alias("_newest"))
    carried = slices.select(*keys, "_slice", F.max("_newest").over(before).alias("_carried"))

    answers = local.join(carried, [*keys, "_slice"], "left").select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_t", F.coalesce("_seen", "_carried").alias(as_name)
    )
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys] + [F.col(event_time) == F.col("_t")]
    return events.join(answers, on, "left").drop("_t", *[f"_k_{k}" for k in keys])
