"""Administrative hierarchy: climb from any unit to its district, and the stored table of all ancestors."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DISTRICT = "District"

# Number of parent steps from each unit type to the district.
STEPS_TO_DISTRICT = {
    "Parish": 3, "Ward": 3,
    "Sub County": 2, "Town Council": 2,
    "County": 1, "Municipality": 1, "City": 1,
    "District": 0,
}
MAX_DEPTH = max(STEPS_TO_DISTRICT.values())


def climb(
    units: DataFrame, steps: Mapping[str, int] = STEPS_TO_DISTRICT, top_type: str = DISTRICT,
    current_col: str = "current_status",
) -> DataFrame:
    """``(unit_dim_id, district_dim_id, district_name)`` for every current unit that reaches a top.

    A unit's ``child_id`` holds its parent's ``source_id``. All types climb together, one join per
    step; a unit that has arrived carries no key into the next join. Parents match on source id
    alone, so an id shared between levels gives a unit several tops. Unit types not in ``steps``
    are left out.
    """
    live = units.filter(current_col)
    left = F.coalesce(*[F.when(F.col("admin_unit_type") == t, n) for t, n in steps.items()])
    at = live.select(
        F.col("id").alias("unit_dim_id"), F.col("id").alias("at_id"), F.col("name").alias("at_name"),
        F.col("admin_unit_type").alias("at_type"), F.col("child_id").alias("parent"),
        left.alias("steps_left"),
    ).filter("steps_left is not null")
    parents = live.select(
        F.col("source_id").alias("p_source"), F.col("id").alias("p_id"), F.col("name").alias("p_name"),
        F.col("admin_unit_type").alias("p_type"), F.col("child_id").alias("p_parent"),
    )
    for _ in range(max(steps.values())):
        moving = F.col("steps_left") > 0
        up = at.join(parents, F.when(moving, F.col("parent")) == F.col("p_source"), "left")
        up = up.filter(~moving | F.col("p_id").isNotNull())
        at = up.select(
            "unit_dim_id",
            F.when(moving, F.col("p_id")).otherwise(F.col("at_id")).alias("at_id"),
            F.when(moving, F.col("p_name")).otherwise(F.col("at_name")).alias("at_name"),
            F.when(moving, F.col("p_type")).otherwise(F.col("at_type")).alias("at_type"),
            F.when(moving, F.col("p_parent")).otherwise(F.col("parent")).alias("parent"),
            F.when(moving, F.col("steps_left") - 1).otherwise(F.col("steps_left")).alias("steps_left"),
        )
    return at.filter(F.col("at_type") == top_type).select(
        "unit_dim_id", F.col("at_id").alias("district_dim_id"), F.col("at_name").alias("district_name")
    )


def ancestors(units: DataFrame, only: DataFrame | None = None, depth: int = MAX_DEPTH, current_col: str = "current_status") -> DataFrame:
    """``(unit_dim_id, unit_type, ancestor_dim_id, ancestor_name, ancestor_type, above, depth)`` of current units, themselves at depth 0.

    A row per way up, as in ``climb``: a source id shared between levels gives a unit several ancestors at one depth. ``only``
    names the units (``unit_dim_id``) to start from. ``above`` is the source id of the ancestor's own parent. Nothing is followed beyond ``depth``, so a cycle ends there as well.
    """
    live = units.filter(current_col)
    parents = live.select(
        F.col("source_id").alias("_source"), F.col("id").alias("ancestor_dim_id"), F.col("name").alias("ancestor_name"),
        F.col("admin_unit_type").alias("ancestor_type"), F.col("child_id").alias("above"),
    )
    start = live.select(F.col("id").alias("unit_dim_id"), F.col("admin_unit_type").alias("unit_type"), F.col("id").alias("ancestor_dim_id"),
                        F.col("name").alias("ancestor_name"), F.col("admin_unit_type").alias("ancestor_type"), F.col("child_id").alias("above"))
    levels = [start if only is None else start.join(only, "unit_dim_id", "left_semi")]
    for _ in range(depth):
        below = levels[-1].select("unit_dim_id", "unit_type", F.col("above").alias("_source")).dropna(subset=["_source"])
        levels.append(below.join(parents, "_source").select(*start.columns))
    return reduce(DataFrame.unionByName, [at.withColumn("depth", F.lit(n)) for n, at in enumerate(levels)])


def refreshed_ancestors(stored: DataFrame, units: DataFrame, depth: int = MAX_DEPTH, current_col: str = "current_status") -> DataFrame:
    """The ancestor table after a change of units; only units with a changed way up are climbed again.

    These are the units whose stored rows name a version that is no longer current, units without rows, and units with an
    ancestor whose parent is one of the latter: every unit below a new one has such a row, so nothing is climbed down.
    A version's id stands for its values, so a repeated merge for one date starts from an empty table instead.
    """
    live = units.filter(current_col).select(F.col("id").alias("unit_dim_id"), F.col("source_id").alias("above"))
    ids = live.select(F.col("unit_dim_id").alias("ancestor_dim_id"))
    outdated = stored.join(ids, "ancestor_dim_id", "left_anti").select("unit_dim_id")
    fresh = live.join(stored, "unit_dim_id", "left_anti")
    below = stored.join(fresh, "above", "left_semi").select("unit_dim_id")
    changed = outdated.unionByName(fresh.select("unit_dim_id")).unionByName(below).distinct()
    return stored.join(changed, "unit_dim_id", "left_anti").unionByName(ancestors(units, changed, depth, current_col))


def reach(ancestry: DataFrame, steps: Mapping[str, int] = STEPS_TO_DISTRICT, top_type: str = DISTRICT) -> DataFrame:
    """What ``climb`` gives, read from the ancestor table: a filter without a join."""
    expected = F.coalesce(*[F.when(F.col("unit_type") == t, n) for t, n in steps.items()])
    return ancestry.filter((F.col("depth") == expected) & (F.col("ancestor_type") == top_type)).select(
        "unit_dim_id", F.col("ancestor_dim_id").alias("district_dim_id"), F.col("ancestor_name").alias("district_name")
    )


def above_themselves(ancestry: DataFrame) -> DataFrame:
    """Units that are their own ancestors: members of a cycle within the table's depth."""
    return ancestry.filter((F.col("depth") > 0) & (F.col("unit_dim_id") == F.col("ancestor_dim_id"))).select("unit_dim_id").distinct()


def district_map(schools: DataFrame, reached: DataFrame) -> DataFrame:
    """``(school_dim_id, district_id, district_name)``: every school version with its district (of ``climb`` or ``reach``)."""
    place = schools.select(F.col("id").alias("school_dim_id"), F.col("admin_unit_id").alias("unit_dim_id"))
    return place.join(reached, "unit_dim_id").select(
        "school_dim_id", F.col("district_dim_id").alias("district_id"), "district_name"
    )


def several_districts(reached: DataFrame) -> DataFrame:
    """Units that reach more than one district, with the number of districts."""
    counted = reached.groupBy("unit_dim_id").agg(
        F.count_distinct("district_dim_id").alias("districts")
    )
    return counted.filter("districts > 1")
