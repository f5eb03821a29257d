"""Type 2 slowly changing dimensions without MERGE: one join rewrites the current rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from censusmart.functions.changes import FIRST_LOAD, change_hash, change_reason, changed_fields, differs
from censusmart.operators.keys import surrogate_key

FOREVER = date(9999, 12, 31)


@dataclass(frozen=True)
class Versioned:
    """How one dimension keeps its history.

    ``tracked`` maps each hashed column to the text that stands for NULL. ``reasons`` are
    (column, text) pairs, first difference wins. ``named`` limits the columns listed in
    ``changed_fields`` (default: all tracked). ``compat`` reproduces the literal load rules:
    ``"initial"`` marks every insert as a first load, ``"unsafe"`` overlooks NULL ↔ value changes.
    """

    keys: Sequence[str]
    tracked: Mapping[str, str]
    current_col: str = "is_current"
    stored_hash: bool = True
    describe: bool = True
    reasons: Sequence[tuple[str, str]] = ()
    default_reason: str = "ATTRIBUTE_CHANGE"
    first_fields: str = FIRST_LOAD
    named: Sequence[str] | None = None
    compat: str | None = None

    def hash_of(self, prefix: str) -> Column:
        return change_hash([F.col(prefix + c) for c in self.tracked], list(self.tracked.values()))


def scd2_merge(dim: DataFrame, staged: DataFrame, spec: Versioned, as_of: date) -> DataFrame:
    """The dimension after merging one staging row per key at ``as_of``.

    Current rows and staging meet in one full outer join on the key. Each joined row yields its
    one or two output versions as an array that is exploded in place, so the join runs once:
    unchanged or absent from staging → the old row; changed → the old row, expired on the day
    before ``as_of``, and a new version; unknown key → a new version. History rows pass through.
    """
    columns = dim.columns
    current = F.col(spec.current_col)
    live = dim.filter(current).select(
        F.struct(*columns).alias("old"), *[F.col(k).alias(f"_o_{k}") for k in spec.keys]
    )
    fresh = staged.select(
        F.struct(*staged.columns).alias("new"), *[F.col(k).alias(f"_n_{k}") for k in spec.keys]
    )
    on = [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in spec.keys]
    both = live.join(fresh, on, "full_outer")

    new_hash = spec.hash_of("new.")
    old_hash = F.col("old.change_hash") if spec.stored_hash else spec.hash_of("old.")
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    both = both.withColumn("_hash", new_hash).withColumn(
        "_changed", has_old & has_new & (old_hash != F.col("_hash"))
    )

    changed, old = F.col("_changed"), F.col("old")
    ends = F.when(changed, F.lit(as_of - timedelta(days=1))).otherwise(F.col("old.expiration_date"))
    known = old.withField("expiration_date", ends).withField(spec.current_col, ~changed)
    versions = F.array_compact(
        F.array(F.when(has_old, known), F.when(~has_old | changed, _inserted(dim, staged, spec, as_of)))
    )
    merged = both.select(F.explode(versions).alias("v")).select("v.*")
    return dim.filter(~F.coalesce(current, F.lit(False))).unionByName(merged)


def _inserted(dim: DataFrame, staged: DataFrame, spec: Versioned, as_of: date) -> Column:
    """The new version as a struct with the dimension's columns and types."""
    first = F.col("old").isNull()
    safe = spec.compat != "unsafe"
    pairs = {c: (F.col(f"old.{c}"), F.col(f"new.{c}")) for c in spec.named or spec.tracked}
    made: dict[str, Column] = {
        "effective_date": F.lit(as_of),
        "expiration_date": F.lit(FOREVER),
        spec.current_col: F.lit(True),
        "change_hash": F.col("_hash"),
        "id": surrogate_key(*[F.col(f"new.{k}") for k in spec.keys], F.lit(as_of)),
    }
    if spec.describe:
        rules = [
            (differs(F.col(f"old.{c}"), F.col(f"new.{c}"), safe), text) for c, text in spec.reasons
        ]
        reason = change_reason(rules, spec.default_reason)
        fields = changed_fields(pairs, safe)
        if spec.compat == "initial":
            first = F.lit(True)
        made["change_reason"] = F.when(first, FIRST_LOAD).otherwise(reason)
        made["changed_fields"] = F.when(first, spec.first_fields).otherwise(fields)

    def value(name: str) -> Column:
        if name in made:
            return made[name]
        return F.col(f"new.{name}") if name in staged.columns else F.lit(None)

    return F.struct(*[value(f.name).cast(f.dataType).alias(f.name) for f in dim.schema.fields])


def require_later(dim: DataFrame, as_of: date, current_col: str = "is_current") -> None:
    """Refuse a merge on or before the newest version: it would expire rows before they began."""
    newest = dim.filter(current_col).agg(F.max("effective_date")).first()[0]
    if newest is not None and newest >= as_of:
        raise ValueError(f"dimension already holds versions from {newest}; as_of is {as_of}")


def merge_counts(dim: DataFrame, as_of: date, current_col: str = "is_current") -> DataFrame:
    """One row: versions expired and inserted by the merge at ``as_of``, and current versions."""
    current = F.col(current_col)
    return dim.agg(
        F.count_if(~current & (F.col("expiration_date") == F.lit(as_of - timedelta(days=1)))).alias("expired"),
        F.count_if(F.col("effective_date") == F.lit(as_of)).alias("inserted"),
        F.count_if(current).alias("current"),
    )


def version_counts(dim: DataFrame, current_col: str = "is_current") -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(current_col).alias("current"),
        F.count_if(~F.col(current_col)).alias("historical"),
    )


def version_gaps(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that do not end on the day before the next version of their key begins."""
    order = Window.partitionBy(*keys).orderBy("effective_date")
    following = dim.withColumn("next_effective_date", F.lead("effective_date").over(order))
    return following.filter(F.date_add("expiration_date", 1) != F.col("next_effective_date"))


def history_of(dim: DataFrame, key: str, value: object) -> DataFrame:
    """All versions of one record, oldest first."""
    return dim.filter(F.col(key) == F.lit(value)).orderBy("effective_date")


def versions_changing(dim: DataFrame, field_name: str) -> DataFrame:
    """Versions that list ``field_name`` among their changed fields."""
    return dim.filter(F.col("changed_fields").contains(field_name))
