"""Change detection between two versions of a record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_LOAD = "INITIAL_LOAD"


def as_text(value: Column, default: str = "") -> Column:
    return F.coalesce(value.cast("string"), F.lit(default))


def change_hash(values: Sequence[Column], defaults: Sequence[str] | None = None) -> Column:
    """MD5 over the values joined with ``|``; NULLs take their default text first."""
    defaults = defaults or [""] * len(values)
    return F.md5(F.concat_ws("|", *[as_text(v, d) for v, d in zip(values, defaults, strict=True)]))


def differs(old: Column, new: Column, null_safe: bool = True) -> Column:
    """Whether two values differ; the NULL-unsafe form overlooks NULL ↔ value changes."""
    return ~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False))


def changed_fields(pairs: Mapping[str, tuple[Column, Column]], null_safe: bool = True) -> Column:
    """Comma-separated names of the fields whose old and new values differ."""
    names = [F.when(differs(o, n, null_safe), F.lit(name)) for name, (o, n) in pairs.items()]
    return F.concat_ws(",", *names)


def change_reason(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Text of the first rule that holds."""
    chain = F.lit(default)
    for condition, reason in reversed(rules):
        chain = F.when(condition, reason).otherwise(chain)
    return chain
