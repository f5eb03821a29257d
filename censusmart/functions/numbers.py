"""Guarded ratios with exact decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERATOR = "decimal(22,4)"
DENOMINATOR = "decimal(18,2)"


def ratio(numerator: Column, denominator: Column, scale: int, factor: int = 1) -> Column:
    """``round(numerator * factor / denominator, scale)``; NULL when the denominator is 0 or NULL.

    The operand types are chosen so that Spark keeps 18 fractional digits in the quotient;
    wider operands would be cut back to six and round wrongly. ROUND is half away from zero.
    """
    n = (numerator * F.lit(factor)).cast(NUMERATOR)
    d = F.nullif(denominator.cast(DENOMINATOR), F.lit(0).cast(DENOMINATOR))
    return F.round(n / d, scale)


def percent(part: Column, whole: Column, scale: int) -> Column:
    return ratio(part, whole, scale, factor=100)


def rate_when(guard: Column, part: Column, whole: Column, scale: int, factor: int = 100) -> Column:
    """A ratio that is NULL unless ``guard`` holds (a strictly positive denominator, a level …)."""
    return F.when(guard, ratio(part, whole, scale, factor))


def mean(value: Column, scale: int) -> Column:
    """Aggregate: the average of ``value`` rounded to ``scale``, through an exact sum and count."""
    return ratio(F.sum(value), F.count(value), scale)


def distinct_when(condition: Column, key: Column) -> Column:
    """Aggregate: number of different keys among the rows that meet ``condition``."""
    return F.count_distinct(F.when(condition, key))


def sum_when(condition: Column, value: Column) -> Column:
    """Aggregate: sum of ``value`` over the rows that meet ``condition``, 0 where none does."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def is_true(flag: Column) -> Column:
    """Three-valued flag to a two-valued test: NULL counts as not true."""
    return flag.eqNullSafe(F.lit(True))


def is_false(flag: Column) -> Column:
    return flag.eqNullSafe(F.lit(False))


def guarded_area(area: Column) -> Column:
    """Areas outside 0 … 9999999999999.99 are unusable; the rest keep two decimals."""
    usable = (area >= 0) & (area <= F.lit("9999999999999.99").cast("decimal(15,2)"))
    return F.when(usable, F.round(area.cast("decimal(30,10)"), 2).cast("decimal(15,2)"))


# Share of the total population in each school-age band.
AGE_BAND_SHARE = {
    "pop_age_3_5": "0.055",
    "pop_age_6": "0.018",
    "pop_age_6_12": "0.125",
    "pop_age_13_16": "0.068",
    "pop_age_17_18": "0.032",
}


def age_bands(total: Column) -> dict[str, Column]:
    """Estimated population per age band, whole persons."""
    return {
        band: F.round(total.cast("decimal(18,0)") * F.lit(share).cast("decimal(4,3)"), 0).cast("bigint")
        for band, share in AGE_BAND_SHARE.items()
    }


# Upper bounds and labels of the pupil-teacher ratio ranges.
PTR_BANDS = [
    (20, "0-20 (Very Low)"),
    (40, "21-40 (Low)"),
    (53, "41-53 (Acceptable)"),
    (70, "54-70 (High)"),
    (100, "71-100 (Very High)"),
]
PTR_ABOVE = "100+ (Critical)"


def ptr_band(ptr: Column) -> Column:
    chain = F.when(ptr <= PTR_BANDS[0][0], PTR_BANDS[0][1])
    for bound, label in PTR_BANDS[1:]:
        chain = chain.when(ptr <= bound, label)
    return chain.otherwise(PTR_ABOVE)
