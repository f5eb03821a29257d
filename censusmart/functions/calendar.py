"""Academic years, terms and calendar attributes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_TERM = "TERM 1"

# First month of each term; any other label starts with the year's first term.
TERM_MONTH = {"TERM 1": 2, "TERM 2": 6, "TERM 3": 9}

# The fiscal year runs from July to June.
FISCAL_START_MONTH = 7


def academic_year(name: Column, fallback: Column) -> Column:
    """The digits of an academic-year name, else the year of ``fallback`` (a date).

    All digits are joined, so ``2025/2026`` gives 20252026; text too long for an integer gives
    NULL and falls back instead of failing the job under ANSI casts.
    """
    digits = F.nullif(F.regexp_replace(name, "[^0-9]", ""), F.lit(""))
    return F.coalesce(digits.try_cast("int"), F.year(fallback))


def term_label(name: Column) -> Column:
    """``1`` → ``TERM 1``; anything that starts with *term* is upper-cased; the rest is term 1."""
    return (
        F.when(name.isin("1", "2", "3"), F.concat(F.lit("TERM "), name))
        .when(name.ilike("term%"), F.upper(name))
        .otherwise(DEFAULT_TERM)
    )


def term_start(year: Column, term: Column) -> Column:
    month = F.lit(TERM_MONTH[DEFAULT_TERM])
    for label, first_month in TERM_MONTH.items():
        month = F.when(term == label, first_month).otherwise(month)
    return F.make_date(year, month, F.lit(1))


def period_label(year: Column, term: Column) -> Column:
    return F.concat(F.lit("FY"), year.cast("string"), F.lit(" "), term)


def age_in_year(as_of: date, born: Column) -> Column:
    """Difference of calendar years; the birthday itself is not looked at."""
    return F.lit(as_of.year) - F.year(born)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def fiscal_year(day: Column) -> Column:
    return F.year(day) + F.when(F.month(day) >= FISCAL_START_MONTH, 1).otherwise(0)


def fiscal_quarter(day: Column) -> Column:
    months_in = (F.month(day) + (12 - FISCAL_START_MONTH)) % 12
    return F.concat(F.lit("Q"), (F.floor(months_in / 3) + 1).cast("string"))


def calendar_columns(day: Column) -> dict[str, Column]:
    return {
        "system_date": day,
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "short_month": F.upper(F.date_format(day, "MMM")),
        "year": F.year(day),
        "FY": fiscal_year(day),
        "Quarter": fiscal_quarter(day),
    }


def date_id(day: Column) -> Column:
    """Calendar surrogate ``yyyymmdd``: derivable from the date, so facts need no lookup join."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def calendar_dim(
    spark: SparkSession, start: date = date(2022, 1, 1), end: date = date(2037, 12, 31)
) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("d")
    )
    return days.select(
        date_id(F.col("d")).alias("id"),
        *[c.alias(n) for n, c in calendar_columns(F.col("d")).items()],
    )
