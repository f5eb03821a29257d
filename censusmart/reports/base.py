"""Shapes that most report datasets share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.functions.labels import or_label
from censusmart.plans.common import Tables

Dataset = Callable[[Tables], DataFrame]


def district_of(df: DataFrame, t: Tables, school: str = "school_id") -> DataFrame:
    """Rows with their school's ``district_name``; schools off the map drop out."""
    places = t["dw.school_district_map"].select(F.col("school_dim_id").alias("_place"), "district_name")
    return df.join(places, F.col(school) == F.col("_place")).drop("_place")


def largest(df: DataFrame, measure: str, *ties: str, n: int | None = None) -> DataFrame:
    ordered = df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties])
    return ordered if n is None else ordered.limit(n)


def smallest(df: DataFrame, measure: str, *ties: str, n: int | None = None) -> DataFrame:
    ordered = df.orderBy(F.col(measure).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties])
    return ordered if n is None else ordered.limit(n)


def current_count(dim: str, name: str, condition: Callable[[], Column] | None = None) -> Dataset:
    """KPI: number of current versions, all or those that meet a condition.

    A current dimension holds each id once, yet the count stays distinct as the report defines it.
    """
    def dataset(t: Tables) -> DataFrame:
        rows = t[dim].filter("is_current")
        if condition is not None:
            rows = rows.filter(condition())
        return rows.agg(F.count_distinct("id").alias(name))
    return dataset


def breakdown(dim: str, column: str, measure: str, name: str | None = None) -> Dataset:
    """Current versions per value of ``column``; missing values are labelled after grouping."""
    def dataset(t: Tables) -> DataFrame:
        counted = t[dim].filter("is_current").groupBy(column).agg(F.count_distinct("id").alias(measure))
        labelled = counted.select(or_label(F.col(column)).alias(name or column), measure)
        return largest(labelled, measure, name or column)
    return dataset


def district_people(fact: str, person: str, measure: str, pick: Callable) -> Dataset:
    """People per district, ranked by ``pick`` (``largest`` or ``smallest``), fifteen rows."""
    def dataset(t: Tables) -> DataFrame:
        pairs = t[fact].select("school_id", person).distinct()
        counted = district_of(pairs, t).groupBy("district_name").agg(F.count_distinct(person).alias(measure))
        return pick(counted, measure, "district_name", n=15)
    return dataset


def people_by(fact: DataFrame, keys: list[str], person: str, dim: DataFrame | None, columns: list[str]) -> DataFrame:
    """One row per key and person, with the person's current attributes.

    A report that counts distinct people under several conditions needs each person once per key:
    after this single distinct the conditions are plain conditional counts, where one COUNT
    DISTINCT per condition would replicate every fact row.
    """
    pairs = fact.select(*keys, person).distinct()
    if dim is None:
        return pairs
    who = dim.filter("is_current").select(F.col("id").alias(person), *columns)
    return pairs.join(who, person)
