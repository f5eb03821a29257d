"""Decodes and label rules: flags and codes in, report text out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from censusmart.functions.numbers import is_false, is_true

HOME_COUNTRY = "UGANDA"

# Meaning of the numeric codes in the building-status and transfer records.
COMPLETION = {1: "COMPLETE", 2: "INCOMPLETE", 3: "UNDER CONSTRUCTION", 4: "PLANNED"}
USAGE_MODE = {1: "PERMANENT", 2: "TEMPORARY", 3: "SEMI-PERMANENT"}
CONDITION = {1: "GOOD", 2: "FAIR", 3: "POOR", 4: "DILAPIDATED"}
GENDER_USAGE = {1: "MALE", 2: "FEMALE", 3: "BOTH", 4: "NONE"}
USER_CATEGORY = {1: "TEACHERS ONLY", 2: "LEARNERS ONLY", 3: "BOTH"}
TRANSFER_STATUS = {1: "PENDING", 2: "APPROVED", 3: "REJECTED"}

# Boarding labels for schools and for post-school institutions.
SCHOOL_RESIDENCE = ("DAY SCHOOL", "FULLY BOARDING", "DAY AND BOARDING")
INSTITUTION_RESIDENCE = ("NON RESIDENTIAL", "RESIDENTIAL", "BOTH RES/NON")

# Spellings of the two genders.
MALE = ("M", "MALE")
FEMALE = ("F", "FEMALE")


def decode(code: Column, mapping: Mapping[object, str], default: str | None = None) -> Column:
    """Code to label; a code outside ``mapping`` (or NULL) gives ``default``."""
    items = list(mapping.items())
    chain = F.when(code == items[0][0], items[0][1])
    for value, label in items[1:]:
        chain = chain.when(code == value, label)
    return chain.otherwise(F.lit(default).cast("string"))


def full_given_name(first: Column, other: Column) -> Column:
    blank = F.lit("")
    return F.trim(F.concat(F.coalesce(first, blank), F.lit(" "), F.coalesce(other, blank)))


def nationality(country: Column) -> Column:
    return F.coalesce(country, F.lit(HOME_COUNTRY))


def ownership(name: Column, government: Column, unknown: str | None) -> Column:
    """Ownership name, else the government flag; ``unknown`` labels a NULL flag."""
    from_flag = (
        F.when(is_true(government), "GOVT AIDED")
        .when(is_false(government), "PRIVATE")
        .otherwise(F.lit(unknown).cast("string"))
    )
    return F.coalesce(name, from_flag)


def sex_composition(male: Column, female: Column) -> Column:
    return (
        F.when(is_true(male) & is_true(female), "MIXED")
        .when(is_true(female), "FEMALES ONLY")
        .when(is_true(male), "MALES ONLY")
    )


def residence(day: Column, boarding: Column, labels: Sequence[str] = SCHOOL_RESIDENCE) -> Column:
    """Label for day-only, boarding-only and both; any unknown flag gives NULL."""
    day_only, boarding_only, both = labels
    return (
        F.when(is_true(day) & is_false(boarding), day_only)
        .when(is_false(day) & is_true(boarding), boarding_only)
        .when(is_true(day) & is_true(boarding), both)
    )


def orphan_status(father_dead: Column, mother_dead: Column) -> Column:
    return (
        F.when(is_true(father_dead) & is_true(mother_dead), "BOTH DECEASED")
        .when(is_true(mother_dead), "MOTHER DECEASED")
        .when(is_true(father_dead), "FATHER DECEASED")
        .otherwise("NOT APPLICABLE")
    )


def more_than_one(flags: Sequence[Column]) -> Column:
    ones = [F.coalesce(f, F.lit(False)).cast("int") for f in flags]
    return reduce(lambda a, b: a + b, ones) > 1


def any_of(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [is_true(f) for f in flags])


def enrolment_type(name: Column) -> Column:
    return F.coalesce(F.upper(name), F.lit("CONTINUING"))


def school_level(*names: Column) -> Column:
    return F.upper(F.coalesce(*names, F.lit("UNKNOWN")))


def discipline(subjects: Column, science: Column, compat: bool = False) -> Column:
    """SCIENCE, ARTS or BOTH by the number of science subjects among all subjects.

    A teacher without subjects has no discipline. ``compat=True`` gives BOTH for a NULL count,
    as the literal rule of the teacher mart does.
    """
    label = (
        F.when(subjects == 0, F.lit(None).cast("string"))
        .when(science == subjects, "SCIENCE")
        .when(science == 0, "ARTS")
    )
    if compat:
        return label.otherwise("BOTH")
    return F.when(subjects.isNull(), F.lit(None).cast("string")).otherwise(label.otherwise("BOTH"))


def crosses(outgoing: Column, incoming: Column) -> Column:
    """True when both ends are known and differ; never NULL."""
    return F.coalesce(outgoing != incoming, F.lit(False))


def subject_category(language: Column, science: Column) -> Column:
    return F.when(is_true(language), "LANGUAGE").when(is_true(science), "SCIENCE").otherwise("ARTS")


def certificate_level(o_level: Column, a_level: Column) -> Column:
    return (
        F.when(is_true(o_level) & is_true(a_level), "Both O and A Level")
        .when(is_true(o_level) & is_false(a_level), "O Level Only")
        .when(is_false(o_level) & is_true(a_level), "A Level Only")
        .otherwise("Primary")
    )


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").otherwise("No")


def or_label(value: Column, label: str = "Unknown") -> Column:
    return F.coalesce(value, F.lit(label))


def gender_in(gender: Column, spellings: Sequence[str]) -> Column:
    return F.upper(gender).isin(*spellings)


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """LIKE against any of the patterns, on upper-cased text (``_`` is a one-character wildcard)."""
    upper = F.upper(text)
    return reduce(lambda a, b: a | b, [upper.like(p) for p in patterns])


def cut(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)
