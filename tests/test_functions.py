import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from censusmart.functions import calendar as cal
from censusmart.functions import changes, labels, numbers


def one(df, column):
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize("name, start, expected", [
    ("ACADEMIC YEAR 2026", date(2020, 1, 1), 2026),
    ("no digits", date(2020, 1, 1), 2020),
    (None, date(2020, 1, 1), 2020),
    (None, None, None),
    ("2025/2026", date(2020, 1, 1), 20252026),
    ("12345678901234", date(2020, 1, 1), 2020),
])
def test_academic_year(frame, name, start, expected):
    df = frame("n string, d date", (name, start))
    assert one(df, cal.academic_year(F.col("n"), F.col("d"))) == expected


@pytest.mark.parametrize("name, label, month", [
    ("1", "TERM 1", 2), ("2", "TERM 2", 6), ("3", "TERM 3", 9), ("Term 2", "TERM 2", 6), ("term x", "TERM X", 2),
    ("X", "TERM 1", 2), (None, "TERM 1", 2),
])
def test_terms(frame, name, label, month):
    df = frame("n string", (name,)).withColumn("t", cal.term_label(F.col("n")))
    assert one(df, F.col("t")) == label
    assert one(df, cal.term_start(F.lit(2024), F.col("t"))) == date(2024, month, 1)


def test_calendar(spark):
    days = cal.calendar_dim(spark)
    assert days.count() == 5844
    d = days.filter("system_date = '2024-07-01'").first()
    assert (d.id, d.day, d.month, d.month_name, d.short_month, d.year, d.FY, d.Quarter) == (
        20240701, 1, 7, "July", "JUL", 2024, 2025, "Q1")
    quarters = {r.month: r.Quarter for r in days.filter("year = 2023 and day = 1").collect()}
    assert [quarters[m] for m in (1, 4, 7, 10, 12)] == ["Q3", "Q4", "Q1", "Q2", "Q2"]


@pytest.mark.parametrize("n, d, scale, factor, expected", [
    (1, 3, 2, 100, "33.33"), (1, 8, 2, 1, "0.13"), (-1, 8, 2, 1, "-0.13"), (7, 4000, 2, 100, "0.18"),
    (5, 0, 2, 100, None), (5, None, 2, 100, None), (None, 5, 2, 100, None), (1, 7, 4, 1, "0.1429"),
    (10**12, 3, 2, 1, "333333333333.33"),
])
def test_ratio_is_exact(frame, n, d, scale, factor, expected):
    df = frame("n bigint, d bigint", (n, d))
    value = one(df, numbers.ratio(F.col("n"), F.col("d"), scale, factor))
    assert value == (None if expected is None else Decimal(expected))


def test_mean_rounds_ties_away_from_zero(frame):
    df = frame("v decimal(8,2)", (Decimal("0.20"),), (Decimal("0.30"),), (None,))
    assert one(df, numbers.mean(F.col("v"), 1)) == Decimal("0.3")


@pytest.mark.parametrize("area, expected", [
    (None, None), (-1.0, None), (1e15, None), (12.345, "12.35"), (0.0, "0.00"), (9999999999999.99, "9999999999999.99"),
])
def test_area_guard(frame, area, expected):
    df = frame("a double", (area,))
    assert one(df, numbers.guarded_area(F.col("a"))) == (None if expected is None else Decimal(expected))


def test_ptr_bands(frame, rows):
    df = frame("p double", (20.0,), (20.5,), (53.0,), (70.0,), (100.0,), (100.5,))
    assert [r[0] for r in df.select(numbers.ptr_band(F.col("p"))).collect()] == [
        "0-20 (Very Low)", "21-40 (Low)", "41-53 (Acceptable)", "54-70 (High)", "71-100 (Very High)", "100+ (Critical)"]


T, X, N = True, False, None


@pytest.mark.parametrize("male, female, expected", [
    (T, T, "MIXED"), (T, X, "MALES ONLY"), (T, N, "MALES ONLY"), (X, T, "FEMALES ONLY"), (N, T, "FEMALES ONLY"),
    (X, X, None), (N, N, None), (X, N, None),
])
def test_sex_composition(frame, male, female, expected):
    df = frame("m boolean, f boolean", (male, female))
    assert one(df, labels.sex_composition(F.col("m"), F.col("f"))) == expected


@pytest.mark.parametrize("day, board, expected", [
    (T, X, "DAY SCHOOL"), (X, T, "FULLY BOARDING"), (T, T, "DAY AND BOARDING"), (X, X, None), (T, N, None), (N, T, None),
])
def test_residence(frame, day, board, expected):
    df = frame("d boolean, b boolean", (day, board))
    assert one(df, labels.residence(F.col("d"), F.col("b"))) == expected


@pytest.mark.parametrize("name, flag, unknown, expected", [
    ("CHURCH", X, None, "CHURCH"), (None, T, None, "GOVT AIDED"), (None, X, None, "PRIVATE"), (None, N, None, None),
    (None, N, "PRIVATE", "PRIVATE"),
])
def test_ownership(frame, name, flag, unknown, expected):
    df = frame("n string, g boolean", (name, flag))
    assert one(df, labels.ownership(F.col("n"), F.col("g"), unknown)) == expected


@pytest.mark.parametrize("subjects, science, label, literal", [
    (None, None, None, "BOTH"), (0, 0, None, None), (3, 3, "SCIENCE", "SCIENCE"), (3, 0, "ARTS", "ARTS"), (3, 1, "BOTH", "BOTH"),
])
def test_discipline(frame, subjects, science, label, literal):
    df = frame("n bigint, s bigint", (subjects, science))
    assert one(df, labels.discipline(F.col("n"), F.col("s"))) == label
    assert one(df, labels.discipline(F.col("n"), F.col("s"), compat=True)) == literal


def test_decode_unknown_codes(frame):
    df = frame("c smallint", (1,), (9,), (None,))
    codes = df.select(labels.decode(F.col("c"), labels.COMPLETION).alias("a"),
                      labels.decode(F.col("c"), labels.TRANSFER_STATUS, "UNKNOWN").alias("b")).collect()
    assert [tuple(r) for r in codes] == [("COMPLETE", "PENDING"), (None, "UNKNOWN"), (None, "UNKNOWN")]


def test_names_and_defaults(frame):
    df = frame("a string, b string", (None, None), ("Ann", None), (None, "B"), ("Ann", "B"))
    assert [r[0] for r in df.select(labels.full_given_name(F.col("a"), F.col("b"))).collect()] == ["", "Ann", "B", "Ann B"]
    assert one(frame("c string", (None,)), labels.nationality(F.col("c"))) == "UGANDA"


def test_hash_takes_default_texts(frame):
    df = frame("a string, b boolean", (None, None), ("", False))
    hashes = df.select(changes.change_hash([F.col("a"), F.col("b")], ["", "false"]).alias("h")).collect()
    assert hashes[0].h == hashes[1].h == hashlib.md5(b"|false").hexdigest()


def test_changed_fields_with_and_without_null_safety(frame):
    df = frame("a string, b string, c string, d string", ("x", "y", None, "z"))
    pairs = {"first": (F.col("a"), F.col("b")), "second": (F.col("c"), F.col("d"))}
    assert one(df, changes.changed_fields(pairs)) == "first,second"
    assert one(df, changes.changed_fields(pairs, null_safe=False)) == "first"


def test_inter_district_and_days(frame):
    df = frame("a int, b int, x date, y date", (1, 2, date(2024, 3, 1), date(2024, 2, 1)), (1, 1, None, date(2024, 2, 1)),
               (None, 2, date(2024, 2, 1), None))
    assert [r[0] for r in df.select(labels.crosses(F.col("a"), F.col("b"))).collect()] == [True, False, False]
    assert [r[0] for r in df.select(cal.days_between(F.col("x"), F.col("y"))).collect()] == [29, None, None]


def test_population_bands(frame):
    bands = {k: one(frame("t bigint", (1000,)), c) for k, c in numbers.age_bands(F.col("t")).items()}
    assert bands == {"pop_age_3_5": 55, "pop_age_6": 18, "pop_age_6_12": 125, "pop_age_13_16": 68, "pop_age_17_18": 32}
    assert one(frame("t bigint", (100,)), numbers.age_bands(F.col("t"))["pop_age_3_5"]) == 6
