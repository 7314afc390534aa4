"""Edge tables for the column expressions."""

import datetime

import pytest
from pyspark.sql import functions as F
from waybill import functions as fn
from waybill.plans.entities import SHIPMENT_STATUS


def apply(spark, values, expr):
    """The expression's result for each value, evaluated at run time."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.repartition(2).select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def d(text):
    return datetime.date.fromisoformat(text)


DATES = [
    ("2026-09-01", "2026-09-01", "ISO"),
    ("  2026-09-01\t", "2026-09-01", "ISO"),
    ("09/02/2026", "2026-09-02", "US"),
    ("9/2/2026", "2026-09-02", "US"),
    ("Sep 3 2026", "2026-09-03", "Long"),
    ("september  03 2026", "2026-09-03", "Long"),
    ("MAY 31 2026", "2026-05-31", "Long"),
    ("June 7 2026", "2026-06-07", "Long"),
    ("8-Sep-2026", "2026-09-08", "D-Mon-Y"),
    ("08-sEP-2026", "2026-09-08", "D-Mon-Y"),
    ("delivered", None, None),
    ("", None, None),
    ("13/45/2026", None, None),
    ("12/32/2026", None, None),
    ("13/01/2026", None, None),
    ("Sept 3 2026", None, None),
    ("Foo 3 2026", None, None),
    ("Janember 3 2026", None, None),
    ("32-Sep-2026", None, None),
    ("8-Sept-2026", None, None),
    ("2026-9-1", None, None),
    ("2026-09-01T00:00", None, None),
    ("2026-09-01\nx", None, None),
    ("20260901", None, None),
    # Written like a date, but there is no such day.
    ("2026-13-45", None, "ISO"),
    ("02/31/2026", None, "US"),
    ("00/10/2026", None, "US"),
    ("Sep 99 2026", None, "Long"),
    ("31-Feb-2026", None, "D-Mon-Y"),
    ("2024-02-29", "2024-02-29", "ISO"),
    ("2023-02-29", None, "ISO"),
]


def test_dates(spark):
    texts = [t for t, _, _ in DATES]
    values = apply(spark, texts, fn.parse_date)
    formats = apply(spark, texts, fn.date_format_of)
    for (text, value, fmt), got, got_fmt in zip(DATES, values, formats):
        assert got == (d(value) if value else None), text
        assert got_fmt == fmt, text


def test_dates_null(spark):
    assert apply(spark, [None], fn.parse_date) == [None]
    assert apply(spark, [None], fn.date_format_of) == [None]


NUMBERS = [
    ("$1,780.50", 1780.5),
    ("1450.00", 1450.0),
    ("-$5", -5.0),
    ("$-5", -5.0),
    ("1,2", 12.0),
    (" 1 000 ", 1000.0),
    (" 42﻿", 42.0),
    ("007", 7.0),
    ("0", 0.0),
    ("", None),
    ("N/A", None),
    ("(5)", None),
    (".5", None),
    ("5.", None),
    ("+5", None),
    ("1e5", None),
    ("--5", None),
    ("-", None),
    ("$", None),
    ("NaN", None),
    ("Infinity", None),
    ("1.2.3", None),
    ("9" * 400, None),
    ("0" * 400 + "12", 12.0),
    (None, None),
]


def test_numbers(spark):
    got = apply(spark, [t for t, _ in NUMBERS], fn.parse_number)
    for (text, want), value in zip(NUMBERS, got):
        assert value == want, text


STATUSES = [
    ("delivered", "delivered"),
    ("delviered", "delivered"),
    ("Delivered", "delivered"),
    ("deliver tomorrow", "delivered"),
    ("In-Transit", "in_transit"),
    ("IN TRANSIT", "in_transit"),
    ("in__transit", "in_transit"),
    ("intransigent", "in_transit"),
    ("intrnsit", "in_transit"),
    ("booked", "booked"),
    ("boked", "booked"),
    ("cooked", "booked"),
    ("Delayed", "delayed"),
    ("delyed", "delayed"),
    ("cancelled", "cancelled"),
    ("canceled", "cancelled"),
    ("cancld", "cancelled"),
    ("", None),
    (" - _ ", None),
    ("teleporting", None),
    ("returned", None),
    (None, None),
]


def test_statuses(spark):
    got = apply(spark, [t for t, _ in STATUSES], lambda c: fn.canonical_value(c, SHIPMENT_STATUS))
    for (text, want), value in zip(STATUSES, got):
        assert value == want, text


PLACES = [
    ("chicago", "Chicago"),
    ("CHICAGO", "Chicago"),
    ("el PASO", "El Paso"),
    ("el  paso", "El  Paso"),
    ("st. louis", "St. Louis"),
    ("ST.LOUIS", "St.Louis"),
    ("WINSTON-salem", "Winston-Salem"),
    ("o'FALLON", "o'FALLON"),
    ("NATION_1 north", "NATION_1 North"),
    ("new\tyork", "New\tYork"),
    ("québec city", "québec City"),
    ("a.b-c d", "A.B-C D"),
    ("-.", "-."),
    ("", ""),
]


def test_places(spark):
    got = apply(spark, [t for t, _ in PLACES], fn.title_case_place)
    for (text, want), value in zip(PLACES, got):
        assert value == want, text


def test_wide_trim(spark):
    values = ["\t x y \n", " x　", "﻿x ", "x", "", "   "]
    assert apply(spark, values, fn.wide_trim) == ["x y", "x", "x", "x", "", ""]


def test_half_up(spark):
    cases = [(0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -2.0), (0.25, 1, 0.3), (1e300, 2, 1e300),
             (12345.675, 2, 12345.68)]
    for x, places, want in cases:
        row = spark.range(1).select(fn.half_up(F.lit(x), places).alias("o")).first()
        assert row.o == want, (x, places)


def test_exact_sum_does_not_depend_on_partitions(spark):
    values = [0.1] * 1000 + [1e15, -1e15, 3e18, -3e18, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {df.repartition(n).agg(fn.exact_sum(F.col("v")).alias("s")).first().s for n in (1, 3, 8)}
    assert got == {100.0}


def test_exact_sum_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.agg(fn.exact_sum(F.col("v")).alias("s")).first().s == 0.0


@pytest.mark.parametrize(
    ("x", "text"),
    [(1450.0, "1450"), (1780.5, "1780.5"), (12345678.25, "12345678.25"), (0.0, "0"),
     (100.0, "100"), (-3.5, "-3.5"), (0.001, "0.001"), (1200.5, "1200.5")],
)
def test_number_text(spark, x, text):
    assert spark.range(1).select(fn.number_text(F.lit(x)).alias("o")).first().o == text


@pytest.mark.parametrize(
    ("x", "text"), [(1500.0, "$1,500"), (39483.6, "$39,483.60"), (0.0, "$0"), (4.865, "$4.87")]
)
def test_money_text(spark, x, text):
    assert spark.range(1).select(fn.money_text(F.lit(x)).alias("o")).first().o == text


@pytest.mark.parametrize(
    ("values", "total"),
    [
        ([3e-11] * 1000, 3e-8),
        ([1e17, 1.5, -1e17], 1.5),
        ([1e30, -1e30, 0.001], 0.001),
        ([-3.0, 0.25], -2.75),
        ([-0.5, -0.25, None], -0.75),
        ([0.1] * 10, 1.0),
        ([None], 0.0),
        ([1e36, 1.0], 1e36),
    ],
)
def test_exact_sums(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert df.agg(fn.exact_sum(F.col("v")).alias("s")).first().s == total


def test_numbers_of_any_length(spark):
    texts = ["1" + "0" * 308, "9" * 400, "-" + "9" * 400, "0" * 500 + "7", "$" + "1," * 3 + "5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(fn.parse_number(F.col("t")).alias("n")).collect()]
    assert got == [1e308, None, None, 7.0, 1115.0]


def test_rounding_of_large_numbers(spark):
    for x in (9.1e13 + 0.015, 5e14 + 0.25, 1e20, -1e20):
        row = spark.range(1).select(fn.half_up(F.lit(x), 2).alias("o")).first()
        want = x * 100 / 100 if abs(x * 100) >= 9e15 else __import__("math").floor(x * 100 + 0.5) / 100
        assert row.o == want
