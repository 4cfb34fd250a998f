"""Number, date and text rules on the inputs where lenient engines differ."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from risklake.functions import bands, money, parse, text

NUMBERS = [
    ("12.7", 12, 12.7), ("abc", 0, 0.0), ("", 0, 0.0), ("R$ 10", 0, 0.0), (" 12", 12, 12.0), ("\t5", 5, 5.0),
    ("720,5", 720, 720.0), ("1e3", 1, 1000.0), ("1.234,56", 1, 1.234), ("inf", 0, 0.0), ("nan", 0, 0.0),
    ("0x1A", 0, 0.0), ("99999999999999999999", 9223372036854775807, 1e20),
    ("-99999999999999999999", -9223372036854775808, -1e20), ("9" * 60, 9223372036854775807, float("9" * 60)),
    (None, None, None), ("-7", -7, -7.0), ("+8x", 8, 8.0), (".5", 0, 0.5), ("5.", 5, 5.0), ("-", 0, 0.0),
    ("1.5d", 1, 1.5), ("1e", 1, 1.0), ("1e400", 1, float("inf")), ("00012", 12, 12.0), ("5000,50", 5000, 5000.0),
    ("9223372036854775807", 9223372036854775807, 9223372036854775807.0), (" 12", 0, 0.0), ("--1", 0, 0.0),
]

DAY = dt.date(2021, 1, 5)
DATES = [
    ("2021-01-05", DAY), ("2021-1-5", None), ("31/12/2021", None), ("", None), (" 2021-01-05", None),
    ("2021-01-05 ", DAY), ("2021-01-05 10:30", DAY), ("2021-01-05T10:30:00Z", DAY), ("2021-01-05T10:30z", DAY),
    ("2021-01-05 23:30:00-03:00", dt.date(2021, 1, 6)), ("2021-01-05 01:30+02:00", dt.date(2021, 1, 4)),
    ("2021-13-01", None), ("2021-02-32", None), ("2021-02-31", None), (None, None), ("2459000", None),
    ("12:00", None), ("now", None), ("2021-01-05T", DAY), ("2021-01-05 10", None), ("2021-01-05 10:30:15.250", DAY),
    ("2021-01-05 10:30 Z ", DAY), ("2021-01-05Z", None), ("2021-01-05 25:00", None), ("2021-01-5 ", None),
    ("2021-1-05T", None), ("1969-12-31 23:00", dt.date(1969, 12, 31)), ("0001-01-01", dt.date(1, 1, 1)),
]


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")


def results(df, *exprs):
    return [tuple(row)[1:] for row in df.select("i", *exprs).orderBy("i").collect()]


def test_numbers(spark):
    df = column(spark, [n[0] for n in NUMBERS])
    got = results(df, parse.to_integer(F.col("x")), parse.to_real(F.col("x")))
    assert [(n[0], *g) for n, g in zip(NUMBERS, got)] == NUMBERS


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_dates_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = results(column(spark, [d[0] for d in DATES]), parse.to_date(F.col("x")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(d[0], *g) for d, g in zip(DATES, got)] == DATES


def test_delays_over_days_that_the_calendar_lacks(spark):
    """A day too many counts on from the first of the month and is not shown as a date; hour 24 is the next day."""
    texts = ["2021-02-31", "2021-02-20 24:00", "2021-04-31T06:00", "2021-02-30 24:00Z", "2021-02-32", "2021-00-10", "2021-02-20 25:00"]
    df = column(spark, texts)
    first = parse.millis_to_julian(parse.to_millis(F.lit("2021-02-01")))
    got = results(df, parse.to_date(F.col("x")), parse.millis_to_julian(parse.to_millis(F.col("x"))) - first)
    assert got == [(None, 30.0), (dt.date(2021, 2, 21), 20.0), (None, 89.25), (None, 30.0), (None, None), (None, None), (None, None)]


def test_julian_days(spark):
    df = column(spark, ["2000-01-01 12:00", "1970-01-01", "2021-01-05 18:00", "x"])
    got = results(df, parse.millis_to_julian(parse.to_millis(F.col("x"))))
    assert got == [(2451545.0,), (2440587.5,), (2459220.25,), (None,)]


def test_clocks(spark):
    """Seconds, three digits of a fraction and the zone, each with and without the others."""
    clocks = {"T10:30": 0, " 10:30:15": 15000, " 10:30:15.2": 15200, " 10:30:15.2509Z": 15250, " 10:30:15-00:30": 1815000}
    clocks |= {" 10:30-03:00": 10800000, "T10:30:15.25 +14:59": 15250 - 53940000, " 10:30 Z": 0, " 10:30:5": None}
    df = column(spark, ["2021-01-05" + clock for clock in clocks])
    start = parse.to_millis(F.lit("2021-01-05 10:30"))
    assert results(df, parse.to_millis(F.col("x")) - start) == [(n,) for n in clocks.values()]


def test_text(spark):
    df = column(spark, ["  são paulo ", "\tab ", None, "NA", " NA ", "", "null", "-"])
    assert results(df, text.code(F.col("x"))) == [
        ("SãO PAULO",), ("\tAB",), (None,), ("NA",), ("NA",), ("",), ("NULL",), ("-",),
    ]
    assert [r[0] for r in results(df, text.na_to_null(F.col("x")))] == [
        "  são paulo ", "\tab ", None, None, " NA ", None, None, "-",
    ]


def test_bands(spark):
    df = spark.createDataFrame(
        [(i, *v) for i, v in enumerate([(749, 9999.9), (750, 10000.0), (599, 4999.0), (600, 5000.0), (500, 2000.0),
         (499, 1999.9), (None, None)])], "i int, score long, income double",
    )
    assert results(df, bands.score_band(F.col("score")), bands.income_band(F.col("income"))) == [
        ("MEDIO", "MEDIA"), ("BAIXO", "ALTA"), ("ALTO", "BAIXA"), ("MEDIO", "MEDIA"), ("ALTO", "BAIXA"),
        ("MUITO_ALTO", "MUITO_BAIXA"), ("MUITO_ALTO", "MUITO_BAIXA"),
    ]
    delays = spark.createDataFrame([(i, d) for i, d in enumerate([61.0, 60.0, 30.5, 30.0, None])], "i int, d double")
    assert [r[0] for r in results(delays, bands.delay_points(F.col("d")))] == [30, 15, 15, 5, 5]
    kinds = column(spark, ["ATRASO_30", "ATRASO_60", "ATRASO_90", "CALOTE", " CALOTE", "calote", None])
    assert [r[0] for r in results(kinds, bands.severity(F.col("x")))] == [1, 2, 3, 4, 0, 0, 0]


def test_rounding_and_ratios(spark):
    df = spark.createDataFrame([(0, 2, 3), (1, 1, 0), (2, None, 5), (3, 1, 8)], "i int, a long, b long")
    assert [r[0] for r in results(df, money.percent(F.col("a"), F.col("b")))] == [66.67, None, None, 12.5]
    ties = spark.createDataFrame([(i, v) for i, v in enumerate([2.675, 1.005, 8.345, -2.5])], "i int, v double")
    assert [r[0] for r in results(ties, F.round("v", 2))] == [2.68, 1.01, 8.35, -2.5]


def test_counts_past_the_long_range_raise(spark):
    product = F.col("a").cast("decimal(20,0)") * F.col("b")
    df = spark.createDataFrame([(0, 3, 4), (2, None, 2)], "i int, a long, b long")
    assert [r[0] for r in results(df, money.count_of(product))] == [12, None]
    large = spark.createDataFrame([(0, 10**12, 10**12)], "i int, a long, b long")
    with pytest.raises(Exception, match="count past the long range: 1000000000000000000000000"):
        results(large, money.count_of(product))
