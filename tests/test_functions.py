"""Date and number expressions on hand-made values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlens.functions import dates, numbers


def values(spark, rows, kind, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_month_floor_and_label(spark):
    ts = [dt.datetime(2021, 3, 31, 23, 59), dt.datetime(2020, 2, 29)]
    assert values(spark, ts, "timestamp_ntz", dates.month_floor) == [dt.date(2021, 3, 1), dt.date(2020, 2, 1)]
    assert values(spark, ts, "timestamp_ntz", lambda x: dates.month_label(dates.month_floor(x))) == [
        "2021-03",
        "2020-02",
    ]


def test_cohort_index_crosses_years(spark):
    months = [dt.date(2020, 12, 1), dt.date(2021, 1, 1), dt.date(2022, 3, 1)]
    start = F.lit(dt.date(2020, 12, 1))
    assert values(spark, months, "date", lambda x: dates.cohort_index(x, start)) == [1, 2, 16]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Europe/London"])
def test_elapsed_days_round_down_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        as_of = dt.datetime(2021, 3, 29, 1, 0)
        last = [
            dt.datetime(2021, 3, 28, 23, 0),
            dt.datetime(2021, 3, 28, 1, 0),
            dt.datetime(2021, 3, 27, 1, 0, 0, 1),
            dt.datetime(2021, 3, 30, 0, 0),
            dt.datetime(2021, 3, 30, 1, 0),
            dt.datetime(2021, 3, 30, 1, 0, 0, 1),
            dt.datetime(1700, 1, 1),
            None,
        ]
        wanted = [None if t is None else (as_of - t).days for t in last]
        assert wanted[:6] == [0, 1, 1, -1, -1, -2]
        assert values(spark, last, "timestamp_ntz", lambda x: dates.elapsed_days(as_of, x)) == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_decimal_comma(spark):
    texts = ["139,12", "0,5", "-3", " 7,00", "12.5", None]
    got = values(spark, texts, "string", numbers.parse_decimal_comma)
    assert [None if v is None else float(v) for v in got] == [139.12, 0.5, -3.0, 7.0, 12.5, None]


@pytest.mark.parametrize("bad", ["1.234,56", "", "x", "0,001", "99999999999999999,00"])
def test_bad_amounts(spark, bad):
    with pytest.raises(PySparkException):
        values(spark, [bad], "string", numbers.parse_decimal_comma)
    assert values(spark, [bad], "string", lambda x: numbers.parse_decimal_comma(x, "null")) == [None]


def test_more_decimals_on_request(spark):
    got = values(spark, ["0,001", "12,5"], "string", lambda x: numbers.parse_decimal_comma(x, scale=3))
    assert [str(v) for v in got] == ["0.001", "12.500"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_fails_in_either_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            values(spark, ["x"], "string", numbers.parse_decimal_comma)
        with pytest.raises(PySparkException):
            values(spark, ["x"], "string", lambda x: dates.parse_timestamp(x, "dd/MM/yyyy"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_round_rate_is_half_even(spark):
    assert values(spark, [0.0005, 0.3125, 0.0625], "double", numbers.round_rate) == [0.0, 0.312, 0.062]


def test_currency_text(spark):
    amounts = [0.125, 2.675, 1234567.005, -1.5]
    wanted = ["£0.12", "£2.67", "£1,234,567.00", "£-1.50"]
    assert values(spark, amounts, "double", numbers.format_currency) == wanted
    assert wanted == [f"£{a:,.2f}" for a in amounts]


def test_percent_text(spark):
    rates = [0.125, 0.005, 0.015, 0.385, None]
    assert values(spark, rates, "double", numbers.format_percent) == ["12%", "0%", "2%", "38%", None]


def test_heat_intensity(spark):
    rates = [-0.1, 0.0, 0.25, 0.5, 0.9, None]
    assert values(spark, rates, "double", numbers.heat_intensity) == [0.0, 0.0, 0.5, 1.0, 1.0, None]


@pytest.mark.parametrize(
    ("text", "scale"), [("1,00000000004", 2), ("0,123456789012", 11), ("1,001", 2), ("1e-3", 2), ("1234567890123456789", 2)]
)
def test_no_decimal_is_rounded_away(spark, text, scale):
    assert values(spark, [text], "string", lambda x: numbers.parse_decimal_comma(x, "null", scale)) == [None]
    with pytest.raises(PySparkException, match="not decimal"):
        values(spark, [text], "string", lambda x: numbers.parse_decimal_comma(x, scale=scale))


def test_wide_scales_and_zeros(spark):
    read = lambda text, scale: values(spark, [text], "string", lambda x: numbers.parse_decimal_comma(x, scale=scale))[0]
    assert read("0,123456789012", 12) == Decimal("0.123456789012")
    assert read("1000000,000000000001", 12) == Decimal("1000000.000000000001")
    assert read("1,5000000000000000", 2) == Decimal("1.50")
    assert read("1e2", 2) == 100
    assert read(",5", 2) == Decimal("0.50")


def test_ids_beyond_ten_decimals(spark):
    assert values(spark, ["17850.00000000001"], "string", lambda x: numbers.parse_whole(x, "null")) == [None]
    assert values(spark, ["17850.000000000000"], "string", numbers.parse_whole) == [17850]
    assert values(spark, ["9223372036854775808"], "string", lambda x: numbers.parse_whole(x, "null")) == [None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("mode", ["fail", "null"])
def test_dates_do_not_depend_on_the_zone(spark, zone, mode):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, ["14/03/2021 02:30"], "string", lambda x: dates.parse_timestamp(x, "dd/MM/yyyy HH:mm", mode))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.datetime(2021, 3, 14, 2, 30)]
