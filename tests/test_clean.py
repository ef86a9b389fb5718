"""Cleaning rules, case by case."""

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from ledgerlens.operators import clean, profile
from ledgerlens.plans import flows

COLUMNS = "invoice_no string, customer_id long, invoice_ts string, country string, quantity long, amount_txt string"
FORMAT = "dd/MM/yyyy HH:mm"


def row(invoice="1", customer=1, ts="01/12/2020 08:26", country="France", quantity=1, amount="10,0"):
    return (invoice, customer, ts, country, quantity, amount)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def test_negative_quantity_goes_and_unknown_stays(spark):
    df = table(spark, row("1", quantity=1), row("2", quantity=None), row("3", quantity=-1), row("4", quantity=0))
    assert {r.invoice_no for r in clean.drop_negative(df).collect()} == {"1", "2", "4"}


def test_negative_amount_with_quantity_zero_stays(spark):
    df = table(spark, row(quantity=0, amount="-5,00"))
    assert [float(r.amount) for r in clean.clean_sales(df, FORMAT).collect()] == [-5.0]


def test_duplicates_are_compared_as_text(spark):
    df = table(spark, row(amount="10,0"), row(amount="10,00"), row(amount="10,0"))
    assert clean.clean_sales(df, FORMAT).count() == 2


def test_null_rows_are_duplicates_of_each_other(spark):
    df = table(spark, row(customer=None), row(customer=None), row())
    assert clean.drop_duplicates(df).count() == 2


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


MIXED = "a string, b string, x double, n long"


def mixed_rows(spark, n=400):
    r = np.random.default_rng(9)
    pick = lambda *values: values[r.integers(0, len(values))]
    rows = [(pick("", "u", "v", None), pick("", "u", "uv", None), pick(0.0, -0.0, float("nan"), 1.5, None), pick(0, 1, None)) for _ in range(n)]
    return spark.createDataFrame(rows, MIXED).repartition(5)


@pytest.mark.parametrize(
    "digest",
    [
        clean.row_digest,
        lambda df: (F.lit(1).cast("long"), F.lit(2).cast("long")),
        lambda df: (F.xxhash64("a"), F.lit(0).cast("long")),
    ],
    ids=["own", "all collide", "some collide"],
)
def test_duplicates_by_digest_are_those_of_whole_rows(spark, digest):
    df = mixed_rows(spark).withColumn("a b", F.col("n") % 2)
    got = clean.drop_duplicates_by_digest(df, digest)
    assert got.columns == df.columns
    assert same_rows(got, clean.drop_duplicates(df))
    assert clean.drop_duplicates_by_digest(df.filter("false"), digest).isEmpty()


def test_digest_tells_nulls_apart(spark):
    rows = [(None, "u", 1.0, 1), ("u", None, 1.0, 1), ("u", "", 1.0, 1), ("", "u", 1.0, 1)]
    df = spark.createDataFrame(rows, MIXED)
    assert df.select(*clean.row_digest(df)).distinct().count() == 4


@pytest.mark.parametrize("field", ["invoice", "customer", "ts", "country", "quantity", "amount"])
def test_any_null_removes_the_row(spark, field):
    df = table(spark, row(), row(**{field: None}))
    assert clean.drop_missing(df).count() == 1


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert clean.drop_missing(df).count() == 1


def test_dates_and_amounts_are_parsed(spark):
    (out,) = clean.clean_sales(table(spark, row(ts="13/03/2021 23:05", amount="139,12")), FORMAT).collect()
    assert out.invoice_ts == dt.datetime(2021, 3, 13, 23, 5)
    assert str(out.amount) == "139.12"


def test_text_dates_need_a_format(spark):
    with pytest.raises(ValueError):
        clean.clean_sales(table(spark, row()))


@pytest.mark.parametrize("bad", [{"amount": "1.234,56"}, {"amount": "abc"}, {"amount": "1,234"}, {"ts": "2020-12-01"}])
def test_bad_text_fails_or_becomes_null(spark, bad):
    df = table(spark, row("good"), row("bad", **bad))
    with pytest.raises(PySparkException):
        clean.clean_sales(df, FORMAT).collect()
    lenient = {r.invoice_no: tuple(r) for r in clean.clean_sales(df, FORMAT, on_error="null").collect()}
    assert None not in lenient["good"]
    assert None in lenient["bad"]
    assert [r.invoice_no for r in clean.unparsable(df, FORMAT).collect()] == ["bad"]


def test_rejected_rows_have_their_reasons(spark):
    df = table(
        spark,
        row("good"),
        row("date", ts="2020-12-01"),
        row("amount", amount="1.234,56"),
        row("both", ts="31/02/2020 00:00", amount="abc"),
        row("refund", ts="x", quantity=-1),
        row("null", ts=None),
    )
    routes = clean.routed(clean.whole_rows(df), FORMAT)
    assert {r.invoice_no: r.reason for r in clean.rejected(routes).collect()} == {
        "date": "bad_date", "amount": "bad_amount", "both": "bad_date,bad_amount",
    }
    (good,) = clean.accepted(routes, FORMAT).collect()
    assert good.invoice_no == "good" and good.invoice_ts == dt.datetime(2020, 12, 1, 8, 26)
    typed, rejects = flows.routed_sales(clean.whole_rows(df), FORMAT)
    assert rejects.columns == [*df.columns, "reason"] and rejects.count() == 3
    assert [r.invoice_no for r in typed.collect()] == ["good"] and {"month", "is_home", "amount"} <= set(typed.columns)


def test_typed_dates_are_never_rejected(spark):
    df = table(spark, row()).withColumn("invoice_ts", F.lit("2021-01-01").cast("timestamp_ntz"))
    assert clean.rejected(clean.routed(clean.whole_rows(df))).isEmpty()
    with pytest.raises(ValueError):
        clean.routed(table(spark, row()))


def test_observed_audit_equals_the_counted_one(spark):
    df = table(spark, row("1"), row("1"), row("2", quantity=-1), row("3", customer=None), row("4"), row("4"))
    for rows in (df, df.filter("false")):
        seen, left = Observation("seen"), Observation("left")
        kept = clean.observed_whole_rows(rows, seen, left).collect()
        assert sorted(kept) == sorted(clean.whole_rows(rows).collect())
        got = profile.observed_audit(spark, seen, left)
        assert sorted(got.collect()) == sorted(profile.clean_audit(rows).collect())


def test_home_flag_of_unknown_country_is_false(spark):
    df = spark.createDataFrame([("United Kingdom",), ("France",), (None,)], "country string")
    assert [r[0] for r in df.select(clean.home_flag("country")).collect()] == [True, False, False]
    assert [r[0] for r in df.select(clean.home_flag("country", "France")).collect()] == [False, True, False]


def test_missing_side_is_empty(spark):
    sales = clean.add_features(clean.clean_sales(table(spark, row()), FORMAT))
    assert clean.split_home(sales).count() == 0
    assert clean.split_away(sales).count() == 1


def test_audit_counts_rows_after_each_step(spark):
    df = table(
        spark, row("1"), row("1"), row("2", quantity=-1), row("2", quantity=-1), row("3", customer=None), row("4")
    )
    audit = {r.step: (r.rows, r.removed) for r in profile.clean_audit(df).collect()}
    assert audit == {
        "raw": (6, 0),
        "drop_negative": (4, 2),
        "drop_duplicates": (3, 1),
        "drop_missing": (2, 1),
    }


def test_audit_of_nothing(spark):
    assert [r.rows for r in profile.clean_audit(table(spark)).collect()] == [0, 0, 0, 0]


def test_further_columns_take_part_in_cleaning(spark):
    more = COLUMNS + ", `seller name` string"
    df = spark.createDataFrame([row() + ("a",), row() + ("b",), row() + (None,)], more)
    assert clean.clean_sales(df, FORMAT).count() == 2
    assert {r.column for r in profile.profile_columns(df).collect()} >= {"seller name", "amount_txt"}
    assert [r.rows for r in profile.clean_audit(df).collect()] == [3, 3, 3, 2]


def test_profile(spark):
    df = table(spark, row(), row(customer=None), row(country=None))
    by_column = {r.column: r for r in profile.profile_columns(df).collect()}
    assert (by_column["customer_id"].type, by_column["customer_id"].non_null) == ("bigint", 2)
    missing = {r.column: r.missing for r in profile.profile_missing(df).collect()}
    assert (missing["country"], missing["quantity"]) == (1, 0)
    shape = profile.profile_shape(df).first()
    assert (shape.rows, shape.columns) == (3, 6)
    assert shape.sentence == "A base de dados apresenta 3 registros de compras (linhas) e 6 variáveis (colunas)"


def test_zero_amounts(spark):
    sales = clean.clean_sales(table(spark, row("1", amount="0,00"), row("2"), row("3"), row("4")), FORMAT)
    assert tuple(profile.audit_zero_amount(sales).first()) == (1, 4, 0.25)


def test_nan_is_missing_in_audit_and_cleaning(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert [tuple(r) for r in profile.profile_missing(df).collect()] == [("x", 1)]
    assert clean.drop_missing(df).count() == 1


def test_profile_from_footers(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 1.0, "a", [1], None), (None, float("nan"), None, None, None), (3, None, "", [], None)],
        "n long, x double, `a b` string, items array<int>, nothing date",
    )
    df.repartition(2).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = profile.profile_stored(spark, str(tmp_path / "t"))
    assert sorted(got.collect()) == sorted(profile.profile_columns(df).collect())
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
