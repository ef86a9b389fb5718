"""Cohorts, retention and monthly figures: hand cases and a pandas twin."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlens.operators import clean, cohort, metrics, report
from ledgerlens.plans import flows
from ledgerlens.operators.cohort import cohort_counts, customer_months, retention

D = dt.date
SALES = "customer_id long, month date, is_home boolean"
COUNTS = "cohort_month date, cohort_index int, customers long"


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), SALES)


def cells(df, value="customers"):
    return {(r.cohort_month, r.cohort_index): r[value] for r in df.collect()}


JAN, FEB, MAR = D(2021, 1, 1), D(2021, 2, 1), D(2021, 3, 1)


def test_cohort_is_the_first_month_over_both_sides(spark):
    df = sales(spark, (1, JAN, True), (1, FEB, False), (1, FEB, True), (2, FEB, False), (2, FEB, False))
    months = customer_months(df)
    assert cells(cohort_counts(months)) == {(JAN, 1): 1, (JAN, 2): 1, (FEB, 1): 1}
    assert cells(cohort_counts(months, "home")) == {(JAN, 1): 1, (JAN, 2): 1}
    assert cells(cohort_counts(months, "away")) == {(JAN, 2): 1, (FEB, 1): 1}


def month_of(n):
    return D(n // 12, n % 12 + 1, 1)


def plain_months(rows):
    first = {}
    for customer, month, _ in rows:
        if customer is not None and month is not None:
            first[customer] = min(month, first.get(customer, month))
    sides = {}
    for customer, month, is_home in rows:
        if customer in first and month is not None:
            sides.setdefault((customer, month), set()).add(bool(is_home))
    index = {(c, m): (m.year - first[c].year) * 12 + m.month - first[c].month + 1 for c, m in sides}
    return sorted((c, m, True in s, False in s, first[c], index[c, m]) for (c, m), s in sides.items())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 4) | st.none(), st.integers(1990 * 12, 2020 * 12) | st.none(), st.booleans() | st.none()),
        max_size=60,
    )
)
def test_calendar_months_equal_a_plain_count(spark, drawn):
    rows = [(c, None if n is None else month_of(n), home) for c, n, home in drawn]
    got = sorted(map(tuple, customer_months(sales(spark, *rows)).collect()))
    assert got == plain_months(rows)


def test_calendars_of_two_parts_merge(spark):
    r = np.random.default_rng(8)
    rows = [(int(c), month_of(2000 * 12 + int(n)), bool(h)) for c, n, h in zip(r.integers(0, 9, 300), r.integers(0, 200, 300), r.integers(0, 2, 300))]
    early, late = (cohort.customer_calendar(sales(spark, *part)) for part in (rows[:150], rows[150:]))
    merged = cohort.merge_calendars(early.unionByName(late))
    assert sorted(map(tuple, cohort.calendar_months(merged).collect())) == plain_months(rows)


def test_a_calendar_that_is_too_narrow_fails(spark):
    df = sales(spark, (1, D(2000, 1, 1), True), (1, D(2003, 1, 1), True))
    with pytest.raises(PySparkException, match="span more than 1 words"):
        cohort.calendar_months(cohort.customer_calendar(df, words=1)).collect()
    wide = cohort.calendar_months(cohort.customer_calendar(df, words=2)).collect()
    assert [r.cohort_index for r in wide] == [1, 37]


def test_span_of_counts_is_that_of_the_months(spark):
    months = customer_months(sales(spark, (1, JAN, True), (1, D(2021, 9, 1), True), (2, D(2021, 4, 1), False)))
    assert cohort.counts_span(cohort_counts(months)) == cohort.calendar_span(months) == 9
    assert cohort.counts_span(cohort_counts(months.filter("false"))) == 0


def test_away_cohort_without_first_month_has_null_rates(spark):
    df = sales(spark, (1, JAN, True), (1, FEB, False), (1, MAR, False), (2, FEB, False))
    rates = retention(cohort_counts(customer_months(df), "away"))
    assert cells(rates, "rate") == {(JAN, 2): None, (JAN, 3): None, (FEB, 1): 1.0}


def test_base_is_the_smallest_index_present(spark):
    df = spark.createDataFrame([(JAN, 2, 4), (JAN, 3, 6), (FEB, 3, 5)], COUNTS)
    assert cells(retention(df), "rate") == {(JAN, 2): 1.0, (JAN, 3): 1.5, (FEB, 3): None}
    joined = cohort.cohort_size_join(df, cohort.cohort_sizes(df))
    assert cells(joined, "rate") == cells(retention(df), "rate")


def test_base_index_is_per_scope(spark):
    df = spark.createDataFrame(
        [(JAN, 1, 2, "home"), (JAN, 2, 1, "home"), (JAN, 2, 4, "away"), (JAN, 3, 2, "away")],
        COUNTS + ", scope string",
    )
    rates = {(r.scope, r.cohort_index): r.rate for r in retention(df, ["scope"]).collect()}
    assert rates == {("home", 1): 1.0, ("home", 2): 0.5, ("away", 2): 1.0, ("away", 3): 0.5}


def test_assign_cohort_keeps_every_row(spark):
    df = sales(spark, (1, FEB, True), (1, JAN, False), (None, MAR, True), (1, FEB, True))
    got = [(r.customer_id, r.cohort_month, r.cohort_index) for r in cohort.assign_cohort(df).collect()]
    assert sorted(got, key=str) == sorted([(1, JAN, 2), (1, JAN, 1), (None, None, None), (1, JAN, 2)], key=str)


def test_pivot(spark):
    df = spark.createDataFrame([(JAN, 1, 2), (JAN, 3, 1), (FEB, 1, 5)], COUNTS)
    wide = cohort.cohort_pivot(df).orderBy("cohort_month")
    assert wide.columns == ["cohort_month", "1", "2", "3"]
    assert [tuple(r) for r in wide.collect()] == [(JAN, 2.0, None, 1.0), (FEB, 5.0, None, None)]
    fixed = cohort.cohort_pivot(df, indexes=[1, 2, 3])
    assert fixed.columns == ["cohort_month", "1", "2", "3"]
    with pytest.raises(PySparkException, match="outside the pivot"):
        cohort.cohort_pivot(df, indexes=[1, 2]).collect()


def test_drop_needs_the_index_before(spark):
    df = spark.createDataFrame([(JAN, 1, 4), (JAN, 2, 1), (JAN, 4, 2)], COUNTS)
    assert cells(cohort.retention_drop(retention(df)), "change") == {(JAN, 1): None, (JAN, 2): -0.75, (JAN, 4): None}


def test_weakest_cohort(spark):
    df = spark.createDataFrame([(JAN, 1, 4), (JAN, 2, 2), (FEB, 1, 4), (FEB, 2, 1), (FEB, 3, 1), (MAR, 1, 9)], COUNTS)
    weakest = cohort.weakest_cohort(retention(df)).first()
    assert (weakest.cohort_month, weakest.mean_rate) == (FEB, 0.25)


def test_partial_period(spark):
    rows = [(JAN, dt.datetime(2021, 1, 20)), (FEB, dt.datetime(2021, 2, 15)), (FEB, dt.datetime(2021, 2, 3))]
    df = spark.createDataFrame(rows, "month date, invoice_ts timestamp_ntz")
    assert {r.month: r.is_partial for r in metrics.partial_periods(df).collect()} == {JAN: False, FEB: True}
    whole = spark.createDataFrame([(FEB, dt.datetime(2021, 2, 28, 9))], "month date, invoice_ts timestamp_ntz")
    assert [r.is_partial for r in metrics.partial_periods(whole).collect()] == [False]


invoice = st.tuples(
    st.integers(1, 12),
    st.one_of(st.none(), st.integers(1, 5)),
    st.datetimes(dt.datetime(2020, 11, 1), dt.datetime(2021, 4, 30)).map(lambda t: t.replace(microsecond=0)),
    st.sampled_from(["United Kingdom", "France", None]),
    st.integers(-1, 3),
    st.sampled_from(["1,5", "2", "-3,25", "0,10"]),
)


def twin_clean(rows):
    """The cleaning rules, on pandas."""
    columns = ["invoice_no", "customer_id", "invoice_ts", "country", "quantity", "amount"]
    df = pd.DataFrame([(str(r[0]), *r[1:]) for r in rows], columns=columns)
    df = df[~(df.quantity < 0)].drop_duplicates().dropna()
    df["amount"] = [float(a.replace(",", ".")) for a in df.amount]
    df["month"] = [D(t.year, t.month, 1) for t in df.invoice_ts]
    return df


def twin_rates(df, first):
    """Retention by cohort and index, as a wide division by the first column."""
    index = [(m.year - first[c].year) * 12 + m.month - first[c].month + 1 for c, m in zip(df.customer_id, df.month)]
    wide = (
        df.assign(cohort=df.customer_id.map(first), idx=index)
        .groupby(["cohort", "idx"])
        .customer_id.nunique()
        .unstack()
    )
    rates = wide.div(wide[wide.columns.min()], axis=0)
    return {
        (c, i): None if np.isnan(rates.loc[c, i]) else rates.loc[c, i]
        for c in wide.index
        for i in wide.columns
        if not np.isnan(wide.loc[c, i])
    }


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(invoice, min_size=1, max_size=40))
def test_pandas_twin(spark, rows):
    raw = spark.createDataFrame(
        [(str(r[0]), *r[1:]) for r in rows],
        "invoice_no string, customer_id long, invoice_ts timestamp_ntz, country string, quantity long, "
        "amount_txt string",
    )
    ours = clean.add_features(clean.clean_sales(raw))
    twin = twin_clean(rows)
    assert ours.count() == len(twin)
    if twin.empty:
        return

    by_country = {r.country: r for r in metrics.country_panorama(ours).collect()}
    assert by_country.keys() == set(twin.country)
    for country, part in twin.groupby("country"):
        got = by_country[country]
        assert (got.customers, got.invoices) == (part.customer_id.nunique(), part.invoice_no.nunique())
        assert got["items"] == part.quantity.sum()
        money = [got.min_amount, got.max_amount, got.mean_amount, got.revenue]
        wanted = [part.amount.min(), part.amount.max(), part.amount.mean(), part.amount.sum()]
        assert [float(m) for m in money] == pytest.approx(wanted)

    monthly = metrics.monthly_sales(ours).collect()
    assert [r.month for r in monthly] == sorted(set(twin.month))
    assert [float(r.revenue) for r in monthly] == pytest.approx(list(twin.groupby("month").amount.sum()))

    kpis = metrics.customer_kpis(metrics.customer_repeats(ours)).first()
    per_customer = twin.groupby("customer_id").agg(n=("invoice_no", "nunique"), spend=("amount", "sum"))
    assert kpis.repeat_rate == pytest.approx((per_customer.n > 1).mean())
    sides = metrics.side_repeats(metrics.customer_repeats(ours))
    both = {(r.customer_id, r.is_home): r.invoices for r in sides.collect()}
    home = twin.country == "United Kingdom"
    assert both == twin.groupby(["customer_id", home])["invoice_no"].nunique().to_dict()
    assert kpis.avg_customer_spend == pytest.approx(per_customer.spend.mean())

    first = twin.groupby("customer_id").month.min().to_dict()
    months = customer_months(ours)
    home = twin.country == "United Kingdom"
    parts = {"all": twin, "home": twin[home], "away": twin[~home]}
    heat = report.heatmap_cells(months).collect()
    for scope, part in parts.items():
        wanted = twin_rates(part, first) if len(part) else {}
        assert cells(retention(cohort_counts(months, scope)), "rate") == pytest.approx(wanted)
        in_heat = {
            (D.fromisoformat(r.cohort + "-01"), r.cohort_index): r.rate for r in heat if r.scope == scope
        }
        assert in_heat == pytest.approx(wanted)


def test_rows_without_a_month_are_in_no_month(spark):
    df = spark.createDataFrame(
        [(1, "a", JAN, Decimal(10)), (1, "b", None, Decimal(20))], "customer_id long, invoice_no string, month date, amount decimal(18,2)"
    ).withColumns({"invoice_ts": F.col("month").cast("timestamp_ntz"), "is_home": F.lit(True)})
    assert [(r.months, r.avg_month_revenue) for r in metrics.avg_month_revenue(metrics.revenue_by_month(df)).collect()] == [(1, 10.0)]
    assert [r.month for r in metrics.partial_periods(df).collect()] == [JAN]
    assert [r.month for r in cohort.customer_months(df).collect()] == [JAN]


def test_span_and_pivot_of_a_long_calendar(spark):
    rows = [(1, dt.date(2000, 1, 1), True), (1, dt.date(2006, 9, 1), False)]
    months = cohort.customer_months(spark.createDataFrame(rows, "customer_id long, month date, is_home boolean"))
    assert cohort.calendar_span(months) == 81
    wide = cohort.cohort_pivot(cohort.cohort_counts(months), indexes=range(1, 82)).first()
    assert (wide["1"], wide["80"], wide["81"]) == (1.0, None, 1.0)
    assert cohort.calendar_span(months.filter("false")) == 0


# Distinct customers


def test_bitmaps_of_parts_merge_to_the_full_count(spark, tmp_path):
    r = np.random.default_rng(4)
    rows = [(int(c), month_of(24_000 + int(m)), str(k)) for c, m, k in zip(r.integers(-5, 100_000, 3000), r.integers(0, 5, 3000), r.integers(0, 3, 3000))]
    rows += [(None, JAN, "0"), (7, None, "1"), (8, JAN, None)] + rows[:50]
    df = spark.createDataFrame(rows, "customer_id long, month date, country string")
    wanted = {(c, n) for c, n in df.groupBy("country").agg(F.countDistinct("customer_id")).collect()}
    parts = [metrics.customer_bitmaps(df.filter(f"coalesce(month(month), 0) {test} 2"), ["country", "month"]) for test in ("<", ">=")]
    path = str(tmp_path / "parts")
    parts[0].write.parquet(path)
    parts[1].write.mode("append").parquet(path)
    merged = metrics.count_bitmaps(spark.read.parquet(path), ["country"])
    assert set(map(tuple, merged.collect())) == wanted
    assert metrics.count_bitmaps(spark.read.parquet(path), []).first().customers == df.agg(F.countDistinct("customer_id")).first()[0]
    # The same part a second time changes nothing.
    again = metrics.count_bitmaps(spark.read.parquet(path).union(parts[1]), ["country"])
    assert set(map(tuple, again.collect())) == wanted


def test_a_month_of_bitmaps_is_restated_alone(spark, tmp_path):
    df = spark.createDataFrame([(c, m, "F") for c in range(5) for m in (JAN, FEB)], "customer_id long, month date, country string")
    path = str(tmp_path / "bits")
    flows.store_customer_bitmaps(df, path)
    files = sorted((tmp_path / "bits" / f"month={JAN}").glob("*.parquet"))
    flows.store_customer_bitmaps(df.filter(F.col("month") == F.lit(FEB)).filter("customer_id < 2"), path)
    assert sorted((tmp_path / "bits" / f"month={JAN}").glob("*.parquet")) == files
    counts = {r.month: r.customers for r in metrics.count_bitmaps(spark.read.parquet(path), ["month"]).collect()}
    assert counts == {JAN: 5, FEB: 2}
