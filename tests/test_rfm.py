"""Scores, edges, segments and Pareto on hand-made customers."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlens.operators import ranking, rfm
from ledgerlens.plans import flows
from ledgerlens.sources.segments import default_segments

SCHEMA = "customer_id long, recency long, frequency long, monetary decimal(28,2)"
EDGES = "measure string, p25 decimal(30,4), p50 decimal(30,4), p75 decimal(30,4), max decimal(28,2)"
MEASURES = ["recency", "frequency", "monetary"]


def customers(spark, values):
    rows = [(i, int(v), int(v), Decimal(str(v))) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def edge_table(spark, *edges):
    return spark.createDataFrame([(m, *map(Decimal, edges)) for m in MEASURES], EDGES)


def scores(spark, values, edges, mode="collapse"):
    scored = rfm.rfm_scores(customers(spark, values), edge_table(spark, *edges), mode)
    return [tuple(r) for r in scored.orderBy("customer_id").select("r", "f", "m").collect()]


def test_bins_are_right_closed(spark):
    wanted = [(s, s, s) for s in (1, 1, 2, 2, 3, 4, 4)]
    for mode in ("collapse", "error"):
        assert scores(spark, [0, 10, 11, 20, 30, 31, 31], ["10", "20", "30", "31"], mode) == wanted


def test_repeated_edges(spark):
    edges = ["1", "1", "2", "3"]
    assert scores(spark, [1, 2, 3], edges) == [(1,) * 3, (3,) * 3, (4,) * 3]
    with pytest.raises(PySparkException, match="edges must rise"):
        scores(spark, [1, 2, 3], edges, "error")


def test_lowest_bin_is_open_below(spark):
    edges = ["10", "20", "30", "31"]
    assert scores(spark, [-1, -7], edges) == [(1,) * 3] * 2
    with pytest.raises(PySparkException, match="below the lowest"):
        scores(spark, [-1], edges, "error")
    assert scores(spark, [0], edges, "error") == [(1,) * 3]


def test_edges_equal_to_maximum_or_below_minus_one_are_bad(spark):
    for edges in (["1", "2", "3", "3"], ["-2", "2", "3", "4"], ["-1", "2", "3", "4"]):
        with pytest.raises(PySparkException, match="edges must rise"):
            scores(spark, [1], edges, "error")


def test_percentiles_interpolate(spark):
    edges = rfm.rfm_edges(customers(spark, [1, 2, 2, 3, 10, 11])).collect()
    assert {tuple(map(float, r[1:])) for r in edges} == {(2.0, 2.5, 8.25, 11.0)}


def test_percentiles_of_one_row_and_of_none(spark):
    (edge,) = {tuple(map(float, r[1:])) for r in rfm.rfm_edges(customers(spark, [7])).collect()}
    assert edge == (7.0,) * 4
    assert rfm.rfm_edges(customers(spark, [])).collect() == []


def test_amounts_with_three_decimals_keep_them(spark):
    base = spark.createDataFrame([(Decimal(v),) for v in ("0.125", "0.250", "1.001")], "monetary decimal(28,3)")
    row = ranking.exact_percentiles(base, ["monetary"], [25, 50]).first()
    assert (row.p25, row.p50, row.max) == (Decimal("0.1875"), Decimal("0.25"), Decimal("1.001"))
    top = ranking.pareto_customers(ranking.pareto_curve(base)).filter("percent IN (67, 100)").orderBy("percent")
    assert [r.revenue for r in top.collect()] == [Decimal("1.251"), Decimal("1.376")]


money = st.integers(-500, 500) | st.sampled_from([0, 100, 250])


@pytest.mark.parametrize("kind", ["decimal(28,2)", "decimal(28,10)"])
def test_spend_beyond_a_machine_word(spark, kind):
    amounts = [Decimal("123456789.5"), Decimal("1" + "0" * 15), Decimal("0.25")]
    base = spark.createDataFrame([(a,) for a in amounts], f"monetary {kind}")
    row = ranking.exact_percentiles(base, ["monetary"], [50]).first()
    assert (row.p50, row.max) == (amounts[0], amounts[1])
    best = ranking.pareto_curve(base).orderBy("top_customers").collect()
    assert [r.top_revenue for r in best] == [amounts[1], amounts[1] + amounts[0], sum(amounts)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.integers(-(10**27), 10**27) | st.integers(-3, 3), min_size=1, max_size=40),
    digits=st.sampled_from([2, 3, 1024]),
)
def test_radix_selection_of_any_digit(spark, values, digits):
    before, ranking._DIGITS = ranking._DIGITS, digits
    try:
        wanted = {"x": set(range(len(values)))}
        kind = ranking.T.DecimalType(30, 2)
        df = spark.createDataFrame([(Decimal(v).scaleb(-2),) for v in values], "x decimal(30,2)")
        found = ranking._selected(df, kind, wanted, {"x": (min(values), max(values))})
    finally:
        ranking._DIGITS = before
    assert [found["x", r] for r in range(len(values))] == sorted(values)


def test_percentiles_over_many_ranges(spark):
    values = [(i * 7919) % 5003 for i in range(5003)] + [100] * 2500
    df = spark.createDataFrame([(Decimal(v) / 100,) for v in values], "x decimal(28,2)")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = ranking.exact_percentiles(df, ["x"], [1, 25, 50, 75, 99]).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for p in (1, 25, 50, 75, 99):
        assert float(row[f"p{p}"]) == pytest.approx(np.percentile(values, p) / 100, abs=1e-9)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cents=st.lists(money, min_size=1, max_size=60))
def test_percentiles_equal_numpy(spark, cents):
    values = [c / 100 for c in cents]
    df = spark.createDataFrame([(Decimal(c) / 100,) for c in cents], "x decimal(28,2)").repartition(4)
    row = ranking.exact_percentiles(df, ["x"], [10, 25, 50, 75, 99]).first()
    got = [float(row[f"p{p}"]) for p in (10, 25, 50, 75, 99)]
    assert got == pytest.approx([np.percentile(values, p) for p in (10, 25, 50, 75, 99)], abs=1e-9)
    assert float(row["max"]) == max(values)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cents=st.lists(money, min_size=1, max_size=80), parts=st.integers(1, 9))
def test_cumulated_histogram_equals_brute_force(spark, cents, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([("g", Decimal(c) / 100) for c in cents], "g string, x decimal(28,2)")
        rows = ranking.cumulate(ranking.ranged_histogram(df, "g", "x"), "g", "x").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    exact = [Decimal(c) / 100 for c in cents]
    assert {r.x for r in rows} == set(exact)
    for r in rows:
        below = [x for x in exact if x < r.x]
        assert (r.n, r.n_below, r.n_total) == (exact.count(r.x), len(below), len(exact))
        assert (r.amount_below, r.amount_total) == (sum(below), sum(exact))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cents=st.lists(st.sampled_from([100, 100, 200, 350, 999, 0]), min_size=1, max_size=120))
def test_pareto_equals_brute_force(spark, cents):
    base = spark.createDataFrame([(Decimal(c) / 100,) for c in cents], "monetary decimal(28,2)")
    rows = ranking.pareto_customers(ranking.pareto_curve(base)).orderBy("percent").collect()
    ordered = sorted((Decimal(c) / 100 for c in cents), reverse=True)
    assert [r.percent for r in rows] == list(range(1, 101))
    for r in rows:
        take = r.percent * len(cents) // 100
        assert (r.customers, r.revenue) == (take, sum(ordered[:take]))


def test_recency_and_frequency(spark):
    sales = spark.createDataFrame(
        [
            (1, "2021-01-01 23:00:00", "a", "1.00"),
            (1, "2021-01-01 10:00:00", "a", "2.00"),
            (None, "2021-01-05 00:00:00", "b", "4.00"),
        ],
        "customer_id long, t string, invoice_no string, v string",
    ).select(
        "customer_id",
        F.col("t").cast("timestamp_ntz").alias("invoice_ts"),
        "invoice_no",
        F.col("v").cast("decimal(18,2)").alias("amount"),
    )
    (r,) = rfm.add_recency(rfm.rfm_base(sales), dt.datetime(2021, 1, 2, 1)).collect()
    # Rows are counted, not distinct invoices; a missing id is no customer.
    assert (r.customer_id, r.frequency, r.monetary, r.recency) == (1, 2, Decimal("3.00"), 0)


def test_aware_as_of_is_refused(spark):
    with pytest.raises(ValueError):
        rfm.add_recency(spark.range(1), dt.datetime.now(dt.UTC))


def test_default_lookup_has_each_code_once(spark):
    rows = default_segments(spark).collect()
    assert sorted(r.rfm for r in rows) == [f"{r}{f}{m}" for r in "1234" for f in "1234" for m in "1234"]
    by_code = {r.rfm: r.category for r in rows}
    assert len(set(by_code.values())) == 9
    assert by_code["144"] == "Melhores clientes"
    assert by_code["411"] == "Perdidos"


def coded(spark, *codes):
    rows = [(i, c, Decimal(10)) for i, c in enumerate(codes)]
    return spark.createDataFrame(rows, "customer_id long, rfm_code string, monetary decimal(28,2)")


def lookup(spark, *rows):
    return spark.createDataFrame(list(rows), "rfm string, category string")


def test_unlisted_codes_stay_without_segment(spark):
    joined = rfm.join_segments(coded(spark, "144", "111"), lookup(spark, ("144", "a"), ("999", "b")))
    assert {(r.rfm_code, r.rfm, r.category) for r in joined.collect()} == {("144", "144", "a"), ("111", None, None)}
    assert "rfm" not in rfm.drop_key(joined).columns


def test_duplicate_codes(spark):
    twice = lookup(spark, ("144", "a"), ("144", "b"))
    with pytest.raises(PySparkException, match="listed twice"):
        rfm.join_segments(coded(spark, "144"), twice).collect()
    expanded = rfm.join_segments(coded(spark, "144"), twice, "expand")
    assert expanded.count() == 2


def test_summary_leaves_out_null_segment(spark):
    rows = [(1, "a", Decimal(1)), (2, None, Decimal(2)), (3, "b", Decimal(3)), (3, "b", Decimal(3))]
    labelled = spark.createDataFrame(rows, "customer_id long, category string, monetary decimal(28,2)")
    got = [tuple(r) for r in rfm.segment_summary(labelled).collect()]
    assert got == [("b", 1, Decimal(6)), ("a", 1, Decimal(1))]


def test_scoring_from_base(spark):
    values = [1, 2, 2, 3, 10, 11, 4, 8]
    rows = [
        (i, dt.datetime(2021, 1, 31 - v), dt.datetime(2021, 1, 1), v, Decimal(v)) for i, v in enumerate(values)
    ]
    base = spark.createDataFrame(
        rows,
        "customer_id long, last_ts timestamp_ntz, first_ts timestamp_ntz, frequency long, monetary decimal(28,2)",
    )
    scored = flows.scored_customers(base, dt.datetime(2021, 1, 31))
    p25, p50, p75 = (np.percentile(values, p) for p in (25, 50, 75))
    for row in scored.collect():
        v = values[row.customer_id]
        score = 1 + (v > p25) + (v > p50) + (v > p75)
        assert (row.recency, row.rfm_code) == (v, str(score) * 3)
