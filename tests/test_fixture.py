"""Known figures of the order tables, and relations between results."""

import datetime as dt

import pytest
from compare import TESTDATA
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerlens.operators import rfm
from ledgerlens.plans import flows
from ledgerlens.sources.star import sales_from_orders

# Per scale factor: raw rows, with id, negative quantity, clean rows, customers.
COUNTS = {
    "sf0.001": (1530, 1311, 137, 1169, 150),
    "sf0.01": (15300, 13115, 1362, 11713, 1499),
    "sf0.1": (153000, 131143, 13650, 117106, 14993),
}
SEGMENTS = {
    "sf0.001": [8, 26, 10, 14, 17, 18, 28, 8, 21],
    "sf0.01": [77, 256, 99, 183, 138, 192, 246, 99, 209],
    "sf0.1": [767, 2466, 1032, 1832, 1408, 1916, 2482, 1051, 2039],
}
NAMES = [
    "Melhores clientes",
    "Leais",
    "Potenciais leais",
    "Novos",
    "Promissores",
    "Precisa de atenção!",
    "Prestes a hibernar",
    "Hibernando",
    "Perdidos",
]
EDGES = {
    "sf0.001": [(79, 228, 402.25), (6, 8, 9)],
    "sf0.01": [(89, 213, 433.5), (6, 8, 10)],
    "sf0.1": [(91, 216, 429), (6, 8, 10)],
}
TOP_FIFTH = {"sf0.001": 0.3259, "sf0.01": 0.3185, "sf0.1": 0.3234}


@pytest.fixture(params=sorted(COUNTS))
def sf(request):
    return request.param


def run(spark, sf, name):
    return queries()[name](spark, str(TESTDATA / sf))


def test_row_counts(spark, sf):
    raw = sales_from_orders(spark, str(TESTDATA / sf)).agg(
        F.count("*"), F.count("customer_id"), F.count_if(F.col("quantity") < 0)
    )
    cleaned = run(spark, sf, "clean_sales").agg(F.count("*"), F.countDistinct("customer_id"))
    assert (*raw.first(), *cleaned.first()) == COUNTS[sf]


def test_segments(spark, sf):
    got = {r.category: r.customers for r in run(spark, sf, "segment_summary").collect()}
    assert got == dict(zip(NAMES, SEGMENTS[sf]))


def test_edges(spark, sf):
    got = {r.measure: (r.p25, r.p50, r.p75) for r in run(spark, sf, "rfm_edges").collect()}
    assert [got["recency"], got["frequency"]] == EDGES[sf]


def test_top_fifth(spark, sf):
    share = run(spark, sf, "pareto_customers").filter("percent = 20").first().revenue_share
    assert round(share, 4) == TOP_FIFTH[sf]


def test_totals_agree(spark, sf):
    by_month = run(spark, sf, "monthly_sales").agg(F.sum("revenue")).first()[0]
    by_country = run(spark, sf, "country_panorama").agg(F.sum("revenue")).first()[0]
    assert by_month == pytest.approx(by_country, rel=1e-12)
    home, away = (run(spark, sf, f"split_{side}").count() for side in ("home", "away"))
    assert home + away == COUNTS[sf][3]


def test_first_month_rate_is_one(spark, sf):
    firsts = run(spark, sf, "retention").filter("cohort_index = 1")
    assert firsts.filter("rate <> 1 OR rate IS NULL").count() == 0


def test_strict_bins_refuse_a_slice_with_tied_edges(spark, sf):
    """In 13 months most customers bought once or twice, so quartiles repeat."""
    sales = flows.prepared_sales(sales_from_orders(spark, str(TESTDATA / sf)))
    base = rfm.rfm_base(sales.filter("month BETWEEN DATE '2000-07-01' AND DATE '2001-07-31'"))
    as_of = dt.datetime(2001, 8, 2)
    customers = rfm.add_recency(base, as_of)
    edge = rfm.rfm_edges(customers).filter("measure = 'frequency'").first()
    assert tuple(map(float, (edge.p25, edge.p50, edge.p75))) == {"sf0.1": (1, 2, 2)}.get(sf, (1, 1, 2))
    assert flows.scored_customers(base, as_of).filter("f NOT BETWEEN 1 AND 4").count() == 0
    with pytest.raises(PySparkException, match="edges must rise"):
        flows.scored_customers(base, as_of, "error").collect()
