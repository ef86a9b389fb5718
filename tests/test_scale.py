"""What the plans must look like for large and skewed tables."""

import contextlib
import datetime as dt
import re
from pathlib import Path

import pytest
from compare import TESTDATA, connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.oracle import ORACLE
from ledgerlens import session
from ledgerlens.operators import clean, cohort, metrics, profile, ranking, rfm
from ledgerlens.plans import flows
from ledgerlens.sources import layout
from ledgerlens.sources.segments import default_segments
from ledgerlens.sources.star import sales_from_orders

SF = str(TESTDATA / "sf0.01")


@contextlib.contextmanager
def conf(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df, run=True):
    """The executed plan; of the adaptive ones, what was run in the end."""
    execution = df._jdf.queryExecution()
    if run:
        df.collect()
    return execution.executedPlan().toString().split("+- == Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Prepared sales as a table, with a third of the rows on one customer."""
    path = str(tmp_path_factory.mktemp("sales") / "skewed")
    sales = flows.prepared_sales(sales_from_orders(spark, SF))
    hot = F.col("invoice_no").cast("long") % 3 == 0
    sales.withColumn("customer_id", F.when(hot, 1).otherwise(F.col("customer_id"))).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SF), run=False)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in text


def test_sources_are_pruned_and_filters_reach_the_scan(spark, stored):
    text = plan(metrics.monthly_sales(stored), run=False)
    sums, distincts = (re.findall(r"(\w+):", s) for s in re.findall(r"ReadSchema: struct<(.*?)>", text))
    assert sorted(sums) == ["amount", "month", "quantity"]
    assert sorted(distincts) == ["customer_id", "invoice_no", "month"]
    assert text.count("PushedFilters: [IsNotNull(month)]") == 2
    text = plan(clean.split_home(stored).select("invoice_no"), run=False)
    assert "EqualTo(is_home,true)" in text or "IsNotNull(is_home), is_home" in text


def test_missing_values_are_filtered_at_the_scan_and_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "raw")
    sales_from_orders(spark, SF).write.parquet(path)
    with conf(spark, spark__sql__maxMetadataStringLength="1000"):
        text = plan(clean.clean_sales(spark.read.parquet(path)), run=False)
    for column in ("invoice_no", "customer_id", "invoice_ts", "country", "quantity", "amount_txt"):
        assert f"IsNotNull({column})" in text
    assert "GreaterThanOrEqual(quantity,0)" in text
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("Filter")


def test_copies_are_collapsed_before_the_shuffle(spark):
    copies = spark.range(30000).select(F.lit("a").alias("x"), F.lit(None).cast("long").alias("y"))
    distinct = clean.drop_duplicates(copies.repartition(8))
    text = plan(distinct)
    assert text.count("HashAggregate") == 2 and distinct.count() == 1


def test_cohorts_need_no_deduplication_and_one_shuffle_by_customer(spark, tmp_path):
    path = str(tmp_path / "raw")
    sales_from_orders(spark, SF).write.parquet(path)
    sales = flows.prepared_sales(spark.read.parquet(path))
    text = plan(cohort.cohort_counts(cohort.customer_months(sales)), run=False)
    for node in ("Exchange hashpartitioning(quantity", "ObjectHashAggregate", "SortAggregate", "Window", "Sort "):
        assert node not in text
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len(keys) == 2 and re.fullmatch(r"customer_id#\d+L?, \d+", keys[1]) and "cohort_month" in keys[0]


@pytest.mark.parametrize("name", ["kpis_by_home", "repeat_rate", "avg_customer_spend"])
def test_repeat_customers_are_found_without_sorting(spark, name):
    text = plan(QUERIES[name](spark, SF), run=False)
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_segments_have_no_copy_of_the_percentiles(spark):
    text = plan(QUERIES["segment_summary"](spark, SF), run=False)
    assert "Subquery" not in text and len(text) < 20_000


def test_analysis_reads_the_clean_table_four_times(spark, tmp_path, monkeypatch):
    plans = []

    def noted(write):
        return lambda df, path, *args, **more: (plans.append(plan(df, run=False)), write(df, path, *args, **more))[1]

    for name in ("write_report", "write_by_customer"):
        monkeypatch.setattr(flows, name, noted(getattr(flows, name)))
    raw = sales_from_orders(spark, str(TESTDATA / "sf0.001"))
    out = str(tmp_path / "out")
    with conf(spark, spark__sql__maxMetadataStringLength="1000"):
        flows.write_analysis(spark, raw, default_segments(spark), out, dt.datetime(2001, 8, 2))
    assert sum(text.count("/out/sales]") for text in plans) == 4
    assert "PartitionFilters: [isnotnull(month" in plan(
        spark.read.parquet(f"{out}/sales").filter("month = DATE'1995-07-01'"), run=False
    )


def test_hot_customer_is_split(spark, stored):
    wanted = sorted(map(tuple, cohort.assign_cohort(stored).collect()))
    with conf(spark, **SMALL_PARTITIONS):
        df = cohort.assign_cohort(stored.repartition(16))
        text = plan(df)
        assert "SortMergeJoin(skew=true)" in text
        assert sorted(map(tuple, df.select(*cohort.assign_cohort(stored).columns).collect())) == wanted


SMALL_PARTITIONS = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
    spark__sql__adaptive__coalescePartitions__enabled="false",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The order tables with a third of the orders on one customer, and a third
    of the orders of one price."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("lineitem", "customer", "nation"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(folder / f"{name}.parquet"))
    key = F.col("o_orderkey")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.withColumns(
        {
            "o_custkey": F.when(key % 3 == 0, 4).otherwise(F.col("o_custkey")),
            "o_totalprice": F.when(key % 3 == 1, 100.0).otherwise(F.col("o_totalprice")),
        }
    ).write.parquet(str(folder / "orders.parquet"))
    con = connect(folder)
    yield str(folder), con
    con.close()


@pytest.mark.parametrize(
    "name",
    [
        "clean_sales",
        "clean_audit",
        "country_panorama",
        "monthly_sales",
        "cohort_index",
        "heatmap_cells",
        "kpis_by_home",
        "pareto_customers",
        "pareto_curve",
        "rfm_edges",
        "segments_by_home",
    ],
)
def test_results_are_whole_under_skew(spark, skewed, name):
    """With many small partitions, no broadcast and split hot keys."""
    folder, con = skewed
    with conf(spark, **SMALL_PARTITIONS):
        types, rows = spark_rows(QUERIES[name](spark, folder))
    wanted_types, wanted = duck_rows(con, ORACLE[name])
    assert (types, rows) == (wanted_types, wanted)


def test_hot_customer_of_the_orders_is_split(spark, skewed):
    with conf(spark, **SMALL_PARTITIONS):
        assert "SortMergeJoin(skew=true)" in plan(sales_from_orders(spark, skewed[0]))


def test_first_months_are_broadcast_only_when_small(spark, stored):
    assert "BroadcastHashJoin" in plan(cohort.assign_cohort(stored))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="100"):
        assert "BroadcastHashJoin" not in plan(cohort.assign_cohort(stored))


def test_lookup_broadcast_is_bounded(spark, stored):
    """A lookup with many rows that cannot match is cut before the broadcast."""
    big = default_segments(spark).union(
        spark.range(20000).select((F.col("id") + 1000).cast("string").alias("rfm"), F.lit("x").alias("category"))
    )
    assert rfm.unique_lookup(big).count() == 64


def test_distinct_counts_are_rekeyed(spark, stored):
    """The first shuffle of a distinct count is not on the country alone."""
    text = plan(metrics.country_panorama(stored), run=False)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert any("customer_id" in k and "invoice_no" in k for k in keys)


def test_duplicates_are_shuffled_once_for_two_branches(spark):
    text = plan(QUERIES["kpis_by_home"](spark, SF))
    assert len(re.findall(r"[^d]Exchange hashpartitioning\(quantity", text.split("ReusedExchange")[0])) == 1
    assert "ReusedExchange" in text


def test_shuffles_fit_the_input(spark):
    assert session.partitions_for(0) == 1
    assert session.partitions_for(100 << 40) == 819_200
    assert session.partitions_for(1 << 30, task_bytes=1 << 20) == 1024
    with conf(spark, spark__sql__shuffle__partitions="8"):
        with session.shuffle_partitions(spark, 50):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        with session.shuffle_partitions(spark, 3):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_tables_by_customer_are_not_shuffled_by_customer_again(spark, stored, tmp_path):
    path = str(tmp_path / "grain")
    with layout.forgotten(spark):
        grain = layout.write_by_customer(rfm.customer_grain(stored), path, 8)
        again = layout.read_by_customer(spark, path, 8)
        assert sorted(map(str, grain.collect())) == sorted(map(str, again.collect()))
        sides = rfm.merge_grain(grain, ["customer_id", "is_home"])
        with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
            for table in (grain, again):
                flows_of = {
                    "cohorts": cohort.customer_months(table),
                    "rfm": rfm.merge_grain(table, ["customer_id"]),
                    "sides": rfm.merge_grain(table, ["customer_id", "is_home"]),
                    "cohort of each row": cohort.assign_cohort(table, by_customer=True),
                }
                for name, df in flows_of.items():
                    assert "Exchange" not in plan(df, run=False), name
        assert sorted(map(tuple, cohort.customer_months(grain).collect())) == sorted(map(tuple, cohort.customer_months(stored).collect()))
        with pytest.raises(Exception, match="(?i)exist|empty"):
            layout.write_by_customer(sides, path, 8)
        n = sides.count()
        layout.write_by_customer(sides, str(tmp_path / "sides"), 8)
        assert spark.read.parquet(str(tmp_path / "sides")).count() == n
    assert not any(t.name.startswith("by_customer_") for t in spark.catalog.listTables())


def test_only_digests_and_copies_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "raw")
    sales_from_orders(spark, SF).write.parquet(path)
    df = clean.drop_duplicates_by_digest(spark.read.parquet(path))
    text = plan(df, run=False)
    assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 0
    assert text.count("Exchange hashpartitioning") == 1 and "LeftSemi" in text.split("Exchange hashpartitioning")[1]
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="1"):
        assert "BroadcastHashJoin" not in plan(clean.drop_duplicates_by_digest(spark.read.parquet(path)), run=False)


def test_footer_counts_open_no_data_page(spark, tmp_path):
    path = str(tmp_path / "raw")
    sales_from_orders(spark, SF).write.parquet(path)
    with profile.footer_counts(spark):
        text = plan(profile.footer_aggregate(spark.read.parquet(path)), run=False)
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), COUNT\(invoice_no\)", text)


def test_audit_of_the_written_rows_costs_no_scan(spark, tmp_path, monkeypatch):
    counted = []
    observed = profile.observed_audit
    monkeypatch.setattr(flows.profile, "observed_audit", lambda *args: counted.append(observed(*args)) or counted[-1])
    raw = sales_from_orders(spark, str(TESTDATA / "sf0.001"))
    flows.write_analysis(spark, raw, default_segments(spark), str(tmp_path / "out"), dt.datetime(2001, 8, 2))
    (audit,) = counted
    assert "Scan parquet" not in plan(audit, run=False)
    assert sorted(audit.collect()) == sorted(profile.clean_audit(raw).collect())
    assert spark.read.parquet(f"{tmp_path}/out/clean_audit").count() == 4


def test_percentiles_sort_and_store_nothing(spark, monkeypatch):
    monkeypatch.setattr(ranking, "materialise", None)
    plans = []
    digits = ranking._digits
    monkeypatch.setattr(ranking, "_digits", lambda df, *args: plans.append(plan(df, run=False)) or digits(df, *args))
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("x"), (F.col("id") % 7).alias("y"))
    got = {r.measure: (float(r.p25), float(r.p50), float(r.max)) for r in ranking.exact_percentiles(df, ["x", "y"], [25, 50]).collect()}
    row = df.selectExpr("percentile(x, array(0.25, 0.5)) AS x", "percentile(y, array(0.25, 0.5)) AS y", "max(x) AS mx", "max(y) AS my").first()
    assert got == {"x": (*row.x, row.mx), "y": (*row.y, row.my)}
    assert len(plans) == 2 and not any("Exchange" in p or "Sort" in p for p in plans)


def test_library_avoids_local_state():
    package = Path(__file__).parent.parent / "ledgerlens"
    files = [p for p in package.rglob("*.py") if "llm" not in p.relative_to(package).parts]
    source = "\n".join(p.read_text(encoding="utf-8") for p in files)
    for word in ("localCheckpoint", ".toPandas(", "crossJoin", ".collect()", ".cache()", ".persist(", "udf(", "toLocalIterator", "_jdf"):
        assert word not in source
