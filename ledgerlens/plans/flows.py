"""The operators chained as the analysis needs them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgerlens.operators import clean, cohort, metrics, profile, ranking, report, rfm
from ledgerlens.schema import AMOUNT_SCALE, HOME_COUNTRY
from ledgerlens.session import materialise, scratch_path
from ledgerlens.sources.layout import forgotten, write_by_customer
from ledgerlens.sources.sales import read_report, write_report


def prepared_sales(
    raw: DataFrame,
    ts_format: str | None = None,
    home: str = HOME_COUNTRY,
    on_error: str = "fail",
    scale: int = AMOUNT_SCALE,
) -> DataFrame:
    """Clean rows with month and home flag."""
    return raw.transform(clean.clean_sales, ts_format, on_error, scale).transform(clean.add_features, home)


def routed_sales(
    rows: DataFrame, ts_format: str | None = None, home: str = HOME_COUNTRY, scale: int = AMOUNT_SCALE
) -> tuple[DataFrame, DataFrame]:
    """Prepared rows of ``clean.whole_rows``, and the rows that cannot be read with the reason.

    The source is read once: its rows are stored by reason, a folder each, and
    both sides read theirs.
    """
    spark = rows.sparkSession
    routes = clean.routed(rows, ts_format, scale)
    path = scratch_path(spark, "routed")
    routes.write.partitionBy("reason").parquet(path)
    stored = spark.read.schema(routes.schema).parquet(path)
    return clean.add_features(clean.accepted(stored, ts_format, scale), home), clean.rejected(stored)


def store_customer_bitmaps(sales: DataFrame, path: str) -> None:
    """The customers of each country and month as bits, a folder per month.

    Months that ``sales`` has are stored anew, others stay: a new month is added,
    or an old one restated, without a look at the rest.
    """
    write_report(metrics.customer_bitmaps(sales, ["country", "month"]), path, ["month"], "replace")


def scored_customers(base: DataFrame, as_of: dt.datetime, on_bad_edges: str = "collapse") -> DataFrame:
    """Customers of ``rfm_base`` with recency, scores and RFM code.

    They are stored first: edges and scores both read them, and they are few
    next to the invoices.
    """
    customers = materialise(rfm.add_recency(base, as_of))
    scored = rfm.rfm_scores(customers, rfm.rfm_edges(customers), on_bad_edges)
    return scored.withColumn("rfm_code", rfm.rfm_code())


def labelled_customers(
    base: DataFrame, as_of: dt.datetime, lookup: DataFrame, on_bad_edges: str = "collapse"
) -> DataFrame:
    """Scored customers with their segment."""
    return rfm.drop_key(rfm.join_segments(scored_customers(base, as_of, on_bad_edges), lookup))


def segment_mix(sales: DataFrame, as_of: dt.datetime, lookup: DataFrame) -> DataFrame:
    """Segments at home and away, from a single pass over the invoices."""
    sides = materialise(rfm.customer_sides(sales))
    base = rfm.merge_grain(sides, ["customer_id"])
    return rfm.segments_by_home(labelled_customers(base, as_of, lookup), sides)


def write_analysis(
    spark: SparkSession,
    raw: DataFrame,
    lookup: DataFrame,
    out: str,
    as_of: dt.datetime,
    ts_format: str | None = None,
    home: str = HOME_COUNTRY,
    on_bad_edges: str = "collapse",
    scale: int = AMOUNT_SCALE,
    mode: str = "error",
    quarantine: bool = False,
) -> list[str]:
    """Run the whole analysis and write each result table under ``out``.

    The clean rows are written once, by month, so that a later read of one month
    opens that folder only. Four passes over them make the grain of customers,
    countries and months, the customers' distinct invoices, and the distinct
    invoices by country and by month; all other tables read those. The tables of
    customers are laid out by customer, so cohorts, RFM and their joins shuffle
    nothing by customer again. The audit of the cleaning is counted by the job
    that writes the rows. With ``quarantine``, rows whose date or amount cannot
    be read are written to ``rejects`` with the reason, rather than fail the run.
    """
    written = []
    seen, left = Observation("seen"), Observation("left")
    whole = clean.observed_whole_rows(raw, seen, left)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def store_by_customer(name: str, df: DataFrame) -> DataFrame:
        written.append(name)
        return write_by_customer(df, f"{out}/{name}", buckets, mode)

    def store(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        write_report(df, f"{out}/{name}", partition_by, mode=mode)
        written.append(name)
        return read_report(spark, f"{out}/{name}")

    with forgotten(spark):
        if quarantine:
            typed, rejects = routed_sales(whole, ts_format, home, scale)
            store("rejects", rejects)
        else:
            typed = clean.add_features(clean.type_columns(whole, ts_format, scale=scale), home)
        sales = store("sales", typed, ["month"])
        store("clean_audit", profile.observed_audit(spark, seen, left))
        grain = store_by_customer("customer_grain", rfm.customer_grain(sales))
        repeats = store("customer_repeats", metrics.customer_repeats(sales))
        months = store("customer_months", cohort.customer_months(grain))
        sides = store_by_customer("customer_sides", rfm.merge_grain(grain, ["customer_id", "is_home"]))
        base = rfm.merge_grain(sides, ["customer_id"])
        labelled = store_by_customer("customers", labelled_customers(base, as_of, lookup, on_bad_edges))
        monthly = store("monthly_sales", metrics.monthly_of_grain(grain, metrics.invoices_by(sales, "month")))
        summary = store("segment_summary", rfm.segment_summary(labelled))
        side_months = grain.withColumnRenamed("monetary", "amount")
        tables = {
            "country_panorama": metrics.panorama_of_grain(grain, metrics.invoices_by(sales, "country")),
            "partial_periods": metrics.partial_periods(grain),
            "kpis": metrics.customer_kpis(repeats),
            "kpis_by_home": metrics.kpis_by_home(
                metrics.side_repeats(repeats), metrics.revenue_by_month(side_months, ["is_home"])
            ),
            "avg_month_revenue": metrics.avg_month_revenue(monthly),
            "top_customers_by_home": metrics.top_customers_by_home(sides),
            "new_vs_returning": cohort.new_vs_returning(months, monthly),
            "heatmap_cells": report.heatmap_cells(months),
            "segments_by_home": rfm.segments_by_home(labelled, sides),
            "segment_cum_share": rfm.segment_cum_share(summary),
            "treemap_cells": report.treemap_cells(summary),
            "pareto_customers": ranking.pareto_customers(ranking.pareto_curve(labelled)),
            "month_table": report.month_table(monthly),
            "segment_table": report.segment_table(summary),
        }
        span = range(1, cohort.calendar_span(months) + 1)
        for scope in cohort.SCOPES:
            rates = cohort.retention(cohort.cohort_counts(months, scope))
            tables[f"retention_{scope}"] = rates
            tables[f"retention_wide_{scope}"] = report.retention_wide(rates, span)
        for name, table in tables.items():
            store(name, report.decimals_to_doubles(table))
    return written
