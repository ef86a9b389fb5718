"""Named queries over the order tables, one per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerlens.functions import dates, numbers
from ledgerlens.operators import clean, cohort, metrics, profile, ranking, report, rfm
from ledgerlens.plans import flows
from ledgerlens.session import materialise, scratch_path
from ledgerlens.sources import sales as io
from ledgerlens.sources.segments import default_segments, segment_rule
from ledgerlens.sources.star import sales_from_orders

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.datetime(2001, 8, 2)
TEXT_DATE = "dd/MM/yyyy HH:mm"

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query; its decimals leave as doubles."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report.decimals_to_doubles(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_orders(spark, sf_dir)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.prepared_sales(_raw(spark, sf_dir))


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.customer_months(_sales(spark, sf_dir))


def _counts(spark: SparkSession, sf_dir: str, scope: str = "all") -> DataFrame:
    return cohort.cohort_counts(_months(spark, sf_dir), scope)


def _rates(spark: SparkSession, sf_dir: str, scope: str = "all") -> DataFrame:
    return cohort.retention(_counts(spark, sf_dir, scope))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.add_recency(rfm.rfm_base(_sales(spark, sf_dir)), AS_OF)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.scored_customers(rfm.rfm_base(_sales(spark, sf_dir)), AS_OF)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.labelled_customers(rfm.rfm_base(_sales(spark, sf_dir)), AS_OF, default_segments(spark))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.segment_summary(_labelled(spark, sf_dir))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.monthly_sales(_sales(spark, sf_dir))


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.customer_kpis(metrics.customer_repeats(_sales(spark, sf_dir)))


# Sources and sinks


@query
def scan_sales(spark, sf_dir):
    path = scratch_path(spark, "sales-csv")
    text = _raw(spark, sf_dir).withColumn("invoice_ts", F.date_format("invoice_ts", TEXT_DATE))
    io.write_sales_csv(text, path)
    return io.read_sales(spark, path)


@query
def monthly_sales_from_csv(spark, sf_dir):
    """Text dates and amounts, from file to report; the file is a scratch one."""
    path = scratch_path(spark, "sales-csv")
    io.write_sales_csv(_raw(spark, sf_dir).withColumn("invoice_ts", F.date_format("invoice_ts", TEXT_DATE)), path)
    return metrics.monthly_sales(flows.prepared_sales(io.read_sales(spark, path), TEXT_DATE))


@query
def scan_segments(spark, sf_dir):
    scored = materialise(_scored(spark, sf_dir))
    path = scratch_path(spark, "segments-csv")
    per_code = scored.groupBy(F.col("rfm_code").alias("rfm"), "r", "f", "m").agg(F.count("*").alias("customers"))
    category = segment_rule(F.col("r"), F.col("f"), F.col("m")).alias("Categoria")
    per_code.select(F.col("rfm").cast("int").alias("rfm"), category).write.csv(path, header=True)
    return io.read_segments(spark, path).join(per_code.select("rfm", "customers"), "rfm")


@query
def sink_report(spark, sf_dir):
    path = scratch_path(spark, "monthly-sales")
    io.write_report(_monthly(spark, sf_dir), path)
    return io.read_report(spark, path)


@query
def sink_month_restated(spark, sf_dir):
    """A month is first stored without its home sales, then restated whole; the other folders stay."""
    path, sales = scratch_path(spark, "by-month"), materialise(_sales(spark, sf_dir))
    month = F.col("month") == F.lit("1995-07-01").cast("date")
    io.write_report(sales.filter(~month | ~F.col("is_home")), path, ["month"], "replace")
    io.write_report(sales.filter(month), path, ["month"], "replace")
    return io.read_report(spark, path)


# Profiles


@query
def profile_stored(spark, sf_dir):
    path = scratch_path(spark, "raw")
    io.write_report(_raw(spark, sf_dir), path)
    return profile.profile_stored(spark, path)


@query
def profile_columns(spark, sf_dir):
    return profile.profile_columns(_raw(spark, sf_dir))


@query
def profile_shape(spark, sf_dir):
    return profile.profile_shape(clean.clean_sales(_raw(spark, sf_dir)))


@query
def profile_missing(spark, sf_dir):
    return profile.profile_missing(_raw(spark, sf_dir))


@query
def audit_zero_amount(spark, sf_dir):
    return profile.audit_zero_amount(_sales(spark, sf_dir))


@query
def preview(spark, sf_dir):
    return profile.preview(_sales(spark, sf_dir), ["invoice_no", "customer_id"])


# Cleaning


@query
def drop_negative(spark, sf_dir):
    return clean.drop_negative(_raw(spark, sf_dir))


@query
def drop_duplicates(spark, sf_dir):
    return clean.drop_duplicates(_raw(spark, sf_dir))


@query
def drop_duplicates_by_digest(spark, sf_dir):
    return clean.drop_duplicates_by_digest(_raw(spark, sf_dir))


@query
def drop_missing(spark, sf_dir):
    return clean.drop_missing(_raw(spark, sf_dir))


@query
def parse_invoice_ts(spark, sf_dir):
    text = _raw(spark, sf_dir).withColumn("ts_txt", F.date_format("invoice_ts", TEXT_DATE))
    return text.select("invoice_no", "ts_txt", dates.parse_timestamp("ts_txt", TEXT_DATE).alias("parsed_ts"))


@query
def parse_decimal_comma(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "invoice_no", "amount_txt", numbers.parse_decimal_comma("amount_txt").alias("amount")
    )


@query
def clean_sales(spark, sf_dir):
    return clean.clean_sales(_raw(spark, sf_dir))


@query
def clean_audit(spark, sf_dir):
    return profile.clean_audit(_raw(spark, sf_dir))


@query
def clean_audit_observed(spark, sf_dir):
    """The same figures, counted by the job that writes the rows."""
    seen, left = Observation("seen"), Observation("left")
    rows = clean.observed_whole_rows(_raw(spark, sf_dir), seen, left)
    io.write_report(clean.type_columns(rows), scratch_path(spark, "clean"))
    return profile.observed_audit(spark, seen, left)


def _dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with text dates, of which some, like some amounts, cannot be read; by the invoice's number."""
    number = F.col("invoice_no").cast("long")
    return _raw(spark, sf_dir).withColumns(
        {
            "invoice_ts": F.when(number % 13 == 0, F.date_format("invoice_ts", "yyyy-MM-dd")).otherwise(
                F.date_format("invoice_ts", TEXT_DATE)
            ),
            "amount_txt": F.when(number % 17 == 0, F.concat(F.lit("1."), "amount_txt")).otherwise(F.col("amount_txt")),
        }
    )


@query
def quarantine_rejects(spark, sf_dir):
    return flows.routed_sales(clean.whole_rows(_dirty_text(spark, sf_dir)), TEXT_DATE)[1]


@query
def quarantine_accepted(spark, sf_dir):
    return flows.routed_sales(clean.whole_rows(_dirty_text(spark, sf_dir)), TEXT_DATE)[0]


# Expressions


@query
def month_floor(spark, sf_dir):
    return _sales(spark, sf_dir).select("invoice_no", "invoice_ts", "month")


@query
def date_parts(spark, sf_dir):
    year, month, day = dates.date_parts("invoice_ts")
    return _sales(spark, sf_dir).select(
        "invoice_no", year.alias("year"), month.alias("month_of_year"), day.alias("day")
    )


@query
def assign_cohort(spark, sf_dir):
    return cohort.assign_cohort(_sales(spark, sf_dir)).select("invoice_no", "customer_id", "month", "cohort_month")


@query
def cohort_index(spark, sf_dir):
    return cohort.assign_cohort(_sales(spark, sf_dir)).select("invoice_no", "cohort_month", "cohort_index")


@query
def home_flag(spark, sf_dir):
    return _sales(spark, sf_dir).select("invoice_no", "country", "is_home")


@query
def recency_days(spark, sf_dir):
    return _base(spark, sf_dir).select("customer_id", "last_ts", "recency")


@query
def rfm_code(spark, sf_dir):
    return _scored(spark, sf_dir).select("customer_id", "rfm_code")


@query
def cast_types(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "customer_id",
        F.col("frequency").cast("string").alias("frequency_txt"),
        F.col("rfm_code").cast("int").alias("code_number"),
        F.col("monetary").cast("double").alias("spend"),
    )


@query
def rename_columns(spark, sf_dir):
    panorama = metrics.country_panorama(_sales(spark, sf_dir))
    ordered = panorama.select(
        "country", "customers", "invoices", "min_amount", "max_amount", "mean_amount", "revenue", "items"
    )
    return report.rename_columns(ordered, report.COUNTRY_HEADINGS)


@query
def drop_column(spark, sf_dir):
    joined = rfm.join_segments(_scored(spark, sf_dir), default_segments(spark))
    return rfm.drop_key(joined).select("customer_id", "rfm_code", "category")


@query
def month_label(spark, sf_dir):
    return _counts(spark, sf_dir).select(
        dates.month_label("cohort_month").alias("cohort"), "cohort_index", "customers"
    )


@query
def round_rate(spark, sf_dir):
    return _rates(spark, sf_dir).select("cohort_month", "cohort_index", numbers.round_rate("rate").alias("rate_3"))


@query
def format_currency(spark, sf_dir):
    panorama = metrics.country_panorama(_sales(spark, sf_dir))
    money = ["min_amount", "max_amount", "mean_amount", "revenue"]
    return report.with_currency_text(panorama, money).select("country", *[f"{c}_text" for c in money])


@query
def format_percent(spark, sf_dir):
    return _rates(spark, sf_dir).select("cohort_month", "cohort_index", numbers.format_percent("rate").alias("label"))


@query
def bar_fraction(spark, sf_dir):
    panorama = metrics.country_panorama(_sales(spark, sf_dir))
    return report.bar_fraction(panorama, ["revenue", "customers"]).select("country", "revenue_bar", "customers_bar")


@query
def heat_intensity(spark, sf_dir):
    return _rates(spark, sf_dir).select(
        "cohort_month", "cohort_index", numbers.heat_intensity("rate").alias("intensity")
    )


# Joins


@query
def join_segments(spark, sf_dir):
    joined = rfm.join_segments(_scored(spark, sf_dir), default_segments(spark))
    return joined.select("customer_id", "rfm_code", "rfm", "category")


@query
def cohort_size_join(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return cohort.cohort_size_join(counts, cohort.cohort_sizes(counts))


# Aggregates


@query
def country_panorama(spark, sf_dir):
    return metrics.country_panorama(_sales(spark, sf_dir))


@query
def monthly_sales(spark, sf_dir):
    return _monthly(spark, sf_dir)


def _stored_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by country and month as bits: first all months but the last, which is then added."""
    path, sales = scratch_path(spark, "bitmaps"), materialise(_sales(spark, sf_dir).select("customer_id", "country", "month"))
    last = F.lit(sales.agg(F.max("month")).first()[0]).cast("date")
    flows.store_customer_bitmaps(sales.filter(F.col("month") < last), path)
    flows.store_customer_bitmaps(sales.filter(F.col("month") == last), path)
    return io.read_report(spark, path)


@query
def country_customers_merged(spark, sf_dir):
    return metrics.count_bitmaps(_stored_bitmaps(spark, sf_dir), ["country"])


@query
def monthly_customers_merged(spark, sf_dir):
    return metrics.count_bitmaps(_stored_bitmaps(spark, sf_dir), ["month"])


@query
def cohort_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query
def cohort_counts_home(spark, sf_dir):
    return _counts(spark, sf_dir, "home")


@query
def cohort_counts_away(spark, sf_dir):
    return _counts(spark, sf_dir, "away")


@query
def rfm_base(spark, sf_dir):
    return rfm.rfm_base(_sales(spark, sf_dir))


@query
def rfm_edges(spark, sf_dir):
    return rfm.rfm_edges(materialise(_base(spark, sf_dir)))


@query
def rfm_scores(spark, sf_dir):
    return _scored(spark, sf_dir).select("customer_id", "recency", "frequency", "monetary", "r", "f", "m")


@query
def segment_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def _stored_counts(spark: SparkSession, sf_dir: str, scope: str) -> tuple[DataFrame, range]:
    """The scope's counts and the pivot's columns, both from one stored aggregate."""
    counts = materialise(cohort.cohort_counts_by_scope(_months(spark, sf_dir)))
    indexes = range(1, cohort.counts_span(counts.filter("scope = 'all'")) + 1)
    return counts.filter(F.col("scope") == scope).drop("scope"), indexes


def _pivot(spark: SparkSession, sf_dir: str, scope: str) -> DataFrame:
    counts, indexes = _stored_counts(spark, sf_dir, scope)
    return cohort.cohort_pivot(counts, indexes=indexes)


def _wide(spark: SparkSession, sf_dir: str, scope: str, places: int | None = None) -> DataFrame:
    counts, indexes = _stored_counts(spark, sf_dir, scope)
    return report.retention_wide(cohort.retention(counts), indexes, places)


@query
def cohort_pivot(spark, sf_dir):
    return _pivot(spark, sf_dir, "all")


@query
def cohort_pivot_home(spark, sf_dir):
    return _pivot(spark, sf_dir, "home")


@query
def cohort_pivot_away(spark, sf_dir):
    return _pivot(spark, sf_dir, "away")


@query
def retention_wide(spark, sf_dir):
    return _wide(spark, sf_dir, "all")


@query
def retention_wide_home(spark, sf_dir):
    return _wide(spark, sf_dir, "home")


@query
def retention_wide_away(spark, sf_dir):
    return _wide(spark, sf_dir, "away")


@query
def retention_wide_rounded(spark, sf_dir):
    return _wide(spark, sf_dir, "all", 3)


@query
def retention_wide_rounded_home(spark, sf_dir):
    return _wide(spark, sf_dir, "home", 3)


@query
def retention_wide_rounded_away(spark, sf_dir):
    return _wide(spark, sf_dir, "away", 3)


# Retention and shares


@query
def retention(spark, sf_dir):
    return _rates(spark, sf_dir)


@query
def retention_home(spark, sf_dir):
    return _rates(spark, sf_dir, "home")


@query
def retention_away(spark, sf_dir):
    return _rates(spark, sf_dir, "away")


@query
def share_of_total(spark, sf_dir):
    return rfm.share_of_total(_summary(spark, sf_dir), "customers").select("category", "customers", "share")


# Sorts, limits, splits


@query
def peak_month(spark, sf_dir):
    return metrics.peak_month(_monthly(spark, sf_dir))


@query
def top_customers(spark, sf_dir):
    return metrics.top_customers(rfm.rfm_base(_sales(spark, sf_dir)))


def _side_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.monthly_sales(_sales(spark, sf_dir), ["is_home"])


@query
def monthly_sales_by_home(spark, sf_dir):
    return _side_monthly(spark, sf_dir)


@query
def peak_month_by_home(spark, sf_dir):
    return metrics.peak_month_by_home(materialise(_side_monthly(spark, sf_dir)))


@query
def top_customers_by_home(spark, sf_dir):
    return metrics.top_customers_by_home(materialise(rfm.customer_sides(_sales(spark, sf_dir))))


@query
def split_home(spark, sf_dir):
    return clean.split_home(_sales(spark, sf_dir))


@query
def split_away(spark, sf_dir):
    return clean.split_away(_sales(spark, sf_dir))


# Business questions


@query
def avg_month_revenue(spark, sf_dir):
    return metrics.avg_month_revenue(metrics.revenue_by_month(_sales(spark, sf_dir)))


@query
def avg_customer_spend(spark, sf_dir):
    return _kpis(spark, sf_dir).select("customers", "revenue", "avg_customer_spend")


@query
def repeat_rate(spark, sf_dir):
    return _kpis(spark, sf_dir).select("customers", "repeat_customers", "repeat_rate")


@query
def kpis_by_home(spark, sf_dir):
    sales = _sales(spark, sf_dir)
    return metrics.kpis_by_home(
        metrics.side_repeats(metrics.customer_repeats(sales)), metrics.revenue_by_month(sales, ["is_home"])
    )


@query
def pareto_curve(spark, sf_dir):
    return ranking.pareto_curve(rfm.rfm_base(_sales(spark, sf_dir)))


@query
def pareto_customers(spark, sf_dir):
    return ranking.pareto_customers(ranking.pareto_curve(rfm.rfm_base(_sales(spark, sf_dir))))


@query
def segment_cum_share(spark, sf_dir):
    return rfm.segment_cum_share(_summary(spark, sf_dir))


@query
def retention_drop(spark, sf_dir):
    return cohort.retention_drop(_rates(spark, sf_dir)).select("cohort_month", "cohort_index", "rate", "change")


@query
def weakest_cohort(spark, sf_dir):
    return cohort.weakest_cohort(_rates(spark, sf_dir))


@query
def segments_by_home(spark, sf_dir):
    return flows.segment_mix(_sales(spark, sf_dir), AS_OF, default_segments(spark))


@query
def new_vs_returning(spark, sf_dir):
    return cohort.new_vs_returning(_months(spark, sf_dir), _monthly(spark, sf_dir))


@query
def partial_period_flag(spark, sf_dir):
    return metrics.partial_periods(_sales(spark, sf_dir))


# Chart inputs


@query
def series_monthly(spark, sf_dir):
    return report.series_monthly(_monthly(spark, sf_dir))


@query
def series_items(spark, sf_dir):
    return report.series_items(_monthly(spark, sf_dir))


@query
def heatmap_cells(spark, sf_dir):
    return report.heatmap_cells(_months(spark, sf_dir))


@query
def month_table(spark, sf_dir):
    return report.month_table(_monthly(spark, sf_dir))


@query
def segment_table(spark, sf_dir):
    return report.segment_table(_summary(spark, sf_dir))


@query
def treemap_cells(spark, sf_dir):
    return report.treemap_cells(_summary(spark, sf_dir))
