"""Sales by country, month and customer. Input: clean rows with features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Double division of exact counts or sums; null when the whole is 0."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(part.cast("double"), whole.cast("double"))


def invoices_by(sales: DataFrame, key: str) -> DataFrame:
    """Distinct invoices per ``key``."""
    return sales.filter(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct("invoice_no").alias("invoices"))


def sums_and_distincts(
    sales: DataFrame, keys: list[str], sums: list[Column], distincts: list[Column]
) -> DataFrame:
    """Plain and distinct aggregates by ``keys``, joined on them.

    In one aggregate Spark would repeat every row for each distinct count and
    carry the sums along. Apart, the sums combine map-side to a row per key,
    the distinct values travel alone, re-keyed on (keys, value) so that a key
    with most rows is spread out, and they skip any removal of duplicate rows
    before them. The join sees one row per key.
    """
    for key in keys:
        sales = sales.filter(F.col(key).isNotNull())
    return sales.groupBy(*keys).agg(*sums).join(sales.groupBy(*keys).agg(*distincts), keys)


def country_panorama(sales: DataFrame) -> DataFrame:
    """Per country: customers, invoices, amount range, mean and sum, items."""
    sums = [
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.sum("amount").alias("revenue"),
        F.count("amount").alias("amounts"),
        F.sum("quantity").alias("items"),
    ]
    distincts = [
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("invoice_no").alias("invoices"),
    ]
    return (
        sums_and_distincts(sales, ["country"], sums, distincts)
        .withColumn("mean_amount", ratio("revenue", "amounts"))
        .drop("amounts")
        .orderBy(F.desc("revenue"), "country")
    )


def panorama_of_grain(grain: DataFrame, invoices: DataFrame) -> DataFrame:
    """``country_panorama`` from ``customer_grain`` and the invoices by country."""
    sums = [
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
        F.sum("monetary").alias("revenue"),
        F.sum("amounts").alias("amounts"),
        F.sum("items").alias("items"),
    ]
    return (
        sums_and_distincts(grain, ["country"], sums, [F.countDistinct("customer_id").alias("customers")])
        .join(invoices, "country")
        .withColumn("mean_amount", ratio("revenue", "amounts"))
        .drop("amounts")
        .orderBy(F.desc("revenue"), "country")
    )


def monthly_of_grain(grain: DataFrame, invoices: DataFrame) -> DataFrame:
    """``monthly_sales`` from ``customer_grain`` and the invoices by month."""
    sums = [F.sum("items").alias("items"), F.sum("monetary").alias("revenue")]
    customers = [F.countDistinct("customer_id").alias("customers")]
    return sums_and_distincts(grain, ["month"], sums, customers).join(invoices, "month").orderBy("month")


def customer_bitmaps(sales: DataFrame, by: list[str]) -> DataFrame:
    """The customers of each group as bits: a row per group and run of 32,768 customer ids.

    Exact, and mergeable: the bitmaps of two parts of the sales, stored at
    different times, give the distinct customers of both (`merge_bitmaps`). A
    row is 4 KB, so ids should be numbered closely, as a sequence gives them.
    The rows of a group are combined map-side to at most a row per run of ids.
    """
    return (
        sales.filter(F.col("customer_id").isNotNull())
        .groupBy(*by, F.bitmap_bucket_number("customer_id").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("bits"))
    )


def merge_bitmaps(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of the union of some tables of bitmaps."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Distinct customers per group, from its bitmaps of any number of parts."""
    merged = merge_bitmaps(bitmaps, by)
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("customers"))


def monthly_sales(sales: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per month (and ``by``): invoices, customers, items, revenue."""
    keys = [*(by or []), "month"]
    sums = [F.sum("quantity").alias("items"), F.sum("amount").alias("revenue")]
    distincts = [
        F.countDistinct("invoice_no").alias("invoices"),
        F.countDistinct("customer_id").alias("customers"),
    ]
    return sums_and_distincts(sales, keys, sums, distincts).orderBy(*keys)


def peak_month(monthly: DataFrame) -> DataFrame:
    """The month with most invoices; the earliest one on a tie."""
    return monthly.orderBy(F.desc("invoices"), "month").limit(1)


def peak_month_by_home(side_monthly: DataFrame) -> DataFrame:
    """The peak month of each side."""
    return _by_side(side_monthly, peak_month)


def _by_side(df: DataFrame, report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``report`` of the home and of the away rows, each by its own top-k."""
    return report(df.filter("is_home")).unionByName(report(df.filter(~F.col("is_home"))))


def partial_periods(sales: DataFrame) -> DataFrame:
    """Per month: last sale, and whether the data end before the month does.

    Also reads ``customer_grain``.
    """
    ts = "invoice_ts" if "invoice_ts" in sales.columns else "last_ts"
    last = _dated(sales.groupBy("month").agg(F.max(ts).alias("last_ts"), F.count("month").alias("months_known")))
    # One row per calendar month: a single partition holds them.
    data_end = F.max("last_ts").over(W.partitionBy())
    cut = (F.col("last_ts") == data_end) & (F.to_date("last_ts") < F.last_day("month"))
    return last.withColumn("is_partial", cut)


def _dated(by_month: DataFrame) -> DataFrame:
    """Without the row of no month: a date that could not be read is in none.

    Told by a count beside the sums; a test of the month itself would be pushed
    below the removal of duplicates, which then no two queries could share.
    """
    return by_month.filter(F.col("months_known") > 0).drop("months_known")


def revenue_by_month(sales: DataFrame, by: list[str] | None = None) -> DataFrame:
    return _dated(sales.groupBy(*(by or []), "month").agg(F.sum("amount").alias("revenue"), F.count("month").alias("months_known")))


def avg_month_revenue(monthly: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Average revenue of the months that have sales; one input row per month."""
    return (
        monthly.groupBy(*(by or []))
        .agg(F.sum("revenue").alias("revenue"), F.count("*").alias("months"))
        .withColumn("avg_month_revenue", ratio("revenue", "months"))
    )


def customer_repeats(sales: DataFrame) -> DataFrame:
    """Per customer: spend and distinct invoices, in all, at home and away.

    Rows are first combined per customer and invoice, in hash aggregates of
    which the first is spread over a customer's invoices, so one with very many
    is no hot task; invoice numbers are text, whose minimum or distinct set
    would sort all rows.
    """
    spend = F.sum("amount")
    home = F.col("is_home")
    per_invoice = (
        sales.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "invoice_no")
        .agg(
            spend.alias("spend"),
            F.sum(F.when(home, F.col("amount"))).alias("home_spend"),
            F.sum(F.when(~home, F.col("amount"))).alias("away_spend"),
            F.count_if(home).alias("home_rows"),
            F.count_if(~home).alias("away_rows"),
        )
    )
    numbered = F.col("invoice_no").isNotNull()
    return per_invoice.groupBy("customer_id").agg(
        F.sum("spend").alias("spend"),
        F.count_if(numbered).alias("invoices"),
        F.sum("home_spend").alias("home_spend"),
        F.count_if(numbered & (F.col("home_rows") > 0)).alias("home_invoices"),
        F.sum("home_rows").alias("home_rows"),
        F.sum("away_spend").alias("away_spend"),
        F.count_if(numbered & (F.col("away_rows") > 0)).alias("away_invoices"),
        F.sum("away_rows").alias("away_rows"),
    )


def side_repeats(repeats: DataFrame) -> DataFrame:
    """``customer_repeats`` with a row per customer and side that has sales."""
    sides = [
        F.struct(
            F.lit(side == "home").alias("is_home"),
            F.col(f"{side}_spend").alias("spend"),
            F.col(f"{side}_invoices").alias("invoices"),
            F.col(f"{side}_rows").alias("rows"),
        )
        for side in ("home", "away")
    ]
    return repeats.select("customer_id", F.inline(F.array(*sides))).filter(F.col("rows") > 0).drop("rows")


def customer_kpis(repeats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Customers, average spend per customer, share who bought more than once,
    from ``customer_repeats`` or ``side_repeats``."""
    return (
        repeats.groupBy(*(by or []))
        .agg(
            F.count("*").alias("customers"),
            F.sum("spend").alias("revenue"),
            F.count_if(F.col("invoices") > 1).alias("repeat_customers"),
        )
        .withColumn("avg_customer_spend", ratio("revenue", "customers"))
        .withColumn("repeat_rate", ratio("repeat_customers", "customers"))
    )


def kpis_by_home(side_repeats: DataFrame, side_months: DataFrame) -> DataFrame:
    """Monthly, per-customer and repeat figures for home and away sales."""
    months = avg_month_revenue(side_months, ["is_home"]).select("is_home", "months", "avg_month_revenue")
    return customer_kpis(side_repeats, ["is_home"]).join(months, "is_home")


def top_customers(base: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with the highest spend."""
    return base.orderBy(F.desc("monetary"), "customer_id").limit(n)


def top_customers_by_home(sides: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers of each side with the highest spend there."""
    return _by_side(sides, lambda side: top_customers(side, n))
