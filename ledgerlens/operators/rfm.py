"""Recency, frequency and spend per customer: quartile scores, segments."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ledgerlens.functions.dates import elapsed_days
from ledgerlens.operators.metrics import ratio
from ledgerlens.operators.ranking import exact_percentiles

# Measure, and the score it gets. The quartile percents and the
# open lower end of the lowest bin.
MEASURES = {"recency": "r", "frequency": "f", "monetary": "m"}
QUARTILES = (25, 50, 75)
LOWEST_EDGE = -1


def rfm_base(sales: DataFrame) -> DataFrame:
    """Per customer: last and first purchase, invoice rows, spend."""
    return _purchases(sales, ["customer_id"])


def customer_grain(sales: DataFrame) -> DataFrame:
    """Per customer, country and month: what all tables of customers and months are made of.

    One pass over the invoices and one shuffle, of hash aggregates whose keys
    spread a customer's and a country's rows.
    """
    return sales.groupBy("customer_id", "country", "is_home", "month").agg(
        F.max("invoice_ts").alias("last_ts"),
        F.min("invoice_ts").alias("first_ts"),
        F.count("invoice_no").alias("frequency"),
        F.sum("amount").alias("monetary"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.count("amount").alias("amounts"),
        F.sum("quantity").alias("items"),
    )


def customer_sides(sales: DataFrame) -> DataFrame:
    """``rfm_base`` apart for home and away: two rows per customer at most."""
    return _purchases(sales, ["customer_id", "is_home"])


def merge_grain(grain: DataFrame, by: list[str]) -> DataFrame:
    """``rfm_base`` or ``customer_sides`` from ``customer_grain``, or the former from the latter."""
    return (
        grain.filter(F.col("customer_id").isNotNull())
        .groupBy(*by)
        .agg(
            F.max("last_ts").alias("last_ts"),
            F.min("first_ts").alias("first_ts"),
            F.sum("frequency").alias("frequency"),
            F.sum("monetary").cast(grain.schema["monetary"].dataType).alias("monetary"),
        )
    )


def _purchases(sales: DataFrame, by: list[str]) -> DataFrame:
    return (
        sales.filter(F.col("customer_id").isNotNull())
        .groupBy(*by)
        .agg(
            F.max("invoice_ts").alias("last_ts"),
            F.min("invoice_ts").alias("first_ts"),
            F.count("invoice_no").alias("frequency"),
            F.sum("amount").alias("monetary"),
        )
    )


def add_recency(base: DataFrame, as_of: dt.datetime) -> DataFrame:
    return base.withColumn("recency", elapsed_days(as_of, "last_ts"))


def rfm_edges(rfm: DataFrame) -> DataFrame:
    """Per measure: quartiles and maximum. Reads ``rfm`` once more than scoring
    does, so pass it materialised."""
    return exact_percentiles(rfm, list(MEASURES), QUARTILES)


def rfm_scores(rfm: DataFrame, edges: DataFrame, on_bad_edges: str = "collapse") -> DataFrame:
    """Add scores r, f, m: right-closed quartile bins, numbered 1 to 4.

    ``on_bad_edges="error"`` fails the query where strict bins would: edges
    that do not rise, or a value at or below the open lower end. ``"collapse"``
    puts a value on repeated edges, or below them all, in the lowest bin.
    """
    if on_bad_edges not in ("collapse", "error"):
        raise ValueError("on_bad_edges must be 'collapse' or 'error'")
    fields = [f"p{p}" for p in QUARTILES] + ["max"]
    row = F.struct(*fields)
    # Twelve numbers come to the driver. As literals they cost the plan nothing;
    # a scalar query would be copied to each of its uses.
    found = edges.agg(*[F.max(F.when(F.col("measure") == m, row)).alias(m) for m in MEASURES]).first()
    strict = on_bad_edges == "error"
    scores = {}
    for measure, score in MEASURES.items():
        own = [None if found[measure] is None else found[measure][f] for f in fields]
        scores[score] = _score(F.col(measure), [_literal(x, edges.schema[f]) for x, f in zip(own, fields)], strict)
    return rfm.withColumns(scores)


def _literal(value: Decimal | None, field: T.StructField) -> Column:
    return F.lit(None if value is None else str(value)).cast(field.dataType)


def _score(x: Column, edges: list[Column], strict: bool) -> Column:
    score = F.when(x <= edges[0], 1).when(x <= edges[1], 2).when(x <= edges[2], 3).otherwise(4)
    if not strict:
        return score
    rising = F.lit(LOWEST_EDGE) < edges[0]
    for lower, upper in zip(edges, edges[1:]):
        rising = rising & (lower < upper)
    return (
        F.when(~rising, F.raise_error(F.lit("bin edges must rise")).cast("int"))
        .when(x <= LOWEST_EDGE, F.raise_error(F.lit("value below the lowest bin")).cast("int"))
        .otherwise(score)
    )


def rfm_code() -> Column:
    """The three scores as text, e.g. ``"144"``."""
    return F.concat(*[F.col(s).cast("string") for s in MEASURES.values()])


def unique_lookup(lookup: DataFrame) -> DataFrame:
    """The codes that can match, checked to be unique: 64 rows at most."""
    duplicate = F.raise_error(F.concat(F.lit("code listed twice: "), F.col("rfm"))).cast("string")
    return (
        lookup.filter(F.col("rfm").rlike("^[1-4]{3}$"))
        .groupBy("rfm")
        .agg(F.when(F.count("*") > 1, duplicate).otherwise(F.first("category")).alias("category"))
    )


def join_segments(scored: DataFrame, lookup: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """Left join of customers to segments; both keys are kept.

    A code listed twice fails the query, which bounds the lookup to 64 rows and
    makes the broadcast safe. ``on_duplicate="expand"`` yields a row per entry
    and leaves the join strategy to the optimizer.
    """
    if on_duplicate not in ("error", "expand"):
        raise ValueError("on_duplicate must be 'error' or 'expand'")
    right = lookup if on_duplicate == "expand" else F.broadcast(unique_lookup(lookup))
    return scored.join(right, scored["rfm_code"] == right["rfm"], "left")


def drop_key(labelled: DataFrame) -> DataFrame:
    return labelled.drop("rfm")


def segment_summary(labelled: DataFrame) -> DataFrame:
    """Per segment: customers and revenue. Customers without one are left out.

    Distinct customers, as an expanding lookup may repeat one.
    """
    return (
        labelled.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.countDistinct("customer_id").alias("customers"), F.sum("monetary").alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def share_of_total(df: DataFrame, column: str, name: str = "share") -> DataFrame:
    """Add ``column`` divided by its total. For small results: one partition."""
    return df.withColumn(name, ratio(column, F.sum(column).over(W.partitionBy())))


def segment_cum_share(summary: DataFrame) -> DataFrame:
    """Revenue share of the best segment, the best two, and so on."""
    best_first = W.orderBy(F.desc("revenue"), "category").rowsBetween(W.unboundedPreceding, 0)
    total = F.sum("revenue").over(W.partitionBy())
    return summary.select(
        "category",
        "revenue",
        F.row_number().over(W.orderBy(F.desc("revenue"), "category")).alias("position"),
        ratio(F.sum("revenue").over(best_first), total).alias("cum_share"),
    )


def segments_by_home(labelled: DataFrame, sides: DataFrame) -> DataFrame:
    """Segment mix at home and away; customers of both sides count in each."""
    counts = (
        labelled.filter(F.col("category").isNotNull())
        .select("customer_id", "category")
        .join(sides.select("customer_id", "is_home", "monetary"), "customer_id")
        .groupBy("is_home", "category")
        .agg(F.count("*").alias("customers"), F.sum("monetary").alias("revenue"))
    )
    side = W.partitionBy("is_home")
    return counts.withColumn("customer_share", ratio("customers", F.sum("customers").over(side))).withColumn(
        "revenue_share", ratio("revenue", F.sum("revenue").over(side))
    )
