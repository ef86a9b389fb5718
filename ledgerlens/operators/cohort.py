"""Monthly cohorts and retention.

A customer's cohort is the month of the first purchase over all sales; it is
not taken anew inside the home or away part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlens.functions.dates import cohort_index
from ledgerlens.operators.metrics import ratio

SCOPES = ("all", "home", "away")
# Months in a word of a customer's calendar, and its words: 31 years from the
# first to the last purchase of one customer.
WORD_MONTHS, WORDS = 31, 12


def first_months(sales: DataFrame) -> DataFrame:
    """One row per customer: the month of the first purchase."""
    return (
        sales.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("month").alias("cohort_month"))
    )


def assign_cohort(sales: DataFrame, by_customer: bool = False) -> DataFrame:
    """Add cohort month and index to every invoice row.

    A window by customer would sort all rows of a customer in one task. The
    first months are aggregated map-side and joined back instead: the join is
    broadcast if they prove small, and else AQE splits a hot customer. It does
    so only between two fresh shuffles, not next to an aggregate's own
    partitioning, hence the rebalance of the few rows per customer. A table that
    is laid out ``by_customer`` is joined where it lies.
    """
    first = first_months(sales)
    if not by_customer:
        first = first.hint("rebalance")
    return sales.join(first, "customer_id", "left").withColumn(
        "cohort_index", cohort_index("month", "cohort_month")
    )


def _month_number(month: Column | str) -> Column:
    return F.year(month) * 12 + F.month(month) - 1


def customer_calendar(sales: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per customer: the first and the last month, and all active ones as bits.

    Month number n has two bits, for home and for other sales, at place n %
    WORD_MONTHS of word n div WORD_MONTHS % words; the words are ``word_0`` and
    so on. One hash aggregate of fixed width: rows are combined map-side,
    whatever a customer's share of them, and shuffled once, by customer.
    Calendars of two parts of the sales merge by the same aggregate
    (`merge_calendars`). Also reads ``customer_grain``.
    """
    number = "(year(month) * 12 + month(month) - 1)"
    away = "IF(coalesce(is_home, FALSE), 0, 1)"
    bit = f"shiftleft(1L, CAST({number} % {WORD_MONTHS} * 2 + {away} AS INT))"
    word = f"{number} DIV {WORD_MONTHS} % {words}"
    # Word and bit are no columns of their own: the optimizer drops a removal of
    # duplicates below an aggregate that lies right on it and ignores them. As
    # factors, not conditions, they are computed once for all words of a row.
    return (
        sales.filter(F.col("customer_id").isNotNull() & F.col("month").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.min("month").alias("first_month"),
            F.max("month").alias("last_month"),
            *[F.expr(f"bit_or({bit} * CAST({word} = {w} AS BIGINT)) AS word_{w}") for w in range(words)],
        )
    )


def merge_calendars(calendars: DataFrame) -> DataFrame:
    """One calendar per customer from the union of some of the same width."""
    return calendars.groupBy("customer_id").agg(
        F.min("first_month").alias("first_month"),
        F.max("last_month").alias("last_month"),
        *[F.bit_or(c).alias(c) for c in calendars.columns if c.startswith("word_")],
    )


def calendar_months(calendars: DataFrame) -> DataFrame:
    """``customer_months`` from ``customer_calendar``: its bits as rows, without a shuffle.

    A customer whose months span more than the words hold fails the query: give
    ``customer_calendar`` more of them.
    """
    words = [c for c in calendars.columns if c.startswith("word_")]
    span = _month_number("last_month") - _month_number("first_month")
    too_long = F.raise_error(F.lit(f"a customer's months span more than {len(words)} words")).cast("int")
    offset = F.sequence(F.lit(0), F.when(span < len(words) * WORD_MONTHS, span).otherwise(too_long))
    number = _month_number("first_month") + F.col("offset")
    word = F.get(F.array(*words), (F.floor(number / WORD_MONTHS) % len(words)).cast("int"))
    return (
        calendars.withColumn("offset", F.explode(offset))
        .withColumns({"word": word, "place": number % WORD_MONTHS * 2})
        .select(
            "customer_id",
            F.add_months("first_month", F.col("offset")).alias("month"),
            (F.getbit("word", F.col("place")) == 1).alias("home"),
            (F.getbit("word", F.col("place") + 1) == 1).alias("away"),
            F.col("first_month").alias("cohort_month"),
            (F.col("offset") + 1).alias("cohort_index"),
        )
        .filter(F.col("home") | F.col("away"))
    )


def customer_months(sales: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per customer and active month, with cohort and home/away flags.

    Read off the customers' calendars: one shuffle, no sort. Also reads
    ``customer_grain``.
    """
    return calendar_months(customer_calendar(sales, words))


def calendar_span(months: DataFrame) -> int:
    """Months from the first to the last one, of ``customer_months``; one row comes to the driver."""
    first = months.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    return first.select(F.coalesce(cohort_index("b", "a"), F.lit(0)).alias("n")).first().n


def counts_span(counts: DataFrame) -> int:
    """``calendar_span`` from the counts of all sales, of which there are months x months at most."""
    last = F.add_months("cohort_month", F.col("cohort_index") - 1)
    first = counts.agg(F.min("cohort_month").alias("a"), F.max(last).alias("b"))
    return first.select(F.coalesce(cohort_index("b", "a"), F.lit(0)).alias("n")).first().n


def cohort_counts(months: DataFrame, scope: str = "all") -> DataFrame:
    """Distinct customers per cohort and index, from ``customer_months``."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    if scope != "all":
        months = months.filter(scope)
    return months.groupBy("cohort_month", "cohort_index").agg(F.count("*").alias("customers"))


def cohort_counts_by_scope(months: DataFrame) -> DataFrame:
    """The counts of all three scopes from one aggregate."""
    counts = months.groupBy("cohort_month", "cohort_index").agg(
        F.count("*").alias("all"), F.count_if("home").alias("home"), F.count_if("away").alias("away")
    )
    long = counts.unpivot(["cohort_month", "cohort_index"], list(SCOPES), "scope", "customers")
    return long.filter(F.col("customers") > 0)


def retention(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add cohort size and rate to long cohort counts.

    The size is the count at the smallest index of the whole table (of the
    scope, with ``by``). A cohort without that cell has null rates, and a rate
    can exceed 1. The windows see at most months x months rows.
    """
    by = list(by)
    base_index = F.min("cohort_index").over(W.partitionBy(*by))
    at_base = F.when(F.col("cohort_index") == F.col("base_index"), F.col("customers"))
    size = F.max(at_base).over(W.partitionBy(*by, "cohort_month"))
    return (
        counts.withColumn("base_index", base_index)
        .withColumn("cohort_size", size)
        .withColumn("rate", ratio("customers", "cohort_size"))
        .drop("base_index")
    )


def cohort_sizes(counts: DataFrame) -> DataFrame:
    """Cohort size: the count at the smallest index of the whole table."""
    lowest = F.min("cohort_index").over(W.partitionBy())
    return (
        counts.withColumn("lowest", lowest)
        .filter(F.col("cohort_index") == F.col("lowest"))
        .select("cohort_month", F.col("customers").alias("cohort_size"))
    )


def cohort_size_join(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Divide each cohort's cells by its size, matched by cohort."""
    return counts.join(sizes, "cohort_month", "left").withColumn("rate", ratio("customers", "cohort_size"))


def cohort_pivot(
    counts: DataFrame, value: str = "customers", indexes: Sequence[int] | None = None
) -> DataFrame:
    """Cohorts as rows, one double column per index; gaps are null.

    Without ``indexes`` the columns go from 1 to the largest one, which a first
    job over ``counts`` finds: materialise them before. With ``indexes``, a
    count beyond them fails the query rather than vanish.
    """
    cell = F.first(value).cast("double")
    if indexes is None:
        indexes = range(1, (counts.agg(F.max("cohort_index").alias("n")).first().n or 0) + 1)
    indexes = list(indexes)
    beyond = ~F.col("cohort_index").isin(indexes)
    counts = counts.withColumn(
        "cohort_index",
        F.when(beyond, F.raise_error(F.lit("cohort index outside the pivot's columns"))).otherwise(
            F.col("cohort_index")
        ),
    )
    return counts.groupBy("cohort_month").pivot("cohort_index", indexes).agg(cell)


def retention_drop(rates: DataFrame) -> DataFrame:
    """Change of rate from the index just before; null when that is absent."""
    w = W.partitionBy("cohort_month").orderBy("cohort_index")
    follows = F.lag("cohort_index").over(w) == F.col("cohort_index") - 1
    return rates.withColumn("change", F.when(follows, F.col("rate") - F.lag("rate").over(w)))


def weakest_cohort(rates: DataFrame) -> DataFrame:
    """The cohort with the lowest mean rate after its first month.

    The mean is taken from integer counts, so it does not depend on row order.
    """
    later: Column = F.col("cohort_index") >= 2
    return (
        rates.filter(later & F.col("cohort_size").isNotNull())
        .groupBy("cohort_month", "cohort_size")
        .agg(F.sum("customers").alias("later_customers"), F.count("*").alias("later_months"))
        .withColumn("mean_rate", ratio("later_customers", F.col("cohort_size") * F.col("later_months")))
        .orderBy("mean_rate", "cohort_month")
        .limit(1)
    )


def new_vs_returning(months: DataFrame, monthly: DataFrame) -> DataFrame:
    """Per month: first-time and returning customers, invoices per customer."""
    kinds = months.groupBy("month").agg(
        F.count_if(F.col("cohort_index") == 1).alias("new_customers"),
        F.count_if(F.col("cohort_index") > 1).alias("returning_customers"),
    )
    return (
        monthly.select("month", "invoices", "customers")
        .join(kinds, "month")
        .withColumn("invoices_per_customer", ratio("invoices", "customers"))
        .drop("customers")
    )
