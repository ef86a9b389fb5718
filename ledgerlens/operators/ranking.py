"""Exact order statistics without a global sort in one task.

Percentiles are found by radix selection. For curves, values are first counted,
so ties collapse map-side; the distinct values are range-partitioned, and each
range gets the totals of the ranges below it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ledgerlens.operators.metrics import ratio
from ledgerlens.session import materialise

# Values that a digit of the radix selection has.
_DIGITS = 1024


def _scale(df: DataFrame, columns: Sequence[str]) -> int:
    """The most decimals among whole-number and decimal columns."""
    kinds = [df.schema[c].dataType for c in columns]
    return max((k.scale for k in kinds if isinstance(k, T.DecimalType)), default=0)


def _common(df: DataFrame, columns: Sequence[str]) -> T.DecimalType:
    """A decimal type that holds all values of whole-number and decimal columns."""
    kinds = [df.schema[c].dataType for c in columns]
    kinds = [k if isinstance(k, T.DecimalType) else T.DecimalType(20, 0) for k in kinds]
    scale = _scale(df, columns)
    return T.DecimalType(min(38, max(k.precision - k.scale for k in kinds) + scale), scale)


def ranged_histogram(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per (group, value): its rows ``n``, its range ``part``, and for the range
    the rows and sum before it and in it, with the group's totals.

    The range number is the partition's, stored with the rows, so a later
    re-run of a lost task, or AQE merging partitions another way, cannot change
    it. ``totals`` has one row per group and partition: its size is the
    partition count, not the data's.
    """
    counted = df.groupBy(group, value).agg(F.count("*").alias("n"), F.sum(value).alias("amount"))
    ranged = materialise(counted.repartitionByRange(group, value).withColumn("part", F.spark_partition_id()))
    earlier = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(group)
    totals = (
        ranged.groupBy(group, "part")
        .agg(F.sum("n").alias("part_n"), F.sum("amount").alias("part_amount"))
        .select(
            group,
            "part",
            "part_n",
            F.coalesce(F.sum("part_n").over(earlier), F.lit(0)).alias("n_base"),
            F.coalesce(F.sum("part_amount").over(earlier), F.lit(0)).alias("amount_base"),
            F.sum("part_n").over(whole).alias("n_total"),
            F.sum("part_amount").over(whole).alias("amount_total"),
        )
    )
    return ranged.join(F.broadcast(totals), [group, "part"])


def cumulate(ranged: DataFrame, group: str, value: str) -> DataFrame:
    """Add to ``ranged_histogram`` the rows and sum below each value."""
    inside = W.partitionBy(group, "part").orderBy(value).rowsBetween(W.unboundedPreceding, -1)

    def before(column: Column, base: str) -> Column:
        return F.col(base) + F.coalesce(F.sum(column).over(inside), F.lit(0))

    return ranged.select(
        group,
        value,
        "n",
        before(F.col("n"), "n_base").alias("n_below"),
        before(F.col("amount"), "amount_base").alias("amount_below"),
        "n_total",
        "amount_total",
    )


@dataclass(frozen=True)
class _Interval:
    """Values from ``low`` on, ``step`` * _DIGITS of them, with ``below`` rows before; in the values' last place."""

    column: str
    low: int
    step: int
    below: int


def _unscaled(value: Decimal, scale: int) -> int:
    return int(value.scaleb(scale, Context(prec=60)))


def _digits(df: DataFrame, kind: T.DecimalType, intervals: list[_Interval]) -> dict[int, dict[int, int]]:
    """Rows per leading digit of each interval: one pass, at most _DIGITS counts an interval.

    The intervals of a column do not overlap, so a value has one digit a column.
    """

    def decimal(unscaled: int) -> Column:
        return F.lit(str(Decimal(unscaled).scaleb(-kind.scale, Context(prec=60)))).cast(kind)

    found = []
    for name in dict.fromkeys(i.column for i in intervals):
        value, place = F.col(name), F.lit(None).cast("struct<interval:int,digit:bigint>")
        for number, i in enumerate(intervals):
            if i.column == name:
                last = min(i.low + i.step * _DIGITS, 10**kind.precision) - 1
                inside = value.between(decimal(i.low), decimal(last))
                digit = F.call_function("div", value - decimal(i.low), decimal(i.step))
                place = F.when(inside, F.struct(F.lit(number).alias("interval"), digit.alias("digit"))).otherwise(place)
        found.append(place)
    counts = (
        df.select(F.explode(F.array(*found)).alias("place"))
        .filter(F.col("place").isNotNull())
        .groupBy("place")
        .agg(F.count("*").alias("n"))
    )
    out: dict[int, dict[int, int]] = {number: {} for number in range(len(intervals))}
    for row in counts.agg(F.collect_list(F.struct("place", "n")).alias("all")).first()["all"]:
        out[row["place"]["interval"]][row["place"]["digit"]] = row["n"]
    return out


def _selected(df: DataFrame, kind: T.DecimalType, wanted: dict[str, set[int]], bounds: dict[str, tuple[int, int]]) -> dict:
    """The values (in the last place) at the wanted ranks of each column, by radix selection.

    Each pass counts a digit of the values, _DIGITS of them to the range, and
    goes on inside those digits alone that hold a wanted rank. After as many
    passes as the range has digits, an interval is one value.
    """
    open_: dict[_Interval, set[int]] = {}
    for name, ranks in wanted.items():
        low, high = bounds[name]
        step = 1
        while step * _DIGITS < high - low + 1:
            step *= _DIGITS
        open_[_Interval(name, low, step, 0)] = ranks
    values = {}
    while open_:
        intervals, later = list(open_), {}
        for number, digits in _digits(df, kind, intervals).items():
            own = intervals[number]
            below = own.below
            for digit in sorted(digits):
                inside = {r for r in open_[own] if below <= r < below + digits[digit]}
                low = own.low + digit * own.step
                if inside and own.step == 1:
                    values.update({(own.column, r): low for r in inside})
                elif inside:
                    later[_Interval(own.column, low, own.step // _DIGITS, below)] = inside
                below += digits[digit]
        open_ = later
    return values


def exact_percentiles(df: DataFrame, columns: Sequence[str], percents: Sequence[int]) -> DataFrame:
    """Per column: linearly interpolated percentiles and the maximum.

    One row per column that has values, with fields ``p25`` and so on. By radix
    selection: nothing is sorted, and no range is sampled or stored. ``df`` is
    read once for the bounds and once a digit, so pass it materialised; all
    columns share the passes. What comes to the driver is _DIGITS counts for
    each wanted rank at most. Ranks, weights and values are whole numbers and
    decimals, so an edge that falls on a value equals it exactly.
    """
    spark, scale, kind = df.sparkSession, _scale(df, columns), _common(df, columns)
    values = df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
    bounds = values.agg(*[F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]).first()
    there = [c for c in columns if bounds[c]["n"]]
    ranks = {c: {p: divmod((bounds[c]["n"] - 1) * p, 100) for p in percents} for c in there}
    wanted = {c: {r for low, rest in own.values() for r in ((low, low + 1) if rest else (low,))} for c, own in ranks.items()}
    ends = {c: (_unscaled(bounds[c]["low"], scale), _unscaled(bounds[c]["high"], scale)) for c in there}
    found = _selected(values, kind, wanted, ends)

    def edge(c: str, p: int) -> Decimal:
        low, rest = ranks[c][p]
        value = found[c, low] * 100 + ((found[c, low + 1] - found[c, low]) * rest if rest else 0)
        return Decimal(value).scaleb(-scale - 2, Context(prec=60))

    rows = [(c, *[edge(c, p) for p in percents], bounds[c]["high"]) for c in there]
    edge_type = T.DecimalType(38, scale + 2).simpleString()
    schema = ", ".join(["measure string", *[f"p{p} {edge_type}" for p in percents], f"max {kind.simpleString()}"])
    return spark.createDataFrame(rows, schema)


def pareto_curve(base: DataFrame) -> DataFrame:
    """Per spend level, highest first: customers and revenue down to it.

    Customers of equal spend share a row.
    """
    scale = _scale(base, ["monetary"])
    spend = base.select(F.lit("spend").alias("measure"), "monetary").filter(F.col("monetary").isNotNull())
    total = T.DecimalType(38, scale)
    curve = cumulate(ranged_histogram(spend, "measure", "monetary"), "measure", "monetary")
    return curve.select(
        "monetary",
        F.col("n").alias("customers"),
        (F.col("n_total") - F.col("n_below")).alias("top_customers"),
        (F.col("amount_total") - F.col("amount_below")).cast(total).alias("top_revenue"),
        F.col("n_total").alias("all_customers"),
        F.col("amount_total").alias("all_revenue"),
    )


def pareto_customers(curve: DataFrame) -> DataFrame:
    """Revenue share of the top 1 %, 2 %, ... 100 % of customers.

    The top k % are the ``floor(k * customers / 100)`` with the highest spend.
    Each spend level yields the percents whose last customer stands on it (the
    first level also those of no customer yet), so the curve is read once and
    nothing is joined.
    """
    above = F.col("top_customers") - F.col("customers")
    first = F.when(above == 0, 1).otherwise(F.ceil((above + 1) * 100 / F.col("all_customers")))
    last = F.least(F.ceil((F.col("top_customers") + 1) * 100 / F.col("all_customers")) - 1, F.lit(100))
    reached = F.when(first <= last, F.sequence(first.cast("long"), last)).otherwise(F.array().cast("array<bigint>"))
    chosen = F.floor(F.col("percent") * F.col("all_customers") / 100)
    surplus = (F.col("top_customers") - chosen) * F.col("monetary")
    revenue = (F.col("top_revenue") - surplus).cast(curve.schema["top_revenue"].dataType)
    return (
        curve.withColumn("percent", F.explode(reached))
        .select("percent", chosen.alias("customers"), revenue.alias("revenue"), "all_revenue")
        .withColumn("revenue_share", ratio("revenue", "all_revenue"))
        .drop("all_revenue")
    )
