"""Cleaning steps. Their order matters: ``clean_sales`` applies them in it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ledgerlens.functions.dates import month_floor, parse_timestamp
from ledgerlens.functions.numbers import parse_decimal_comma
from ledgerlens.schema import AMOUNT_SCALE, HOME_COUNTRY
from ledgerlens.session import scratch_path


def is_kept() -> Column:
    """No refund: quantity is not negative. An unknown quantity stays."""
    return F.col("quantity").isNull() | (F.col("quantity") >= 0)


def is_present(name: str, kind: str) -> Column:
    """Neither null nor, in a column of floats, NaN."""
    column = F.col(f"`{name}`")
    return column.isNotNull() & ~F.isnan(column) if kind in ("float", "double") else column.isNotNull()


def is_complete(df: DataFrame) -> Column:
    """Every column is present."""
    return reduce(lambda a, b: a & b, [is_present(name, kind) for name, kind in df.dtypes])


def drop_negative(sales: DataFrame) -> DataFrame:
    """Remove refunds."""
    return sales.filter(is_kept())


def drop_duplicates(sales: DataFrame) -> DataFrame:
    """Remove fully identical rows; nulls count as equal.

    The shuffle is on all columns, after a map-side pass that already collapses
    copies, so neither a big customer nor a much-repeated row makes a hot task.
    """
    return sales.distinct()


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of each row. A null counts as such: the hash function itself skips it."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(nulls, *columns), F.xxhash64(*columns, nulls)


def drop_duplicates_by_digest(
    df: DataFrame, digest: Callable[[DataFrame], tuple[Column, Column]] = row_digest
) -> DataFrame:
    """``drop_duplicates`` for wide rows: only digests are shuffled, and the rows that share one.

    The first pass counts digests and stores those that stand more than once. A
    row whose digest stands alone has no copy and passes as it is; of the others,
    the whole rows are compared, so a digest that two rows share costs a
    comparison and nothing else. The stored digests have a known size: they are
    broadcast if that is small; otherwise the rows are dealt by digest. Reads ``df``
    three times, so it pays where a row is much wider than its digest and few
    rows have copies. ``df`` must give the same rows each time.
    """
    spark = df.sparkSession
    first, second = digest(df)
    names = ["_digest_1", "_digest_2"]
    keyed = df.withColumns(dict(zip(names, (first, second))))
    counted = keyed.groupBy(*names).agg(F.count("*").alias("n")).filter("n > 1").select(*names)
    path = scratch_path(spark, "digests")
    counted.write.parquet(path)
    repeated = spark.read.schema(counted.schema).parquet(path)
    alone = keyed.join(repeated, names, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
    copied = keyed.join(repeated, names, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    return alone.union(copied.distinct())


def drop_missing(sales: DataFrame) -> DataFrame:
    """Remove rows with any null.

    Written as IS NOT NULL tests, which reach the parquet scan; ``dropna`` does
    not get that far.
    """
    return sales.filter(is_complete(sales))


def type_columns(
    sales: DataFrame, ts_format: str | None = None, on_error: str = "fail", scale: int = AMOUNT_SCALE
) -> DataFrame:
    """Parse dates (when they are text) and comma-decimal amounts."""
    if dict(sales.dtypes)["invoice_ts"] == "string":
        if ts_format is None:
            raise ValueError("text dates need an explicit ts_format")
        sales = sales.withColumn("invoice_ts", parse_timestamp("invoice_ts", ts_format, on_error))
    amount = parse_decimal_comma("amount_txt", on_error, scale).alias("amount")
    return sales.select(*[amount if c == "amount_txt" else F.col(f"`{c}`") for c in sales.columns])


def whole_rows(sales: DataFrame) -> DataFrame:
    """Refunds, duplicates and incomplete rows out; what is left is still text."""
    return sales.transform(drop_negative).transform(drop_duplicates).transform(drop_missing)


def clean_sales(
    sales: DataFrame, ts_format: str | None = None, on_error: str = "fail", scale: int = AMOUNT_SCALE
) -> DataFrame:
    """Refunds, duplicates, incomplete rows out; then typed.

    Duplicates are compared as text, so ``"10,0"`` and ``"10,00"`` differ.
    """
    return sales.transform(whole_rows).transform(type_columns, ts_format, on_error, scale)


# Reason codes of rejected rows.
BAD_DATE, BAD_AMOUNT = "bad_date", "bad_amount"


def reject_reason(sales: DataFrame, ts_format: str | None = None, scale: int = AMOUNT_SCALE) -> Column:
    """What of a row cannot be read, codes joined by commas; null if all can. Missing text is no fault."""
    reasons = [F.when(_unread("amount_txt", parse_decimal_comma("amount_txt", "null", scale)), BAD_AMOUNT)]
    if dict(sales.dtypes)["invoice_ts"] == "string":
        if ts_format is None:
            raise ValueError("text dates need an explicit ts_format")
        reasons.insert(0, F.when(_unread("invoice_ts", parse_timestamp("invoice_ts", ts_format, "null")), BAD_DATE))
    joined = F.concat_ws(",", *reasons)
    return F.when(joined != "", joined)


def routed(rows: DataFrame, ts_format: str | None = None, scale: int = AMOUNT_SCALE) -> DataFrame:
    """``whole_rows`` with their ``reason`` to be rejected, or null; the texts stay as they are.

    `accepted` and `rejected` are the two sides of the result, which is to be
    stored first, so that the source is read once.
    """
    return rows.withColumn("reason", reject_reason(rows, ts_format, scale))


def rejected(routes: DataFrame) -> DataFrame:
    """The rows that cannot be read, as text, with the reason."""
    return routes.filter(F.col("reason").isNotNull())


def accepted(routes: DataFrame, ts_format: str | None = None, scale: int = AMOUNT_SCALE) -> DataFrame:
    """The other rows, typed."""
    return type_columns(routes.filter(F.col("reason").isNull()).drop("reason"), ts_format, "fail", scale)


def observed_whole_rows(sales: DataFrame, seen: Observation, left: Observation) -> DataFrame:
    """``whole_rows``, counted on the way by the job that reads them.

    `profile.observed_audit` makes the audit of the two observations after that
    job. The counts keep the test for missing values behind the removal of
    duplicates, where it belongs in the audit.
    """
    raw = sales.observe(seen, F.count("*").alias("raw"), F.count_if(is_kept()).alias("drop_negative"))
    distinct = raw.transform(drop_negative).transform(drop_duplicates)
    complete = F.count_if(is_complete(distinct))
    return distinct.observe(left, F.count("*").alias("drop_duplicates"), complete.alias("drop_missing")).transform(drop_missing)


def unparsable(sales: DataFrame, ts_format: str, scale: int = AMOUNT_SCALE) -> DataFrame:
    """Rows whose date or amount text cannot be read: those that
    ``type_columns(on_error="null")`` gives nulls."""
    return sales.filter(reject_reason(sales, ts_format, scale).isNotNull())


def _unread(text: str, parsed: Column) -> Column:
    return F.col(text).isNotNull() & parsed.isNull()


def home_flag(country: Column | str, home: str = HOME_COUNTRY) -> Column:
    """True for the home country; an unknown country is away."""
    country = F.col(country) if isinstance(country, str) else country
    return country.eqNullSafe(F.lit(home))


def add_features(sales: DataFrame, home: str = HOME_COUNTRY) -> DataFrame:
    """Add invoice month and home flag."""
    return sales.withColumns({"month": month_floor("invoice_ts"), "is_home": home_flag("country", home)})


def split_home(sales: DataFrame) -> DataFrame:
    return sales.filter("is_home")


def split_away(sales: DataFrame) -> DataFrame:
    return sales.filter(~F.col("is_home"))
