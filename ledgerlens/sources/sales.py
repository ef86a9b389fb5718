"""Reading invoice tables and segment lookups, writing reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerlens.functions.numbers import parse_whole
from ledgerlens.schema import MISSING_TEXTS, RAW_TYPES, SOURCE_NAMES


_BAD_LINE, _MARK = "_bad_line", "\x02"


def read_sales(spark: SparkSession, path: str, fmt: str = "csv", **options: str) -> DataFrame:
    """Invoice rows from CSV or parquet.

    Columns are taken by name, so their order is free, if it is the same in all
    files of a folder, and further columns are kept. Nothing is inferred: CSV fields are text, the known ones
    get their types, and dates stay text until cleaning parses them.
    """
    raw = _read(spark, path, fmt, **options).withColumnsRenamed(SOURCE_NAMES)
    missing = set(SOURCE_NAMES.values()) - set(raw.columns)
    if missing:
        raise ValueError(f"{path} lacks columns {sorted(missing)}")
    return raw.select(*[_typed(name, kind).alias(name) for name, kind in raw.dtypes])


def _read(spark: SparkSession, path: str, fmt: str, **options: str) -> DataFrame:
    """All fields as text, missing ones null.

    For CSV, the header of each file must be that of the first, a doubled quote
    in a quoted field is a quote, a line with too few fields gets nulls, and one
    with too many fails the query, whichever columns it uses.
    """
    if fmt != "csv":
        return spark.read.options(**options).format(fmt).load(path)
    options = {"header": True, "escape": '"', **options}
    header = spark.read.options(inferSchema=False, **options).csv(path).columns
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _BAD_LINE]])
    # Without column pruning, so that a line's fields are counted in each query.
    text = spark.read.schema(fields).options(
        enforceSchema=False, columnPruning=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD_LINE, **options
    ).csv(path)
    # A line with another number of fields, and a mark behind it: of a short line
    # the mark is among the first fields, of a long one it is not.
    wider = ", ".join(f"c{i} string" for i in range(len(header) + 1))
    line = {k: str(v) for k, v in options.items() if k != "header"}
    marked = F.concat(F.col(_BAD_LINE), F.lit(options.get("sep", options.get("delimiter", ",")) + _MARK))
    found = F.from_csv(marked, wider, line)
    surplus = ~F.array_contains(F.array(*[F.coalesce(found[f"c{i}"], F.lit("")) for i in range(len(header) + 1)]), _MARK)
    failed = F.raise_error(F.concat(F.lit("too many fields: "), F.col(_BAD_LINE))).cast("boolean")
    whole = text.filter(F.when(F.col(_BAD_LINE).isNotNull() & surplus, failed).otherwise(True))
    # A byte order mark would stick to the first header name.
    return whole.select(
        *[F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")).alias(c.removeprefix("\ufeff")) for c in header]
    )


def _typed(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    wanted = RAW_TYPES.get(name)
    if wanted is None:
        return column
    if kind == "string" and isinstance(wanted, T.LongType):
        return parse_whole(column)
    return column.cast(wanted)


def write_sales_csv(sales: DataFrame, path: str) -> None:
    """Write invoice rows as CSV under the source's header names."""
    source_name = {ours: name for name, ours in SOURCE_NAMES.items()}
    sales.toDF(*[source_name.get(c, c) for c in sales.columns]).write.csv(path, header=True, escape='"')


def read_segments(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """RFM code to category lookup; codes are read as text."""
    raw = _read(spark, path, fmt).withColumnRenamed("Categoria", "category")
    return raw.select(F.col("rfm").cast("string").alias("rfm"), "category")


def write_report(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "error"
) -> None:
    """Persist a result table as parquet for dashboards.

    With ``partition_by`` rows are rebalanced on those columns first: each
    folder gets few files, and AQE splits a folder that holds most rows. With
    the mode ``replace``, folders that ``df`` has rows for are replaced and all
    others stay: a month can be restated, and a failed run repeated.
    """
    if mode == "replace":
        if not partition_by:
            raise ValueError("only folders can be replaced: give partition_by")
        rows = df.hint("rebalance", *partition_by)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    elif partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
