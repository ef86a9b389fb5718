"""Data-quality profiles: one aggregate pass over the table, or less."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, Window as W, functions as F

from ledgerlens.operators.clean import is_complete, is_kept, is_present


# Fixed value: wording of the sentence.
SHAPE_SENTENCE = "A base de dados apresenta %d registros de compras (linhas) e %d variáveis (colunas)"


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: type, count of present values and row count. NaN is missing, as in cleaning."""
    present = [F.count_if(is_present(c, kind)).alias(c) for c, kind in df.dtypes]
    counts = df.agg(F.count("*").alias("rows"), *present)
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return counts.unpivot(["rows"], list(df.columns), "column", "non_null").select(
        "column", types[F.col("column")].alias("type"), "non_null", "rows"
    )


def profile_missing(df: DataFrame) -> DataFrame:
    """Per column: count of nulls and NaNs."""
    return profile_columns(df).select("column", (F.col("rows") - F.col("non_null")).alias("missing"))


def profile_shape(df: DataFrame) -> DataFrame:
    """Row and column counts, also as a sentence."""
    width = F.lit(len(df.columns))
    return df.agg(F.count("*").alias("rows")).select(
        "rows", width.alias("columns"), F.format_string(SHAPE_SENTENCE, "rows", width).alias("sentence")
    )


def audit_zero_amount(sales: DataFrame) -> DataFrame:
    """How many invoice rows have amount 0, and their share."""
    zero = F.count_if(F.col("amount") == 0)
    return sales.agg(zero.alias("zero_rows"), F.count("*").alias("rows")).select(
        "zero_rows", "rows", F.try_divide(F.col("zero_rows").cast("double"), "rows").alias("zero_share")
    )


def preview(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in a fixed order."""
    return df.orderBy(*order_by).limit(n)


# The steps of cleaning, in order.
AUDIT_STEPS = ["raw", "drop_negative", "drop_duplicates", "drop_missing"]


def observed_audit(spark: SparkSession, seen: Observation, left: Observation) -> DataFrame:
    """``clean_audit`` from what a job over `clean.observed_whole_rows` counted; no scan of its own.

    Where an executor is lost in that job, the rows that its tasks read again
    may be counted twice.
    """
    counts = dict.fromkeys(AUDIT_STEPS, 0)
    for observation in (seen, left):
        # Spark leaves out a branch that proves empty, and its counts with it.
        with contextlib.suppress(Py4JJavaError):
            counts |= observation.get
    rows = [counts[step] for step in AUDIT_STEPS]
    removed = [0, *(a - b for a, b in zip(rows, rows[1:]))]
    table = list(zip(range(1, len(rows) + 1), AUDIT_STEPS, rows, removed))
    return spark.createDataFrame(table, "position int, step string, rows long, removed long")


def profile_stored(spark: SparkSession, path: str) -> DataFrame:
    """``profile_columns`` of parquet files, from their footers.

    Counts are pushed down to the second version of Spark's parquet source,
    which finds them in the footers and opens no data page. Columns of floats
    are read, as footers do not tell NaNs, and so are nested ones, of which they
    count the leaves. A row of counts comes to the driver.
    """
    with footer_counts(spark):
        df = spark.read.parquet(path)
        own = _footer_columns(df)
        counts = dict(zip(["*", *own], footer_aggregate(df).first()))
    rest = [F.count_if(is_present(c, kind)).alias(c) for c, kind in df.dtypes if c not in own]
    if rest:
        counts |= df.agg(*rest).first().asDict()
    rows = [(c, kind, counts[c], counts["*"]) for c, kind in df.dtypes]
    return spark.createDataFrame(rows, "column string, type string, non_null long, rows long")


def _footer_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if not kind.startswith(("float", "double", "array", "map", "struct", "variant"))]


def footer_aggregate(df: DataFrame) -> DataFrame:
    """The counts that can be pushed down: of all rows, and of the values of plain columns."""
    return df.agg(F.count("*").alias("*"), *[F.count(F.col(_q(c))).alias(c) for c in _footer_columns(df)])


@contextlib.contextmanager
def footer_counts(spark: SparkSession) -> Iterator[None]:
    """Read parquet by the source that answers counts from footers, and put the settings back."""
    first = "spark.sql.sources.useV1SourceList"
    settings = {
        first: ",".join(s for s in spark.conf.get(first).split(",") if s != "parquet"),
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def clean_audit(sales: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, from one shuffle.

    Copies are counted per distinct row, so a row repeated many times arrives
    already combined.
    """
    kept, complete = is_kept(), is_complete(sales)
    distinct = sales.groupBy(*[F.col(_q(c)) for c in sales.columns]).agg(F.count("*").alias("copies"))
    steps = AUDIT_STEPS
    counts = distinct.agg(
        F.sum("copies").alias(steps[0]),
        F.sum(F.when(kept, F.col("copies"))).alias(steps[1]),
        F.count_if(kept).alias(steps[2]),
        F.count_if(kept & complete).alias(steps[3]),
    )
    position = F.create_map(*[F.lit(x) for i, s in enumerate(steps, 1) for x in (s, i)])
    # One row holds the four counts, so this window sees four rows.
    before = F.lag("rows").over(W.orderBy("position"))
    return (
        counts.na.fill(0)
        .unpivot([], steps, "step", "rows")
        .withColumn("position", position[F.col("step")])
        .select("position", "step", "rows", F.coalesce(before - F.col("rows"), F.lit(0)).alias("removed"))
    )


def _q(column: str) -> str:
    return f"`{column}`"
