"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.session import scratch_path

# Fixed value: the white space that ends a word.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    """Sum of an array of longs; 0 if empty."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it from there.

    Cuts the lineage: a lost executor costs a read, and a later plan can't
    recompute the rows differently.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, **needed: Column) -> tuple[DataFrame, list[Column]]:
    """``needed`` columns beside all of ``docs`` under other names, and the columns that bring those back.

    So no column of ``docs`` can clash with one that an operator makes.
    """
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    own = {c: F.col(f"`{c}`") for c in names}
    renamed = docs.select(*[v.alias(k) for k, v in needed.items()], *[own[c].alias(n) for c, n in names.items()])
    return renamed, [F.col(n).alias(c) for c, n in names.items()]
