"""Tables laid out by customer, so that what is grouped or joined by customer is not shuffled again."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

KEY = "customer_id"


def write_by_customer(df: DataFrame, path: str, buckets: int, mode: str = "error") -> DataFrame:
    """Write ``df`` as parquet in ``buckets`` of customer ids, sorted by them, and read it so.

    For tables with a bounded number of rows per customer: a bucket is read by
    one task. Rows are dealt by customer first, so that a bucket has one file or,
    where AQE splits a large one, a few. The table is known to the session's
    catalog by a name of its own; `forgotten` removes that, and the files stay.
    """
    name = f"by_customer_{uuid.uuid4().hex}"
    (
        df.hint("rebalance", buckets, KEY)
        .write.mode(mode)
        .bucketBy(buckets, KEY)
        .sortBy(KEY)
        .option("path", path)
        .saveAsTable(name, format="parquet")
    )
    return df.sparkSession.table(name)


def read_by_customer(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """A table that `write_by_customer` wrote into ``buckets``, in this session or another."""
    name = f"by_customer_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _known(spark: SparkSession) -> set[str]:
    return {t.name for t in spark.catalog.listTables() if t.name.startswith("by_customer_")}


@contextlib.contextmanager
def forgotten(spark: SparkSession) -> Iterator[None]:
    """Remove the names that the block's tables got from the catalog; their files stay."""
    before = _known(spark)
    try:
        yield
    finally:
        for name in _known(spark) - before:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
