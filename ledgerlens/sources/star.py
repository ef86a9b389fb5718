"""Raw invoice rows derived from an order star schema, dirt included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.schema import HOME_COUNTRY, amount_type

# The columns used. Given as a schema, they spare a job that reads footers.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_quantity double",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def sales_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, plus a second copy of some.

    The tables are clean, so missing ids, refunds, home orders and duplicates
    follow from the keys. Refunds are negative in quantity and amount.
    """

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    items = table("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("items"))
    places = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    joined = (
        table("orders")
        .join(items, key == F.col("l_orderkey"), "left")
        .join(places.select("c_custkey", "n_name"), customer == F.col("c_custkey"), "left")
    )
    refund = key % 11 == 0
    quantity = F.coalesce(F.col("items"), F.lit(0)).cast("long")
    amount = F.col("o_totalprice").cast(amount_type())
    copies = F.when(key % 50 == 1, 2).otherwise(1)
    sales = joined.select(
        key.cast("string").alias("invoice_no"),
        F.when(key % 7 != 0, customer).alias("customer_id"),
        F.col("o_orderdate").alias("invoice_ts"),
        F.when((customer % 4 != 0) | (key % 9 == 0), HOME_COUNTRY).otherwise(F.col("n_name")).alias("country"),
        F.when(refund, -quantity).otherwise(quantity).alias("quantity"),
        F.replace(F.when(refund, -amount).otherwise(amount).cast("string"), F.lit("."), F.lit(",")).alias(
            "amount_txt"
        ),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"),
    )
    return sales.drop("copy")
