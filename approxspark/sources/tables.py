"""Batch sources: the driver's parquet tables and the reference's ``sales`` view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's sales table (id, category, price, user_id) over orders x customer.

    customer is the dimension (a tenth of orders). Catalyst picks a broadcast join from the scan
    statistics while customer is under the auto-broadcast threshold and a sort-merge join beyond
    it, so no broadcast hint is forced here. Only the four needed columns are read.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").select(
        F.col("o_orderkey").alias("id"),
        F.col("c_mktsegment").alias("category"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("user_id"),
    )


SALES_SQL = (
    "(SELECT o_orderkey AS id, c_mktsegment AS category, o_totalprice AS price, o_custkey AS user_id "
    "FROM orders JOIN customer ON o_custkey = c_custkey)"
)
