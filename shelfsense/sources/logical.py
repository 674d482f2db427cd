"""The library's logical tables as views over a folder of Parquet tables in a star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.sources.session import tune


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """``user_tag, item_id, units, date``: one row per order line."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey"), F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("units")
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderdate").cast("date").alias("date")
    )
    tags = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("user_tag")
    )
    return (
        lines.join(orders, "l_orderkey").join(tags, "o_custkey").select("user_tag", "item_id", "units", "date")
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """``item_id, product_name, klass, varietal, size, price``."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("klass"),
        F.col("p_brand").alias("varietal"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def rating_triples(spark: SparkSession, folder: str) -> DataFrame:
    """``user_tag, item_id, rating``: one row per pair, 1 to 10 by the units bought, five to a step."""
    return (
        purchases(spark, folder)
        .groupBy("user_tag", "item_id")
        .agg(F.least(F.lit(10), F.ceil(F.sum("units") / 5)).cast("int").alias("rating"))
    )
