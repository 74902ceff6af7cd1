"""Parquet fixture tables and the rating tables derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def fixture_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: one rating 1..5 per (customer, part) = ceil(avg quantity / 10)."""
    return (
        _orders_lines(spark, sf_dir)
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg(F.ceil(F.avg("l_quantity") / 10).cast("double").alias("rating"))
    )


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R_raw: one row per order line, rating = quantity; (user, item) repeats."""
    return _orders_lines(spark, sf_dir).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
        F.col("l_quantity").cast("double").alias("rating"))


def items_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
