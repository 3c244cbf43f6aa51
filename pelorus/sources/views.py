"""Interaction and item views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_parquet


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an interaction log: customer, part, ship date, rating 1-5 from the quantity."""
    lines = read_parquet(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = read_parquet(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_shipdate").alias("date_time"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("tags"),
        F.col("p_type").alias("ingredients"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click-stream events as an interaction log with an event type."""
    return read_parquet(spark, sf_dir, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("item_id"),
        F.col("ts").alias("date_time"),
        "event_type",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text", "lang", "source")
