"""Readers for interaction logs and item tables, and the run-log sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERACTIONS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("recipe_id", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review", T.StringType()),
    ]
)

ITEMS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("minutes", T.DoubleType()),
        T.StructField("contributor_id", T.LongType()),
        T.StructField("submitted", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("nutrition", T.StringType()),
        T.StructField("n_steps", T.DoubleType()),
        T.StructField("steps", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("ingredients", T.StringType()),
        T.StructField("n_ingredients", T.DoubleType()),
    ]
)


def _csv(spark: SparkSession, path: str, schema: T.StructType | None, multi_line: bool) -> DataFrame:
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # Read by header name, so that column order in the file does not matter; a column the file lacks is left out.
    raw = reader.csv(path)
    return raw.select(
        *[
            F.expr(f"try_cast(`{field.name}` AS {field.dataType.simpleString()})").alias(field.name)
            for field in schema.fields
            if field.name in raw.columns
        ]
    )


def read_interactions_csv(spark: SparkSession, path: str, schema: T.StructType | None = INTERACTIONS_SCHEMA, multi_line: bool = False) -> DataFrame:
    """Interaction log from CSV, to ``user_id, item_id, date_time, rating``; bad dates become null.

    A file is read by many tasks. If quoted fields hold line breaks, pass ``multi_line=True``; each file is one task then.
    """
    raw = _csv(spark, path, schema, multi_line)
    return raw.select(
        F.col("user_id"),
        F.col("recipe_id").alias("item_id"),
        F.try_to_timestamp(F.col("date").cast("string")).alias("date_time"),
        F.col("rating").cast("double").alias("rating"),
    )


def read_items_csv(spark: SparkSession, path: str, schema: T.StructType | None = ITEMS_SCHEMA, multi_line: bool = True) -> DataFrame:
    """Item table from CSV with free-text columns, which may hold line breaks; ``id`` becomes ``item_id``, bad ``submitted`` dates become null."""
    raw = _csv(spark, path, schema, multi_line).withColumnRenamed("id", "item_id")
    if "submitted" in raw.columns:
        raw = raw.withColumn("submitted", F.try_to_timestamp(F.col("submitted").cast("string")))
    return raw


def read_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run rows to the CSV run log; every part file carries its header."""
    runs.coalesce(1).write.mode("append").option("header", True).csv(path)
