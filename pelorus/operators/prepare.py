"""Data preparation: positives, user activity filter, metadata join, de-duplication."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value.
UNKNOWN_NAME = "Unknown Recipe"


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns for {what}: {missing}")


def coerce_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Strings to timestamps, null where they do not parse."""
    require_columns(df, [column], "coerce_timestamp")
    return df.withColumn(column, F.try_to_timestamp(F.col(column).cast("string")))


def positives(interactions: DataFrame, threshold: float = 4.0) -> DataFrame:
    require_columns(interactions, ["rating"], "positives")
    return interactions.filter(F.col("rating") >= F.lit(threshold))


def active_users(df: DataFrame, min_rows: int = 2, user_col: str = "user_id") -> DataFrame:
    """Rows of users with at least ``min_rows`` rows.

    The counts are combined on the map side; the semi join reads one row per user on its right, so that adaptive
    execution can split the partition of a hot user on its left.
    """
    enough = df.groupBy(user_col).count().filter(F.col("count") >= min_rows).select(user_col)
    return df.join(enough, user_col, "left_semi")


def join_items(interactions: DataFrame, items: DataFrame, item_col: str = "item_id") -> DataFrame:
    return interactions.join(items, item_col, "inner")


def modelling_frame(interactions: DataFrame, items: DataFrame, threshold: float = 4.0, min_rows: int = 2) -> DataFrame:
    """Positives of users with enough of them, joined to the item table."""
    return join_items(active_users(positives(interactions, threshold), min_rows), items)


def first_per_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key, the smallest in ``order`` and then in the remaining columns.

    A minimum over structs instead of a window: it combines on the map side, so copies of one key never meet in
    one task.
    """
    rest = list(order or []) + [c for c in df.columns if c != key and c not in (order or [])]
    best = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_first"))
    return best.select(*[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def with_item_names(items: DataFrame, item_col: str = "item_id") -> DataFrame:
    """``(item_id, name)``, one row per item, missing names filled."""
    unique = first_per_key(items.select(item_col, "name"), item_col)
    return unique.select(item_col, F.coalesce("name", F.lit(UNKNOWN_NAME)).alias("name"))


def top_items(train: DataFrame, n: int, item_col: str = "item_id") -> DataFrame:
    """The ``n`` most frequent items, ties by id, as ``(item_id, n_rows)``."""
    counts = train.groupBy(item_col).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), F.asc(item_col)).limit(n)


def restrict_to_top_items(train: DataFrame, n: int, item_col: str = "item_id") -> DataFrame:
    return train.join(top_items(train, n, item_col).select(item_col), item_col, "left_semi")
