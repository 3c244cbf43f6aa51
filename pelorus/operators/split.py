"""Temporal leave-last-out split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .prepare import require_columns


def _last_by_user(df: DataFrame, user_col: str, time_col: str) -> DataFrame:
    """``(user, _until, _n)``: the user's last time and how many rows share it.

    Two hash aggregations with map-side combining, first by (user, time), then by user: no task ever holds the rows of
    one user.
    """
    by_time = df.groupBy(user_col, time_col).agg(F.count(F.lit(1)).alias("_n"))
    return by_time.groupBy(user_col).agg(F.max(time_col).alias("_until"), F.max_by("_n", time_col).alias("_n"))


def tied_last_users(df: DataFrame, user_col: str = "user_id", time_col: str = "date_time") -> DataFrame:
    """Users whose latest time occurs more than once, with that count."""
    require_columns(df, [user_col, time_col], "split")
    last = _last_by_user(df.filter(F.col(time_col).isNotNull() & F.col(user_col).isNotNull()), user_col, time_col)
    return last.filter(F.col("_n") > 1).select(user_col, F.col("_n").alias("n_tied"))


def leave_last_out(
    df: DataFrame,
    user_col: str = "user_id",
    time_col: str = "date_time",
    tie_cols: tuple[str, ...] = ("item_id",),
    drop_tied_last: bool = True,
    written: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split into ``(train, test)``: each user's last row is the test row, all earlier rows are train.

    With ``drop_tied_last`` users whose latest time is shared by several rows are left out of both. Without it the
    order inside one time is ``tie_cols``, then the other columns. Rows without a user or a time are dropped first.
    ``written`` parts are stored: where ties are dropped the rows are joined to their users' last times, and written, once for both.
    """
    require_columns(df, [user_col, time_col, *tie_cols], "split")
    df = df.filter(F.col(time_col).isNotNull() & F.col(user_col).isNotNull())
    if drop_tied_last:
        # One row per user on the right of both joins, so a hot user's rows on the left can be split over tasks.
        last = _last_by_user(df, user_col, time_col).filter(F.col("_n") == 1).select(user_col, "_until")
        bounded = df.join(last, user_col)
        if written:
            bounded = durable(bounded)
        train = bounded.filter(F.col(time_col) < F.col("_until")).select(df.columns)
        test = bounded.filter(F.col(time_col) == F.col("_until")).select(df.columns)
        return train, test

    # Identical rows are interchangeable, so count them: the last one is the test row, its other copies are train.
    order = [time_col, *tie_cols]
    order += [c for c in df.columns if c not in (user_col, *order)]
    copies = df.groupBy(df.columns).agg(F.count(F.lit(1)).alias("_n"))
    last = copies.groupBy(user_col).agg(F.max(F.struct(*order)).alias("_last"))
    test = last.select(*[F.col(user_col) if c == user_col else F.col(f"_last.{c}").alias(c) for c in df.columns])
    is_last = F.struct(*order) == F.col("_last")
    kept = copies.join(last, user_col).withColumn("_n", F.col("_n") - F.when(is_last, 1).otherwise(0))
    train = kept.filter("_n > 0").select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    parts = train.drop("_copy"), test
    return tuple(map(durable, parts)) if written else parts


def leakage_violations(train: DataFrame, test: DataFrame, user_col: str = "user_id", time_col: str = "date_time") -> DataFrame:
    """How many test users there are, and how many of them have a train row at or after their test row."""
    last_train = train.groupBy(user_col).agg(F.max(time_col).alias("_last_train"))
    return test.join(last_train, user_col, "left").agg(
        F.count(F.lit(1)).alias("test_users"),
        F.coalesce(F.sum((F.col("_last_train") >= F.col(time_col)).cast("long")), F.lit(0)).alias("violations"),
    )
