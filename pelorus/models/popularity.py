"""Non-personalised recommenders: popularity, trending, random."""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prepare import require_columns
from ..operators.ranking import free_positions, unseen_in_order
from .base import TrainSet


class Popularity:
    """Items by number of train rows, ties by id."""

    def fit(self, train: TrainSet) -> Popularity:
        self.train = train
        return self

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        unseen = self.train.popular_unseen(users, k)
        return unseen.select("user_id", "item_id", "rank", F.col("n_rows").cast("double").alias("score"))


class Trending:
    """Items by number of rows in the last ``days_window`` days, then by all-time popularity."""

    def __init__(self, days_window: int = 30, time_col: str = "date_time"):
        self.days_window = days_window
        self.time_col = time_col

    def fit(self, train: TrainSet) -> Trending:
        require_columns(train.train, [self.time_col], "Trending")
        self.train = train
        rows = train.train
        cutoff = rows.agg((F.max(self.time_col) - F.expr(f"INTERVAL {int(self.days_window)} DAYS")).alias("t"))
        recent = (F.col(self.time_col) >= cutoff.scalar()).cast("long")
        self.order = rows.groupBy("item_id").agg(
            F.coalesce(F.sum(recent), F.lit(0)).alias("n_recent"), F.count(F.lit(1)).alias("n_rows")
        )
        return self

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        # Recent items come first by recent count and id; the rest follows by all-time count and id.
        older = F.when(F.col("n_recent") > 0, F.lit(0)).otherwise(F.col("n_rows"))
        unseen = unseen_in_order(
            self.order,
            [F.desc("n_recent"), F.desc(older), F.asc("item_id")],
            self.train.n_items,
            users,
            self.train.history,
            k,
            self.train.max_history,
            self.train.seen_limit,
        )
        return unseen.select("user_id", "item_id", "rank", F.col("n_recent").cast("double").alias("score"))


class Random:
    """k unseen train items per user, drawn by a seeded affine permutation of the item index.

    A user's permutation places item index x at position inverse(a)·(x - b) mod n, so a seen item's position is
    arithmetic on its own row and nothing is drawn, sorted or shuffled per (user, item).
    """

    # Multipliers tried in turn; the first one coprime to the number of items is used.
    _MULTIPLIERS = (7919, 104729, 1299709, 15485863)

    def __init__(self, random_state: int = 0):
        self.random_state = random_state

    def fit(self, train: TrainSet, index: DataFrame | None = None) -> Random:
        self.train = train
        self.n = train.n_items
        self.index = train.item_index if index is None else index
        self.a = next((m for m in self._MULTIPLIERS if gcd(m, self.n) == 1), 1)
        return self

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        n = max(self.n, 1)
        inverse = pow(self.a, -1, n) if n > 1 else 0
        offset = F.pmod(F.pmod(F.col("user_id"), F.lit(n)) * 48271 + F.lit(self.random_state), F.lit(n))
        at = F.pmod(F.pmod(F.col("idx") - offset, F.lit(n)) * F.lit(inverse), F.lit(n)) + 1
        seen = self.train.history.join(self.index, "item_id").select("user_id", at.alias("pos"))
        free = free_positions(users, seen, k, n, self.train.max_history, seen, self.train.seen_limit)
        drawn = F.pmod((F.col("pos") - 1) * F.lit(self.a) + offset, F.lit(n))
        return free.withColumn("idx", drawn).join(self.index, "idx").select(
            "user_id", "item_id", "rank", F.lit(0.0).alias("score")
        )
