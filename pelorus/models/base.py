"""What every recommender is fitted on, and the contract it fulfils."""

from __future__ import annotations

from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import global_index
from ..operators.prepare import require_columns
from ..operators.ranking import SEEN_LIMIT, fill_lists, unseen_in_order
from ..session import durable


class Recommender(Protocol):
    """``fit`` once, then rank for all given users in one plan."""

    def fit(self, train: TrainSet, *args) -> Recommender: ...

    def recommend_all(self, users: DataFrame, k: int) -> DataFrame:
        """``(user_id, item_id, rank, score)`` with at most k rows per user."""
        ...


class TrainSet:
    """Training interactions with the aggregates all models share.

    Tables stay distributed; only five counts reach the driver, in one job.
    """

    def __init__(self, train: DataFrame, seen_limit: int = SEEN_LIMIT, user_col: str = "user_id", item_col: str = "item_id"):
        """Columns named otherwise in ``train`` are renamed; tables and lists have ``user_id`` and ``item_id``."""
        require_columns(train, [user_col, item_col], "TrainSet")
        train = train.withColumnsRenamed({user_col: "user_id", item_col: "item_id"})
        self.train = train.filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
        self.spark = train.sparkSession
        self.seen_limit = seen_limit

    @cached_property
    def pairs(self) -> DataFrame:
        """``(user_id, item_id, m)``: distinct pairs with their number of rows, written once; all else reads it."""
        return durable(self.train.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("m")))

    @cached_property
    def history(self) -> DataFrame:
        return self.pairs.select("user_id", "item_id")

    @cached_property
    def item_counts(self) -> DataFrame:
        """``(item_id, n_rows)`` over all train rows."""
        return durable(self.pairs.groupBy("item_id").agg(F.sum("m").alias("n_rows")))

    @cached_property
    def user_sizes(self) -> DataFrame:
        """``(user_id, n_rows, n_seen)``: train rows and distinct items per user."""
        return durable(self.pairs.groupBy("user_id").agg(F.sum("m").alias("n_rows"), F.count(F.lit(1)).alias("n_seen")))

    @cached_property
    def item_index(self) -> DataFrame:
        """``(item_id, idx)``: train items numbered 0..n-1 by id."""
        return global_index(self.item_counts.select("item_id"), F.asc("item_id"))

    @cached_property
    def _counts(self) -> dict[str, int]:
        users = self.user_sizes.agg(
            F.count(F.lit(1)).alias("n_users"), F.max("n_seen").alias("max_history"),
            F.max("n_rows").alias("max_rows"), F.sum("n_rows").alias("n_rows"),
        )
        items = self.item_counts.agg(F.count(F.lit(1)).alias("n_items"))
        both = users.select("*", items.scalar().alias("n_items")).first()
        return {name: int(both[name] or 0) for name in both.asDict()}

    @property
    def n_users(self) -> int:
        return self._counts["n_users"]

    @property
    def n_items(self) -> int:
        return self._counts["n_items"]

    @property
    def n_rows(self) -> int:
        return self._counts["n_rows"]

    @property
    def max_history(self) -> int:
        """Most distinct items one user has seen."""
        return self._counts["max_history"]

    @property
    def max_rows(self) -> int:
        """Most rows of one user."""
        return self._counts["max_rows"]

    def popular_unseen(self, users: DataFrame, k: int, also_seen: DataFrame | None = None, extra: int = 0) -> DataFrame:
        """The k most popular items each user has not seen; ``also_seen`` adds at most ``extra`` pairs per user."""
        seen = self.history if also_seen is None else self.history.unionByName(also_seen.select("user_id", "item_id"))
        return unseen_in_order(
            self.item_counts,
            [F.desc("n_rows"), F.asc("item_id")],
            self.n_items,
            users,
            seen,
            k,
            self.max_history + extra,
            self.seen_limit,
        )

    def fill_with_popularity(self, recs: DataFrame, users: DataFrame, k: int) -> DataFrame:
        """Lists shorter than k, and users without a list, are completed with unseen popular items.

        The lists are written first: they are the costly part, at most k rows per user, and read by each step here.
        """
        recs = durable(recs.select("user_id", "item_id", "rank", "score"))
        sizes = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("have"))
        short = users.join(sizes, "user_id", "left").filter(F.coalesce("have", F.lit(0)) < k).select("user_id")
        if short.isEmpty():
            return recs.join(users, "user_id", "left_semi")
        listed = recs.join(short, "user_id", "left_semi")
        filler = self.popular_unseen(short, k, also_seen=listed, extra=k)
        return fill_lists(recs, users, filler, k)
