"""Reciprocal-rank blend of a factor model and the content model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import drop_seen, rank_by_score, top_k
from ..session import in_tasks
from .base import Recommender, TrainSet

# Highest weight of the factor model for sparse users under the adaptive rule.
SPARSE_ALPHA = 0.3


def pool_size(k: int) -> int:
    return max(5 * k, 50)


def merge_pools(first: DataFrame, second: DataFrame, rows: int = 0) -> DataFrame:
    """Full outer merge to ``(user_id, item_id, rr_first, rr_second)``, reciprocal ranks with 0 where missing.

    The rows, ``rows`` of them at most, are dealt by user once, a bounded number to a task: the sums here, and a window by user behind
    them, need no further shuffle.
    """
    rank, none = 1.0 / F.col("rank"), F.lit(0.0)
    both = first.select("user_id", "item_id", rank.alias("rr_first"), none.alias("rr_second")).unionByName(
        second.select("user_id", "item_id", none.alias("rr_first"), rank.alias("rr_second"))
    )
    dealt = in_tasks(both, rows, "user_id")
    return dealt.groupBy("user_id", "item_id").agg(F.max("rr_first").alias("rr_first"), F.max("rr_second").alias("rr_second"))


class Hybrid:
    def __init__(
        self, factor_model: Recommender, content_model: Recommender, alpha: float = 0.5, adaptive: bool = False,
        sparse_threshold: int = 5,
    ):
        self.factor_model = factor_model
        self.content_model = content_model
        self.alpha = alpha
        self.adaptive = adaptive
        self.sparse_threshold = sparse_threshold

    def fit(self, train: TrainSet) -> Hybrid:
        self.train = train
        return self

    def pools(self, users: DataFrame, k: int) -> DataFrame:
        size = pool_size(k)
        lists = (m.recommend_all(users, size) for m in (self.factor_model, self.content_model))
        merged = merge_pools(*lists, rows=2 * size * users.count())
        if all(self._keeps_to_unseen(m) for m in (self.factor_model, self.content_model)):
            return merged
        return drop_seen(merged, self.train.history)

    def _keeps_to_unseen(self, model: Recommender) -> bool:
        """Whether the model says that it lists nothing its users have seen in this very train set."""
        return getattr(model, "lists_unseen", False) and getattr(model, "train", None) is self.train

    def _alpha(self, alpha: Column) -> Column:
        if not self.adaptive:
            return alpha
        sparse = F.coalesce("n_rows", F.lit(0)) <= self.sparse_threshold
        return F.when(sparse, F.least(alpha, F.lit(SPARSE_ALPHA))).otherwise(alpha)

    def _blend(self, pools: DataFrame, alpha: Column) -> DataFrame:
        if self.adaptive:
            pools = pools.join(self.train.user_sizes, "user_id", "left")
        a = self._alpha(alpha)
        return pools.withColumn("score", a * F.col("rr_first") + (1 - a) * F.col("rr_second"))

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        return rank_by_score(self._blend(self.pools(users, k), F.lit(float(self.alpha))), k)

    def sweep(self, users: DataFrame, k: int, alphas: tuple[float, ...] = (0.3, 0.5, 0.7, 0.9)) -> DataFrame:
        """Lists for several weights from one pair of pools: ``(alpha, user_id, item_id, rank, score)``."""
        pools = self.pools(users, k).withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
        scored = self._blend(pools, F.col("alpha")).withColumn("score", F.round("score", 10))
        ranked = top_k(scored, k, [F.desc("score"), F.asc("item_id")], ["alpha", "user_id"])
        return ranked.select("alpha", "user_id", "item_id", "rank", "score")


class FixedLists:
    """A model whose lists are given as a table ``(user_id, item_id, rank)``, for blending stored lists."""

    def __init__(self, lists: DataFrame):
        self.lists = lists

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        return self.lists.filter(F.col("rank") <= k).join(users, "user_id", "left_semi")
