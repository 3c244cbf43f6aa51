"""Random walk with restart on the user-item graph, as expected visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import sparse_top_k
from ..operators.pairs import LONG_HISTORY, mirrored, shared_user_sums
from ..session import durable
from .base import TrainSet


class PersonalizedPageRank:
    """Items ranked by the expected number of visits of ``n_walks`` walks of ``max_steps`` steps.

    Each step restarts at the user with probability alpha (the step is used up) or moves to a uniform neighbour. After
    d moves since the last restart the walker's item distribution does not depend on when that was, so visits are

        sum over odd d of  g_d(i) · (1 - alpha)^d · (1 + alpha · (T - d)),

    with g_1 uniform over the history and g_{d+2} = g_d M, where M_ji averages 1/|H(v)| over the users v of item j.
    """

    def __init__(self, alpha: float = 0.15, max_steps: int = 3, n_walks: int = 200, long_history: int = LONG_HISTORY):
        self.alpha = alpha
        self.max_steps = max_steps
        self.n_walks = n_walks
        self.long_history = long_history

    def item_steps(self, train: TrainSet) -> DataFrame:
        """M as ``(item_i, item_j, p)``: from an item over one of its users to an item of that user."""
        edges = train.history.join(train.user_sizes.select("user_id", (1.0 / F.col("n_seen")).alias("w")), "user_id")
        weighted = edges.select("user_id", "item_id", F.col("w").alias("a"), F.lit(1.0).alias("b"))
        sums = mirrored(shared_user_sums(weighted, train.max_history, train.n_items, self.long_history))
        if self.max_steps > 3:
            own = edges.groupBy("item_id").agg(F.sum("w").alias("v"))
            sums = sums.unionByName(own.select(F.col("item_id").alias("item_i"), F.col("item_id").alias("item_j"), "v"))
        fans = train.history.groupBy(F.col("item_id").alias("item_i")).agg(F.count(F.lit(1)).alias("fans"))
        return sums.join(fans, "item_i").select("item_i", "item_j", (F.col("v") / F.col("fans")).alias("p"))

    def fit(self, train: TrainSet, steps: DataFrame | None = None) -> PersonalizedPageRank:
        self.train = train
        self.steps = steps
        if steps is None and self.max_steps >= 3:
            self.steps = durable(self.item_steps(train))
        return self

    def _weight(self, d: int) -> float:
        return self.n_walks * (1 - self.alpha) ** d * (1 + self.alpha * (self.max_steps - d))

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        """The last hop, from a user's item distribution to unseen items, is a block product with the top-k inside it.

        With ``max_steps`` up to 4 that is the only hop. For longer walks the hops M, M², ... are summed per item
        first, as ``sum over d of weight(d) · M^((d - 1) / 2)``.
        """
        seen = self.train.history.join(users, "user_id", "left_semi")
        sizes = self.train.user_sizes.select("user_id", (1.0 / F.col("n_seen")).alias("w"))
        mine = seen.join(sizes, "user_id").select("user_id", F.col("item_id").alias("term_id"), "w")
        depths = range(3, self.max_steps + 1, 2)
        if not depths:
            recs = mine.select("user_id", F.col("term_id").alias("item_id"), F.lit(1).alias("rank"), F.lit(0.0).alias("score"))
            return self.train.fill_with_popularity(recs.limit(0), users, k)
        power, total = self.steps, self.steps.withColumn("p", F.col("p") * F.lit(self._weight(3)))
        for d in depths[1:]:
            a, b = power.alias("a"), self.steps.alias("b")
            power = durable(
                a.join(b, F.col("a.item_j") == F.col("b.item_i"))
                .groupBy(F.col("a.item_i").alias("item_i"), F.col("b.item_j").alias("item_j"))
                .agg(F.sum(F.col("a.p") * F.col("b.p")).alias("p"))
            )
            total = total.unionByName(power.withColumn("p", F.col("p") * F.lit(self._weight(d))))
        if len(depths) > 1:
            total = total.groupBy("item_i", "item_j").agg(F.sum("p").alias("p"))
        columns = total.select(F.col("item_j").alias("item_id"), F.col("item_i").alias("term_id"), F.col("p").alias("w"))
        t = self.train
        entries = (t.n_rows, self.steps.count())
        recs = sparse_top_k(mine, columns, seen, k, t.n_users, t.n_items, t.max_history, entries)
        return self.train.fill_with_popularity(recs, users, k)
