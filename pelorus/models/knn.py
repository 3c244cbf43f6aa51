"""Item-item neighbourhood model with shrinkage and explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import sparse_top_k
from ..operators.pairs import LONG_HISTORY, mirrored, shared_user_sums
from ..operators.ranking import top_k
from ..session import durable
from .base import TrainSet

# Explanation texts: fixed formats.
COLD_TEXT = "Recommended due to general popularity (Cold Start)."
POPULAR_TEXT = "Recommended due to general popularity."
SIMILAR_TEXT = "Recommended because it is similar to a previously liked recipe (recipe_id=%d)."


class ItemKNN:
    """Cosine of item count columns, shrunk by co-count, pruned to ``k_neighbors`` per item."""

    def __init__(
        self, k_neighbors: int = 100, shrinkage: float = 10, dedupe: bool = False, long_history: int = LONG_HISTORY
    ):
        self.k_neighbors = k_neighbors
        self.shrinkage = shrinkage
        self.dedupe = dedupe
        self.long_history = long_history

    def similarities(self, train: TrainSet) -> DataFrame:
        """``(item_i, item_j, sim, rank)``: the neighbours of every item."""
        pairs = train.pairs.select("user_id", "item_id", F.lit(1.0).alias("m") if self.dedupe else F.col("m").cast("double").alias("m"))
        norms = pairs.groupBy("item_id").agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("norm"))
        weighted = pairs.select("user_id", "item_id", F.col("m").alias("a"), F.col("m").alias("b"))
        half = shared_user_sums(weighted, train.max_history, train.n_items, self.long_history)
        # Norms are joined to the summed pairs; the sums are already one row per item pair.
        for side in ("item_i", "item_j"):
            half = half.join(norms.select(F.col("item_id").alias(side), F.col("norm").alias(f"norm_{side[-1]}")), side)
        sim = F.col("v") / (F.col("norm_i") * F.col("norm_j"))
        if self.shrinkage > 0:
            sim = sim * (F.col("v") / (F.col("v") + F.lit(float(self.shrinkage))))
        both = mirrored(half.select("item_i", "item_j", F.round(sim, 10).alias("v")))
        both = both.withColumnRenamed("v", "sim").filter("sim > 0")
        return top_k(both, self.k_neighbors, [F.desc("sim"), F.asc("item_j")], ["item_i"])

    def fit(self, train: TrainSet, similarities: DataFrame | None = None) -> ItemKNN:
        self.train = train
        self.sim = durable(self.similarities(train)) if similarities is None else similarities
        return self

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        """History times similarity as a block product, so candidates are cut to k before they leave a task."""
        seen = self.train.history.join(users, "user_id", "left_semi")
        mine = seen.select("user_id", F.col("item_id").alias("term_id"), F.lit(1.0).alias("w"))
        columns = self.sim.select(F.col("item_j").alias("item_id"), F.col("item_i").alias("term_id"), F.col("sim").alias("w"))
        t = self.train
        entries = (t.n_rows, t.n_items * self.k_neighbors)
        recs = sparse_top_k(mine, columns, seen, k, t.n_users, t.n_items, t.max_history, entries)
        return self.train.fill_with_popularity(recs, users, k)

    def explain_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        """The lists of :meth:`recommend_all` with a reason for every row: the history item most similar to it.

        Only the k listed items meet the history, never all candidates.
        """
        lists = durable(self.recommend_all(users, k))
        listed = lists.filter("score IS NOT NULL").select("user_id", "item_id")
        liked = self.train.history.withColumnRenamed("item_id", "item_i")
        close = self.sim.select("item_i", F.col("item_j").alias("item_id"), "sim")
        best = F.max_by("item_i", F.struct("sim", -F.col("item_i"))).alias("because")
        reasons = listed.join(liked, "user_id").join(close, ["item_i", "item_id"]).groupBy("user_id", "item_id").agg(best)
        known = self.train.history.select("user_id").distinct().withColumn("known", F.lit(True))
        text = (
            F.when(F.col("because").isNotNull(), F.format_string(SIMILAR_TEXT, F.col("because")))
            .when(F.col("known"), F.lit(POPULAR_TEXT))
            .otherwise(F.lit(COLD_TEXT))
        )
        joined = lists.join(reasons, ["user_id", "item_id"], "left").join(known, "user_id", "left")
        return joined.select("user_id", "item_id", "rank", text.alias("explanation"))
