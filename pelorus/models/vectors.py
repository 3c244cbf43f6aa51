"""Inner-product retrieval over factor vectors, exact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dot, l2_normalize
from ..operators.pruned import dense_top_k
from .base import TrainSet
from .factors import FactorModel


class VectorRetriever:
    """Candidates by inner product of prepared vectors.

    ``include_item_bias`` appends a dimension (1 for users, the bias for items); ``normalize`` makes it a cosine.
    """

    lists_unseen = True

    def __init__(self, include_item_bias: bool = True, normalize: bool = False, fallback_to_popularity: bool = True):
        self.include_item_bias = include_item_bias
        self.normalize = normalize
        self.fallback_to_popularity = fallback_to_popularity

    def fit(self, model: FactorModel) -> VectorRetriever:
        missing = [a for a in ("train", "users", "items") if not hasattr(model, a)]
        if missing:
            raise ValueError(f"Factor model is not fitted, missing: {missing}")
        return self.with_vectors(model.train, model.users, model.items)

    def with_vectors(self, train: TrainSet, users: DataFrame, items: DataFrame) -> VectorRetriever:
        self.train = train
        self.user_vectors = self._prepare(users, F.lit(1.0)).withColumnRenamed("id", "user_id")
        self.item_vectors = self._prepare(items, F.col("bias")).withColumnRenamed("id", "item_id")
        return self

    def _prepare(self, table: DataFrame, extra) -> DataFrame:
        vec = F.col("factors").cast("array<double>")
        if self.include_item_bias and "bias" in table.columns:
            vec = F.concat(vec, F.array(extra))
        table = table.select("id", vec.alias("vec"))
        return table.select("id", l2_normalize(F.col("vec")).alias("vec")) if self.normalize else table

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        mine = self.user_vectors.join(users, "user_id", "left_semi")
        seen = self.train.history.join(users, "user_id", "left_semi")
        recs = dense_top_k(mine, self.item_vectors, seen, k, self.train.n_users, self.train.n_items)
        return self.train.fill_with_popularity(recs, users, k) if self.fallback_to_popularity else recs

    def score_pairs(self, pairs: DataFrame) -> DataFrame:
        """Inner product in the retrieval geometry, 0 where the user or the item is unknown."""
        u = self.user_vectors.withColumnRenamed("vec", "_u")
        i = self.item_vectors.withColumnRenamed("vec", "_i")
        joined = pairs.join(u, "user_id", "left").join(i, "item_id", "left")
        return joined.select(*pairs.columns, F.coalesce(dot(F.col("_u"), F.col("_i")), F.lit(0.0)).alias("score"))


def nearest_items(items: DataFrame, anchor: DataFrame, n: int = 5) -> DataFrame:
    """Cosine neighbours of one anchor item: ``items (id, factors)``, ``anchor`` one row ``(id)``."""
    unit = items.select("id", l2_normalize(F.col("factors").cast("array<double>")).alias("vec"))
    target = unit.join(anchor.select("id"), "id").agg(F.first("vec").alias("v"), F.first("id").alias("a"))
    near = unit.withColumn("_v", target.select("v").scalar()).filter(F.col("id") != target.select("a").scalar())
    scored = near.select(F.col("id").alias("item_id"), F.round(dot(F.col("vec"), F.col("_v")), 10).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), F.asc("item_id")).limit(n)
