"""Approximate inner-product retrieval over factor vectors by inverted cells."""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dot
from ..operators.cells import fit_centroids, probe_order, probed_top_k, with_cell
from ..operators.pruned import dense_top_k
from ..session import durable
from .base import TrainSet
from .vectors import VectorRetriever


class ApproximateRetriever(VectorRetriever):
    """The retriever's geometry with an index of inverted cells.

    Centres are fitted on at most ``sample_items`` items (those with the smallest hash of their id), about ``sqrt(items)`` of them and at most
    ``max_cells``; then every item is put into the cell of its nearest centre. Inner products become distances by one more dimension,
    ``sqrt(largest norm² - norm²)``, which is 0 for users. How many cells a user probes is set by measurement: exact
    lists of at most ``sample_users`` users must be found with a recall of ``target``.
    """

    def __init__(
        self, include_item_bias: bool = True, normalize: bool = False, fallback_to_popularity: bool = True, target: float = 0.95,
        sample_items: int = 20_000, sample_users: int = 256, max_cells: int = 4096,
    ):
        super().__init__(include_item_bias, normalize, fallback_to_popularity)
        self.target = target
        self.sample_items = sample_items
        self.sample_users = sample_users
        self.max_cells = max_cells

    def with_vectors(self, train: TrainSet, users: DataFrame, items: DataFrame) -> ApproximateRetriever:
        super().with_vectors(train, users, items)
        self.user_vectors, self.item_vectors = durable(self.user_vectors), durable(self.item_vectors)
        norm2 = dot(F.col("vec"), F.col("vec"))
        largest = self.item_vectors.agg(F.max(norm2)).first()[0] or 0.0
        wide = F.concat("vec", F.array(F.sqrt(F.greatest(F.lit(float(largest)) - norm2, F.lit(0.0)))))
        widened = self.item_vectors.select("item_id", wide.alias("vec"))
        sample = widened.orderBy(F.xxhash64("item_id"), "item_id").limit(self.sample_items).collect()
        rows = np.array([r["vec"] for r in sample], "float64").reshape(len(sample), -1) if sample else np.zeros((0, 1))
        cells = max(1, min(self.max_cells, ceil(sqrt(max(train.n_items, 1)))))
        self.centers = fit_centroids(rows, cells) if len(rows) else np.zeros((1, 1))
        cell_of = with_cell(widened, "item_id", self.centers).select("item_id", "cell")
        self.indexed = durable(cell_of.join(self.item_vectors, "item_id"))
        # One count per cell.
        self.counts = np.zeros(len(self.centers), "int64")
        for row in self.indexed.groupBy("cell").count().collect():
            self.counts[row["cell"]] = row["count"]
        self._probes: dict[int, int] = {}
        return self

    def n_probe(self, k: int) -> int:
        """Cells to probe for lists of ``k``: the fewest that find the sampled users' exact lists with the target recall."""
        if k not in self._probes:
            some = durable(self.user_vectors.orderBy(F.xxhash64("user_id"), "user_id").limit(self.sample_users))
            seen = self.train.history.join(some.select("user_id"), "user_id", "left_semi")
            exact = dense_top_k(some, self.item_vectors, seen, k, self.sample_users, self.train.n_items)
            # At most sample_users * k rows.
            wanted = exact.join(self.indexed.select("item_id", "cell"), "item_id").select("user_id", "cell").collect()
            vectors = {r["user_id"]: r["vec"] for r in some.collect()}
            users = {u: n for n, u in enumerate(vectors)}
            needed = np.zeros(0, "int64")
            if wanted:
                place = np.argsort(probe_order(np.array(list(vectors.values())), self.centers), axis=1)
                needed = np.sort(place[[users[r["user_id"]] for r in wanted], [r["cell"] for r in wanted]]) + 1
            self._probes[k] = int(needed[max(0, ceil(self.target * len(needed)) - 1)]) if len(needed) else 1
        return self._probes[k]

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        mine = self.user_vectors.join(users, "user_id", "left_semi")
        seen = self.train.history.join(users, "user_id", "left_semi")
        recs = probed_top_k(mine, self.indexed, seen, k, self.train.n_users, self.centers, self.counts, self.n_probe(k))
        return self.train.fill_with_popularity(recs, users, k) if self.fallback_to_popularity else recs


def list_recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``(user_id, n, hits)``: how many of a user's exact items the other list holds."""
    keys = ["user_id", "item_id"]
    marked = exact.select(*keys).join(found.select(*keys, F.lit(1).alias("hit")), keys, "left")
    return marked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"))
