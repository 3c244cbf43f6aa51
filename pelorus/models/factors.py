"""Matrix factorisation: biased squared loss and Bayesian personalised ranking.

An epoch is a fixed number of batches, chosen by hash. In a batch, blocks of (user, item, negative) rows receive exactly the
factor rows they use and return gradient sums; these are added up per id over all blocks (map-side combined), and every
factor row takes one step. The sums are exact, so factors depend neither on the size or number of blocks nor on the
cores. A step is ``learning rate * gradient sum``, shortened where an id has so many rows that the curvature sum
would make it overshoot. Factor tables never visit the driver; superseded ones are deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dot
from ..operators.negatives import negatives
from ..operators.prepare import UNKNOWN_NAME
from ..operators.pruned import dense_top_k
from ..session import discard, durable
from .base import TrainSet
from .strata import train_epoch


def initial_factors(ids: DataFrame, k: int, seed: int) -> DataFrame:
    """``(id, factors, bias)``: normal with scale 1/k from a hash of (id, dimension, seed), zero bias."""

    def uniform(d: Column, salt: int) -> Column:
        return (F.pmod(F.xxhash64(F.col("id"), d, F.lit(seed), F.lit(salt)), F.lit(1 << 52)) + 1) / F.lit(float((1 << 52) + 1))

    def normal(d: Column) -> Column:
        return F.sqrt(F.log(uniform(d, 1)) * -2.0) * F.cos(uniform(d, 2) * (2 * pi)) / k

    return ids.select("id", F.transform(F.sequence(F.lit(1), F.lit(k)), normal).alias("factors"), F.lit(0.0).alias("bias"))


def _bpr_sums(rows, P, Q, bu, bi, reg):
    """Gradient and curvature sums of the pairwise loss: ``(user sums, item sums)``, each (factors, bias, their curvatures).

    The multiplier of a pair is 1 - sigmoid of its score difference, whose slope is at most 1/4.
    """
    u, i, j, m = rows
    pu, qi, qj = P[u], Q[i], Q[j]
    x = bi[i] - bi[j] + np.einsum("nd,nd->n", pu, qi - qj)
    g = 1.0 - 1.0 / (1.0 + np.exp(np.clip(-x, -20, 20)))
    gm = (g * m)[:, None]
    users = _sums(len(P), [(u, gm * (qi - qj) - reg * m[:, None] * pu, 0.0 * m, m * (np.einsum("nd,nd->n", qi - qj, qi - qj) / 4 + reg), 0.0 * m)])
    bend = m * (np.einsum("nd,nd->n", pu, pu) / 4 + reg)
    items = _sums(
        len(Q),
        [
            (i, gm * pu - reg * m[:, None] * qi, m * (g - reg * bi[i]), bend, m * (0.25 + reg)),
            (j, -gm * pu - reg * m[:, None] * qj, m * (-g - reg * bi[j]), bend, m * (0.25 + reg)),
        ],
    )
    return users, items


def _squared_sums(rows, P, Q, bu, bi, reg):
    """Gradient and curvature sums of the squared error of ``(user, item, label)`` rows."""
    u, i, label, m = rows
    pu, q = P[u], Q[i]
    e = label - (bu[u] + bi[i] + np.einsum("nd,nd->n", pu, q))
    em, one = (e * m)[:, None], m * (1 + reg)
    users = _sums(len(P), [(u, em * q - reg * m[:, None] * pu, m * (e - reg * bu[u]), m * (np.einsum("nd,nd->n", q, q) + reg), one)])
    items = _sums(len(Q), [(i, em * pu - reg * m[:, None] * q, m * (e - reg * bi[i]), m * (np.einsum("nd,nd->n", pu, pu) + reg), one)])
    return users, items


def _sums(size: int, parts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    width = parts[0][1].shape[1]
    out = np.zeros((size, width)), np.zeros(size), np.zeros(size), np.zeros(size)
    for at, *values in parts:
        for total, value in zip(out, values, strict=True):
            np.add.at(total, at, value)
    return out


_SUMS = {"bpr": _bpr_sums, "squared": _squared_sums}


def _block_kernel(objective: str, k: int, reg: float) -> Callable:
    sums = _SUMS[objective]
    names = [f"f{d}" for d in range(k)]

    def unpack(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = rows.sort_values("id")
        ids = rows["id"].to_numpy("int64")
        factors = np.stack(rows["factors"].to_list()) if len(rows) else np.zeros((0, k))
        return ids, factors.astype("float64"), rows["bias"].to_numpy("float64")

    def kernel(rows: pd.DataFrame, params: pd.DataFrame) -> pd.DataFrame:
        uid, P, bu = unpack(params[params["kind"] == "user"])
        iid, Q, bi = unpack(params[params["kind"] == "item"])
        u = np.searchsorted(uid, rows["user_id"].to_numpy("int64"))
        i = np.searchsorted(iid, rows["item_id"].to_numpy("int64"))
        other = np.searchsorted(iid, rows["other"].to_numpy("int64")) if objective == "bpr" else rows["other"].to_numpy("float64")
        found = sums((u, i, other, rows["m"].to_numpy("float64")), P, Q, bu, bi, reg)
        out = []
        for kind, ids, (f, b, h, hb) in (("user", uid, found[0]), ("item", iid, found[1])):
            part = pd.DataFrame(f, columns=names)
            part.insert(0, "kind", kind)
            part.insert(1, "id", ids)
            out.append(part.assign(bias=b, h=h, hb=hb))
        return pd.concat(out)

    return kernel


def _with_block(rows: DataFrame, train: TrainSet, rows_per_block: int) -> tuple[DataFrame, int]:
    """Rows of one user share a block, except for users with more rows than a block holds, which are spread."""
    cores = train.spark.sparkContext.defaultParallelism
    blocks = max(ceil(train.n_rows / rows_per_block), min(cores, ceil(train.n_rows / 4096)), 1)
    whole = F.pmod(F.xxhash64("user_id"), F.lit(blocks))
    if train.max_rows <= rows_per_block:
        return rows.withColumn("block", whole), blocks
    hot = train.user_sizes.filter(F.col("n_rows") > rows_per_block).select("user_id", F.lit(True).alias("hot"))
    spread = F.pmod(F.xxhash64("user_id", "item_id"), F.lit(blocks))
    marked = rows.join(hot, "user_id", "left")
    return marked.withColumn("block", F.when(F.col("hot"), spread).otherwise(whole)).drop("hot"), blocks


def _gradient_sums(
    rows: DataFrame, train: TrainSet, users: DataFrame, items: DataFrame, objective: str, k: int, reg: float, rows_per_block: int
) -> DataFrame:
    """``(kind, id, f0.., bias, h, hb)`` over all ``rows (user_id, item_id, other, m)``; other is the negative or the label."""
    placed, blocks = _with_block(rows, train, rows_per_block)
    placed = durable(placed.select("block", "user_id", "item_id", "other", "m"))
    block = F.col("block").alias("block")  # a new attribute, so that both sides of the cogroup stay distinct
    need_user = placed.select(block, F.lit("user").alias("kind"), F.col("user_id").alias("id"))
    used = F.explode(F.array("item_id", "other")) if objective == "bpr" else F.col("item_id")
    need_item = placed.select(block, F.lit("item").alias("kind"), used.alias("id"))
    table = users.withColumn("kind", F.lit("user")).unionByName(items.withColumn("kind", F.lit("item")))
    params = need_user.unionByName(need_item).distinct().join(table, ["kind", "id"])
    fields = "".join(f", f{d} double" for d in range(k))
    parts = (
        placed.repartition(blocks, "block")
        .groupBy("block")
        .cogroup(params.repartition(blocks, "block").groupBy("block"))
        .applyInPandas(_block_kernel(objective, k, reg), f"kind string, id bigint{fields}, bias double, h double, hb double")
    )
    names = [*[f"f{d}" for d in range(k)], "bias", "h", "hb"]
    summed = durable(parts.groupBy("kind", "id").agg(*[F.sum(c).alias(c) for c in names]))
    discard(placed)
    return summed


def _stepped(table: DataFrame, sums: DataFrame, kind: str, k: int, lr: float) -> DataFrame:
    """``table`` after one step along ``sums``, no longer than the curvature allows."""
    def step(name: str, bend: str) -> Column:
        return F.col(name) * lr / F.greatest(F.lit(1.0), F.col(bend) * lr)

    moves = sums.filter(F.col("kind") == kind).select(
        "id", F.array(*[step(f"f{d}", "h") for d in range(k)]).alias("d"), step("bias", "hb").alias("db")
    )
    added = F.zip_with("factors", "d", lambda a, b: a + b)
    return table.join(moves, "id", "left").select(
        "id",
        F.when(F.col("d").isNull(), F.col("factors")).otherwise(added).alias("factors"),
        (F.col("bias") + F.coalesce("db", F.lit(0.0))).alias("bias"),
    )


def sgd_round(
    triples: DataFrame, train: TrainSet, users: DataFrame, items: DataFrame, objective: str, k: int,
    lr: float, reg: float, rows_per_block: int = 65_536,
) -> tuple[DataFrame, DataFrame]:
    """One batch ``triples (user_id, item_id, negative, m)``; returns the moved ``(id, factors, bias)`` tables, written.

    The squared loss reads a positive as label 1 and its negative as label 0; both step from the same factors.
    """
    if objective == "bpr":
        rows = triples.withColumnRenamed("negative", "other")
    else:
        up = triples.select("user_id", "item_id", F.lit(1.0).alias("other"), "m")
        rows = up.unionByName(triples.select("user_id", F.col("negative").alias("item_id"), F.lit(0.0).alias("other"), "m"))
    sums = _gradient_sums(rows, train, users, items, objective, k, reg, rows_per_block)
    moved = durable(_stepped(users, sums, "user", k, lr)), durable(_stepped(items, sums, "item", k, lr))
    discard(sums)
    return moved


class FactorModel:
    """Given factor tables: lists, pair scores, popularity-debiased lists."""

    # Users' biases add the same amount to all of a user's scores.
    user_bias = False
    lists_unseen = True

    def __init__(self, popularity_penalty_beta: float = 0.0):
        self.popularity_penalty_beta = popularity_penalty_beta

    def with_factors(self, train: TrainSet, users: DataFrame, items: DataFrame) -> FactorModel:
        """``users`` and ``items`` are ``(id, factors, bias)``."""
        self.train, self.users, self.items = train, users, items
        return self

    def debiased(self, beta: float) -> FactorModel:
        """The same factors with ``beta · log(1 + count)`` taken off every item's score."""
        return FactorModel(beta).with_factors(self.train, self.users, self.items)

    def vectors(self, users: DataFrame) -> tuple[DataFrame, DataFrame]:
        """User and item vectors whose inner product is the ranking score."""
        mine = self.users.join(users.select(F.col("user_id").alias("id")), "id", "left_semi")
        extra = [F.lit(1.0), F.coalesce("bias", F.lit(0.0))] if self.user_bias else [F.lit(1.0)]
        left = mine.select(F.col("id").alias("user_id"), F.concat("factors", F.array(*extra)).alias("vec"))
        bias, items = F.col("bias"), self.items
        if self.popularity_penalty_beta > 0:
            counts = self.train.item_counts.withColumnRenamed("item_id", "id")
            items = items.join(counts, "id", "left")
            bias = bias - self.popularity_penalty_beta * F.log1p(F.coalesce("n_rows", F.lit(0)))
        tail = F.array(bias, F.lit(1.0)) if self.user_bias else F.array(bias)
        return left, items.select(F.col("id").alias("item_id"), F.concat("factors", tail).alias("vec"))

    def recommend_scored(self, users: DataFrame, k: int) -> DataFrame:
        left, right = self.vectors(users)
        seen = self.train.history.join(users, "user_id", "left_semi")
        return dense_top_k(left, right, seen, k, self.train.n_users, self.train.n_items)

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        """Unseen items by score; users without factors get popular items."""
        return self.train.fill_with_popularity(self.recommend_scored(users, k), users, k)

    def score_pairs(self, pairs: DataFrame) -> DataFrame:
        """``factors · factors + item bias`` per pair, 0 where the user or the item is unknown."""
        u = self.users.select(F.col("id").alias("user_id"), F.col("factors").alias("_p"))
        i = self.items.select(F.col("id").alias("item_id"), F.col("factors").alias("_q"), F.col("bias").alias("_b"))
        joined = pairs.join(u, "user_id", "left").join(i, "item_id", "left")
        return joined.select(*pairs.columns, F.coalesce(dot(F.col("_p"), F.col("_q")) + F.col("_b"), F.lit(0.0)).alias("score"))

    def top_bias(self, names: DataFrame, n: int = 5) -> DataFrame:
        """The items with the largest bias, with their names."""
        best = self.items.orderBy(F.desc("bias"), F.asc("id")).limit(n).select(F.col("id").alias("item_id"), "bias")
        return best.join(names, "item_id", "left").withColumn("name", F.coalesce("name", F.lit(UNKNOWN_NAME)))


class _Trained(FactorModel):
    objective = "bpr"

    def __init__(
        self, k_factors: int = 16, learning_rate: float = 0.05, reg: float = 0.01, epochs: int = 10,
        popularity_penalty_beta: float = 0.0, seed: int = 42, batches: int = 2, rows_per_block: int = 65_536, strata: int | None = None,
    ):
        """``batches`` exact steps per epoch; ``rows_per_block`` bounds a task's rows and does not change the result. With ``strata``,
        an epoch instead takes many small steps in that many strata of blocks, see `strata`."""
        super().__init__(popularity_penalty_beta)
        self.k_factors = k_factors
        self.learning_rate = learning_rate
        self.reg = reg
        self.epochs = epochs
        self.seed = seed
        self.batches = batches
        self.rows_per_block = rows_per_block
        self.strata = strata

    def fit(self, train: TrainSet) -> FactorModel:
        self.train = train
        users = durable(initial_factors(train.user_sizes.select(F.col("user_id").alias("id")), self.k_factors, self.seed))
        items = durable(initial_factors(train.item_counts.select(F.col("item_id").alias("id")), self.k_factors, self.seed + 1))
        if self.strata:
            return self._fit_strata(train, users, items)
        for epoch in range(self.epochs):
            triples = durable(negatives(train, train.item_index, epoch))
            batch = F.pmod(F.xxhash64("user_id", "item_id", F.lit(self.seed + epoch)), F.lit(self.batches))
            for number in range(self.batches):
                old = users, items
                users, items = sgd_round(
                    triples.filter(batch == number), train, users, items, self.objective, self.k_factors, self.learning_rate,
                    self.reg, self.rows_per_block,
                )
                for table in old:
                    discard(table)
            discard(triples)
        return self.with_factors(train, users, items)

    def _fit_strata(self, train: TrainSet, users: DataFrame, items: DataFrame) -> FactorModel:
        sums, pairwise = _SUMS[self.objective], self.objective == "bpr"
        for epoch in range(self.epochs):
            old = users, items
            users, items = train_epoch(
                train.pairs, users, items, sums, pairwise, self.k_factors, self.learning_rate, self.reg, self.strata, epoch, self.seed
            )
            for table in old:
                discard(table)
        return self.with_factors(train, users, items)

    @property
    def hyperparams(self) -> str:
        return f"k_factors={self.k_factors}, epochs={self.epochs}, reg={self.reg}"


class BPR(_Trained):
    """Bayesian personalised ranking: one sampled unseen item per positive, pairwise loss."""


class BiasedMF(_Trained):
    """Squared loss with user and item biases; label 1 for positives, 0 for one sampled unseen item each."""

    objective = "squared"
    user_bias = True
