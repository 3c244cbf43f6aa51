"""Item-item sums over shared users."""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import rows_per_strip, sparse_strip

# Users with more distinct items than this go through blocks instead of the join.
LONG_HISTORY = 256
# Items per block, and rows of long histories per chunk of users.
_ITEM_BLOCK = 8192
_CHUNK_ROWS = 4_000_000


def shared_user_sums(
    pairs: DataFrame, max_history: int, n_items: int, long_history: int = LONG_HISTORY, item_block: int = _ITEM_BLOCK,
    chunk_rows: int = _CHUNK_ROWS,
) -> DataFrame:
    """``(item_i, item_j, v)`` for i < j: the sum over users of both of ``a(user, i) · b(user, j)``.

    ``pairs`` is ``(user_id, item_id, a, b)``, one row per pair, with ``a(u, i) b(u, j) = a(u, j) b(u, i)``.
    A user with at most ``long_history`` items is self-joined: at most that many products per row, so linear in the
    log, and they go straight into the map-side aggregate of the same stage. Longer histories would fan out with their
    square; they are multiplied in blocks instead, see :func:`_long_sums`.
    """
    if max_history <= long_history:
        return _short_sums(pairs).groupBy("item_i", "item_j").agg(F.sum("v").alias("v"))
    sizes = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    # At most rows / long_history users, far fewer than rows; the join size decides how they are sent.
    long_users = sizes.filter(F.col("n") > long_history).select("user_id")
    short = _short_sums(pairs.join(long_users, "user_id", "left_anti"))
    long = _long_sums(pairs.join(long_users, "user_id", "left_semi"), n_items, item_block, chunk_rows)
    return short.unionByName(long).groupBy("item_i", "item_j").agg(F.sum("v").alias("v"))


def _short_sums(pairs: DataFrame) -> DataFrame:
    x, y = pairs.alias("x"), pairs.alias("y")
    on = (F.col("x.user_id") == F.col("y.user_id")) & (F.col("x.item_id") < F.col("y.item_id"))
    product = (F.col("x.a") * F.col("y.b")).alias("v")
    return x.join(y, on).select(F.col("x.item_id").alias("item_i"), F.col("y.item_id").alias("item_j"), product)


def _long_sums(pairs: DataFrame, n_items: int, item_block: int, chunk_rows: int) -> DataFrame:
    """Sums over long histories as block products: items are hashed to blocks, users to chunks, and one task
    multiplies two item blocks over one chunk of users.

    A row travels once per item block instead of once per item of its user, sums over the chunk are formed inside the
    task, and neither a hot user nor a hot item can exceed a cell of (item block × chunk).
    """
    rows = pairs.count()
    blocks, chunks = max(ceil(n_items / item_block), 1), max(ceil(rows / chunk_rows), 1)
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    # A hot user's rows lie in one chunk, but a cell takes one item block of them only.
    chunk = F.pmod(F.xxhash64("user_id"), F.lit(chunks))
    placed = pairs.select("user_id", "item_id", "a", "b", block.alias("block"), chunk.alias("chunk"))
    last = F.lit(blocks - 1).cast("long")
    left = placed.select(
        "chunk", F.col("block").alias("bi"), F.explode(F.sequence(F.col("block"), last)).alias("bj"),
        "user_id", "item_id", F.col("a").alias("w"),
    )
    right = placed.select(
        F.col("chunk").alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("block"))).alias("bi"),
        F.col("block").alias("bj"), F.col("user_id").alias("user_id"), F.col("item_id").alias("item_id"), F.col("b").alias("w"),
    )
    cells, keys = blocks * (blocks + 1) // 2 * chunks, ["chunk", "bi", "bj"]
    left, right = left.repartition(cells, *keys), right.repartition(cells, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_cell, "item_i bigint, item_j bigint, v double")


def _cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    if not len(left) or not len(right):
        return pd.DataFrame({"item_i": [], "item_j": [], "v": []})
    same = bool(left["bi"].iloc[0] == left["bj"].iloc[0])
    rows, r = np.unique(left["item_id"].to_numpy("int64"), return_inverse=True)
    cols, c = np.unique(right["item_id"].to_numpy("int64"), return_inverse=True)
    users, t = np.unique(np.concatenate([left["user_id"], right["user_id"]]).astype("int64"), return_inverse=True)
    lt, rt = t[: len(left)], t[len(left) :]
    by_user = np.argsort(rt, kind="stable")
    rt, c, rw = rt[by_user], c[by_user], right["w"].to_numpy("float64")[by_user]
    counts = np.bincount(rt, minlength=len(users))
    starts = np.cumsum(counts) - counts
    by_row = np.argsort(r, kind="stable")
    r, lt, lw = r[by_row], lt[by_row], left["w"].to_numpy("float64")[by_row]
    out = []
    step = rows_per_strip(len(cols))
    for a in range(0, len(rows), step):
        n = min(step, len(rows) - a)
        lo, hi = np.searchsorted(r, [a, a + n])
        sums = sparse_strip(r[lo:hi] - a, lt[lo:hi], lw[lo:hi], n, rt, c, rw, len(cols), starts, counts)
        i, j = np.nonzero(sums)
        x, y, v = rows[i + a], cols[j], sums[i, j]
        keep = x < y if same else x != y
        x, y, v = x[keep], y[keep], v[keep]
        out.append(pd.DataFrame({"item_i": np.minimum(x, y), "item_j": np.maximum(x, y), "v": v}))
    return pd.concat(out)


def mirrored(half: DataFrame) -> DataFrame:
    """Both triangles of a symmetric table given its upper one."""
    swapped = half.select(F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j"), "v")
    return half.select("item_i", "item_j", "v").unionByName(swapped)
