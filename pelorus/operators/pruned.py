"""Exact top-k inner products: users stream past small catalogs, larger ones are searched through an index.

A catalog of one block is held by a task that streams users (with the pairs they have seen) past it in bounded chunks, so items travel
only to a bounded number of user groups, however many users there are. Larger catalogs go through an index with bounds in files, see `boxes`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import l2_norm
from .boxes import top_k_in_boxes
from .ranking import top_k

ITEM_BLOCK = 65536
# Users per group: a task streams them, so this bounds its time and not its memory.
USER_GROUP = 1 << 20
# Scores held at once inside a task, and cells of a product.
_STRIP_CELLS = 1 << 22
_MOST_CELLS = 20_000
# Scores are rounded to 10 decimals; a bound closer than this decides nothing.
_SLACK = 1e-6


def _strip(users: np.ndarray, vectors: np.ndarray, seen_u: np.ndarray, seen_i: np.ndarray, items: np.ndarray, factors: np.ndarray, k: int, positive: bool):
    """Rows ``(user, item, score)`` with the k best unseen items of a few users; ``items`` are sorted ids, ``users`` sorted."""
    scores = np.round(vectors @ factors.T, 10)
    u = np.minimum(np.searchsorted(users, seen_u), len(users) - 1)
    at = np.minimum(np.searchsorted(items, seen_i), len(items) - 1)
    known = (items[at] == seen_i) & (users[u] == seen_u)
    scores[u[known], at[known]] = -np.inf
    k = min(k, scores.shape[1])
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    above, tied = scores > kth, scores == kth
    if (tied.sum(axis=1) + above.sum(axis=1) > k).any():
        tied &= np.cumsum(tied, axis=1) <= k - above.sum(axis=1, keepdims=True)
    r, c = np.nonzero((above | tied) & (scores > (0.0 if positive else -np.inf)))
    return users[r], items[c], scores[r, c]


def _cells(k: int, positive: bool) -> Callable:
    """Cells arrive one after another: the item rows (kind 0) of a cell, then per user the vector (kind 1) and the seen pairs (kind 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, items, factors = None, [], []
        held: list[pa.RecordBatch] = []

        def matrix(column: pa.Array) -> np.ndarray:
            return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            if not held:
                return
            rows = pa.Table.from_batches(held).combine_chunks()
            kinds = rows.column("kind").to_numpy()
            starts = np.flatnonzero(kinds == 1)
            # The last user may still be receiving seen pairs.
            ready = len(starts) if last else len(starts) - 1
            if ready <= 0 or not items:
                held = [] if last else held
                return
            stop = len(kinds) if last else int(starts[ready])
            items[:], factors[:] = [np.concatenate(items)], [np.concatenate(factors)]
            ids, q = items[0], factors[0]
            users = rows.column("user_id").to_numpy()
            vectors = matrix(rows.column("vec").chunk(0).take(pa.array(starts[:ready])))
            seen = np.flatnonzero(kinds[:stop] == 2)
            seen_u, seen_i = users[seen], rows.column("item_id").to_numpy()[seen]
            step = max(1, _STRIP_CELLS // len(ids))
            for a in range(0, ready, step):
                mine = users[starts[a : min(a + step, ready)]]
                lo, hi = np.searchsorted(seen_u, [mine[0], mine[-1] + 1])
                out = _strip(mine, vectors[a : a + step], seen_u[lo:hi], seen_i[lo:hi], ids, q, k, positive)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["user_id", "item_id", "score"])
            held = [] if last else rows.slice(stop).to_batches()

        for batch in batches:
            cells, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(cells) != 0) | ((kinds[1:] == 0) != (kinds[:-1] == 0))) + 1).tolist(), len(cells)]
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                if a == z:
                    continue
                if cells[a] != cell:
                    yield from flush(True)
                    cell, items, factors = cells[a], [], []
                part = batch.slice(a, z - a)
                if kinds[a] == 0:
                    items.append(part.column("item_id").to_numpy())
                    factors.append(matrix(part.column("vec")))
                else:
                    held.append(part)
                    if sum(h.num_rows for h in held) >= max(1024, _STRIP_CELLS // max(1, sum(map(len, items)))):
                        yield from flush(False)
        yield from flush(True)

    return run


def _product(users: DataFrame, seen: DataFrame, items: DataFrame, groups: int, blocks: int, k: int, positive: bool) -> DataFrame:
    """``users (user_id, vec, ib)``, ``seen (user_id, item_id, ib)`` and ``items (item_id, vec, ib)`` to the k best rows per user and block."""
    group = F.pmod(F.xxhash64("user_id"), F.lit(groups))
    none, zero = F.lit(None).cast("array<double>"), F.lit(0).cast("long")

    def rows(table: DataFrame, kind: int, group, user, item, vec) -> DataFrame:
        return table.select((group * blocks + F.col("ib")).cast("int").alias("cell"), F.lit(kind).alias("kind"), user.alias("user_id"), item.alias("item_id"), vec.alias("vec"))

    every = F.explode(F.sequence(zero, F.lit(groups - 1).cast("long")))
    both = rows(items.withColumn("g", every), 0, F.col("g"), zero, F.col("item_id"), F.col("vec"))
    both = both.unionByName(rows(users, 1, group, F.col("user_id"), zero, F.col("vec")))
    both = both.unionByName(rows(seen, 2, group, F.col("user_id"), F.col("item_id"), none))
    cells = groups * blocks
    parts = min(cells, _MOST_CELLS)
    dealt = both.withColumn("part", (F.col("cell") % parts).cast("int")).repartitionById(parts, "part")
    # Item rows carry user 0: the kind tells them from users, and comes first.
    first = F.when(F.col("kind") == 0, 0).otherwise(1)
    ordered = dealt.withColumn("first", first).sortWithinPartitions("cell", "first", "user_id", "kind", "item_id")
    return ordered.select("cell", "kind", "user_id", "item_id", "vec").mapInArrow(_cells(k, positive), "user_id bigint, item_id bigint, score double")


def dense_top_k(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int, n_users: int, n_items: int,
    user_block: int = USER_GROUP, item_block: int = ITEM_BLOCK, positive: bool = False,
) -> DataFrame:
    """Top-k unseen items by inner product of ``users (user_id, vec)`` and ``items (item_id, vec)``, one row per user and per item.

    Scores are rounded to 10 decimals, ties go to the smaller item id.
    """
    vec = F.col("vec").cast("array<double>").alias("vec")
    users, items = users.select("user_id", vec), items.select("item_id", vec)
    if n_items > item_block:
        return top_k_in_boxes(users, items, seen, k, n_users, n_items, item_block, positive)
    one = F.lit(0).cast("long").alias("ib")
    groups = max(1, min(_MOST_CELLS, ceil(n_users / user_block)), 2 * users.sparkSession.sparkContext.defaultParallelism)
    found = _product(users.select("*", one), seen.select("user_id", "item_id", one), items.select("*", one), groups, 1, k, positive)
    return top_k(found, k, [F.desc("score"), F.asc("item_id")]).select("user_id", "item_id", "rank", "score")


def onward(users: DataFrame, first: DataFrame, k: int, tops: list[float], positive: bool = False) -> DataFrame:
    """``(user_id, vec, ib)``: users at the later blocks that can still hold one of their k best; ``first`` has the lists of block 0."""
    kth = first.groupBy("user_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    bounds = F.array(*[F.struct(F.lit(b).cast("long").alias("ib"), F.lit(float(top)).alias("top")) for b, top in enumerate(tops) if b])
    with_norm = users.join(kth, "user_id", "left").withColumn("norm", l2_norm(F.col("vec")))
    needed = F.when(F.col("kth").isNull(), F.lit(0.0 if positive else float("-inf"))).otherwise(F.col("kth"))
    at = with_norm.withColumn("needed", needed).withColumn("b", F.explode(bounds))
    return at.filter(F.col("norm") * F.col("b.top") * (1 + 1e-9) + _SLACK >= F.col("needed")).select("user_id", "vec", "b.ib")
