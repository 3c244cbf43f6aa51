"""Exact top-k inner products over an index of dense vectors in files, whose leaves of near vectors are skipped by bounds.

Items lie in segments of falling norm. A segment is split at medians into leaves of at most 256 vectors, each with the largest and the
smallest value per dimension: the products of a user's vector with those bound all scores of a leaf, and so does the user's norm times the
leaf's largest. Only leaves that can still hold one of a user's k best items, ties by item id included, are multiplied.

Users are dealt to cells once and a cell reads the index, segment by segment, from the shared folder: nothing is sent per user and block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import attempt_name, create, new_folder
from ..functions.numeric import l2_norm
from ..session import durable, in_cells
from .reach import Index, _Segments, places

# Items whose scores share one bound.
LEAF = 256
# Users of a cell, on average; users, bounds and list rows of one strip of it.
_CELL_USERS = 1 << 14
_STRIP_USERS = 2048
_STRIP_CELLS = 1 << 21
_STRIP_ROWS = 1 << 20
# Leaves of a user met first in a segment, beyond those that hold k items.
_FIRST = 2
# Found rows kept before they are cut to the k best.
_MOST_FOUND = 1 << 20
# Products and bounds differ by rounding only; this share of the norms is far more.
_SLACK = 1e-12
_NO_ITEM = np.iinfo("int64").max

_KINDS = {"ids": "<i8", "vec": "<f8", "ptr": "<i8", "high": "<f8", "low": "<f8", "norm": "<f8", "sorted": "<i8", "place": "<i8"}


def _leaves(ids: np.ndarray, vec: np.ndarray) -> list[np.ndarray]:
    """Rows of every leaf, by item id in a leaf and by the leaves' smallest ids; equal vectors are cut in the order of their ids."""
    out, open_ = [], [np.arange(len(ids))]
    while open_:
        rows = open_.pop()
        mine = vec[rows]
        spread = mine.max(axis=0) - mine.min(axis=0) if len(rows) > LEAF else np.zeros(1)
        if not spread.any():
            rows = rows[np.argsort(ids[rows], kind="stable")]
            out += [rows[a : a + LEAF] for a in range(0, len(rows), LEAF)]
            continue
        value = mine[:, int(np.argmax(spread))]
        middle = np.partition(value, len(value) // 2)[len(value) // 2]
        low = value < middle if (value < middle).any() else value <= middle
        open_ += [rows[low], rows[~low]]
    return sorted(out, key=lambda rows: ids[rows[0]])


def _segment(ids: np.ndarray, vec: np.ndarray) -> dict[str, np.ndarray]:
    leaves = _leaves(ids, vec)
    order = np.concatenate(leaves)
    ids, vec = ids[order], vec[order]
    starts = np.cumsum([0, *map(len, leaves)])
    place = np.argsort(ids, kind="stable")
    return {
        "ids": ids, "vec": vec, "ptr": starts, "high": np.maximum.reduceat(vec, starts[:-1]), "low": np.minimum.reduceat(vec, starts[:-1]),
        "norm": np.maximum.reduceat(np.sqrt((vec * vec).sum(axis=1)), starts[:-1]), "sorted": ids[place], "place": place,
    }


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _finite(vec) -> F.Column:
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x))


def build(items: DataFrame, n_items: int, segment_items: int) -> Index:
    """Index ``items (item_id, vec)`` in segments of at most ``segment_items``; vectors with a null or NaN can be in no list and are left out."""
    folder = new_folder(items.sparkSession, "boxes")
    known = items.filter(F.col("item_id").isNotNull() & _finite(F.col("vec"))).withColumn("norm", l2_norm(F.col("vec")))
    order = [F.desc("norm"), F.asc("item_id")]
    parts = max(1, ceil(n_items / segment_items))
    ordered = known.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("item_id", "vec")

    def save(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        name = attempt_name(TaskContext.get().partitionId())
        arrays = _segment(rows.column("item_id").to_numpy(), _matrix(rows.column("vec").chunk(0)))
        for kind, data in arrays.items():
            with create(folder, f"{name}.{kind}") as f:
                f.write(np.ascontiguousarray(data, _KINDS[kind]).tobytes())
        top = pa.array([float(arrays["norm"].max())])
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(arrays["norm"])], pa.int64()), top], ["name", "leaves", "top"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            a = 0
            while a < batch.num_rows:
                part = batch.slice(a, segment_items - n)
                held.append(part)
                n, a = n + part.num_rows, a + part.num_rows
                if n == segment_items:
                    yield save(held)
                    held, n = [], 0
        if held:
            yield save(held)

    manifest = durable(ordered.mapInArrow(write, "name string, leaves bigint, top double"))
    # One row per segment.
    return Index(folder, [(r["name"], r["leaves"]) for r in manifest.orderBy(F.desc("top"), "name").collect()])


def _bounds(seg: dict[str, np.ndarray], vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """``(user, leaf)``: what no rounded score of the user in the leaf exceeds."""
    width = vectors.shape[1]
    high, low = seg["high"].reshape(-1, width), seg["low"].reshape(-1, width)
    most = norms[:, None] * seg["norm"]
    out = np.maximum(vectors, 0) @ high.T + np.minimum(vectors, 0) @ low.T
    return np.round(np.minimum(out, most) + _SLACK * most, 10)


def _cut(scores: np.ndarray, k: int) -> np.ndarray:
    """The k best of each row as a mask; equal scores keep the leftmost columns, which have the smaller ids."""
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    above, tied = scores > kth, scores == kth
    return above | (tied & (np.cumsum(tied, axis=1) <= k - above.sum(axis=1, keepdims=True)))


def _meet(seg, leaf: int, rows: np.ndarray, vectors: np.ndarray, seen_row: np.ndarray, seen_col: np.ndarray, needed: np.ndarray, last: np.ndarray, k: int):
    """Rows, items and rounded scores of one leaf that belong into the lists of the users ``rows``; seen pairs have a row among those and a column."""
    a, z = seg["ptr"][leaf], seg["ptr"][leaf + 1]
    ids = seg["ids"][a:z]
    scores = vectors[rows] @ seg["vec"].reshape(-1, vectors.shape[1])[a:z].T
    scores[seen_row, seen_col] = -np.inf
    least = needed[rows]
    near = scores >= (least - 1e-10)[:, None]
    near[seen_row, seen_col] = False
    if k < len(ids) and near.sum() > 2 * k * len(rows):
        near &= _cut(np.round(scores, 10), k)
    r, c = np.nonzero(near)
    score, item = np.round(scores[r, c], 10), ids[c]
    keep = (score > least[r]) | (score == least[r]) & (item < last[rows[r]])
    return rows[r[keep]], item[keep], score[keep]


def _strip(segments: _Segments, vectors: np.ndarray, seen_u: np.ndarray, seen_i: np.ndarray, k: int, positive: bool):
    """``(row, item, score)`` of a few users' vectors; seen pairs have the users' rows."""
    n = len(vectors)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    # Score and item of each user's k-th row; what is not better does not enter.
    needed, last = np.full(n, 0.0 if positive else -np.inf), np.full(n, -_NO_ITEM if positive else _NO_ITEM)
    best = tuple(np.zeros(0, x) for x in ("int64", "int64", "float64"))

    def keep_best(found: list) -> tuple:
        row, item, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((item, -score, row))
        row, item, score = row[order], item[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        full = rank == k - 1
        needed[row[full]], last[row[full]] = score[full], item[full]
        keep = rank < k
        return row[keep], item[keep], score[keep]

    for s in range(len(segments.index.segments)):
        seg = segments[s]
        bounds, lowest = _bounds(seg, vectors, norms), seg["ids"][seg["ptr"][:-1]]
        at = places(seg["sorted"], seen_i)
        pos = seg["place"][at[at >= 0]]
        seen_leaf = np.searchsorted(seg["ptr"], pos, side="right") - 1
        order = np.argsort(seen_leaf, kind="stable")
        seen_leaf, seen_col, seen_row = seen_leaf[order], (pos - seg["ptr"][seen_leaf])[order], seen_u[at >= 0][order]
        open_ = np.ones(bounds.shape, bool)
        first = _FIRST + k // LEAF
        in_rows = np.full(n, -1)
        while True:
            least = needed[:, None]
            ask = open_ & ((bounds > least) | (bounds == least) & (lowest < last[:, None]))
            many = np.flatnonzero(ask.sum(axis=1) > first)
            if len(many):
                # Leaves come by their smallest ids, which a stable order keeps among equal bounds.
                nearest = np.argsort(np.where(ask[many], -bounds[many], np.inf), axis=1, kind="stable")[:, first:]
                ask[many[:, None], nearest] = False
            if not ask.any():
                break
            open_ &= ~ask
            found, n_found = [best], 0
            for leaf in np.flatnonzero(ask.any(axis=0)):
                if n_found > _MOST_FOUND:
                    best = keep_best(found)
                    found, n_found = [best], 0
                rows = np.flatnonzero(ask[:, leaf])
                lo, hi = np.searchsorted(seen_leaf, [leaf, leaf + 1])
                in_rows[rows] = np.arange(len(rows))
                r = in_rows[seen_row[lo:hi]]
                in_rows[rows] = -1
                new = _meet(seg, leaf, rows, vectors, r[r >= 0], seen_col[lo:hi][r >= 0], needed, last, k)
                if len(new[0]):
                    found.append(new)
                    n_found += len(new[0])
            if n_found:
                best = keep_best(found)
            first *= 4
    return best


def _cell(index: Index, k: int, positive: bool) -> Callable:
    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        kinds, who = rows.column("is_seen").to_numpy(), rows.column("user_id").to_numpy()
        mine = np.flatnonzero(~kinds)
        if not len(mine) or not index.segments:
            return
        mine = mine[np.argsort(who[mine], kind="stable")]
        vectors = _matrix(rows.column("vec").chunk(0).take(pa.array(mine)))
        ids = who[mine]
        seen = np.flatnonzero(kinds)
        seen = seen[np.argsort(who[seen], kind="stable")]
        seen_u, seen_i = who[seen], rows.column("item_id").to_numpy()[seen]
        segments = _Segments(index, _KINDS)
        most = max(1, min(_STRIP_USERS, _STRIP_ROWS // max(k, 1), _STRIP_CELLS // max(leaves for _, leaves in index.segments)))
        a = 0
        while a < len(ids):
            # A user's rows, if there are several, share a strip.
            z = int(np.searchsorted(ids, ids[min(a + most, len(ids)) - 1], side="right"))
            lo, hi = int(np.searchsorted(seen_u, ids[a])), int(np.searchsorted(seen_u, ids[z - 1], side="right"))
            # Every row of a user has the user's seen pairs.
            from_, to = np.searchsorted(seen_u[lo:hi], ids[a:z]), np.searchsorted(seen_u[lo:hi], ids[a:z], side="right")
            reps = to - from_
            pair = np.repeat(from_ - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
            row, item, score = _strip(segments, vectors[a:z], np.repeat(np.arange(z - a), reps), seen_i[lo:hi][pair], k, positive)
            user = ids[a:z][row]
            order = np.lexsort((item, -score, user))
            user, item, score = user[order], item[order], score[order]
            rank = np.arange(len(user)) - np.searchsorted(user, user)
            keep = rank < k
            out = [pa.array(x) for x in (user[keep], item[keep], (rank[keep] + 1).astype("int32"), score[keep])]
            yield pa.RecordBatch.from_arrays(out, ["user_id", "item_id", "rank", "score"])
            a = z

    return cell


def top_k_in_boxes(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int, n_users: int, n_items: int, segment_items: int, positive: bool = False,
) -> DataFrame:
    """Top-k unseen items by inner product of ``users (user_id, vec)`` and ``items (item_id, vec)``, vectors of doubles, as ``(user_id,
    item_id, rank, score)``; ``n_users`` and ``n_items`` are about their numbers."""
    index = build(items, n_items, segment_items)
    cells = max(2 * users.sparkSession.sparkContext.defaultParallelism, ceil(n_users / _CELL_USERS))
    ub = F.pmod(F.xxhash64("user_id"), F.lit(cells)).cast("int").alias("ub")
    none, zero = F.lit(None).cast("array<double>"), F.lit(0).cast("long")
    left = users.filter(F.col("user_id").isNotNull() & _finite(F.col("vec")))
    left = left.select(ub, F.lit(False).alias("is_seen"), "user_id", zero.alias("item_id"), "vec")
    pairs = seen.filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    left = left.unionByName(pairs.select(ub, F.lit(True).alias("is_seen"), "user_id", "item_id", none.alias("vec")))
    schema = "user_id bigint, item_id bigint, rank int, score double"
    return in_cells(left, "ub", cells).groupBy("ub").applyInArrow(_cell(index, k, positive), schema)
