"""Approximate top-k by inverted cells: items are dealt to the cells of a coarse clustering, users meet the nearest cells only.

Cells are packed into blocks of bounded size, and a user travels only to blocks that hold one of the probed cells. A cell
with more items than a block (equal or frequent vectors) is spread over blocks of its own. Inside a task the candidates of a user
are laid side by side, so work grows with the probed items and not with the catalog.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import MOST_PARTITIONS
from .ranking import top_k

BLOCK_ROWS = 65536
USER_BLOCK = 16384
# Candidates held at once inside a task.
_STRIP = 1 << 22


def fit_centroids(sample: np.ndarray, n_cells: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's clustering of a sample, started from its first distinct rows; deterministic for a given sample order."""
    _, first = np.unique(sample, axis=0, return_index=True)
    centers = sample[np.sort(first)[:n_cells]].copy()
    for _ in range(rounds if len(centers) < len(sample) else 0):
        owner = nearest(sample, centers)
        counts = np.bincount(owner, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, owner, sample)
        moved = counts > 0
        new = centers.copy()
        new[moved] = sums[moved] / counts[moved, None]
        if np.array_equal(new, centers):
            break
        centers = new
    return centers


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The closest centre of every row, the first one among equals."""
    return np.argmin((centers * centers).sum(axis=1)[None, :] - 2 * rows @ centers.T, axis=1)


def with_cell(vectors: DataFrame, id_col: str, centers: np.ndarray) -> DataFrame:
    """``(id, vec, cell)``: every row with its cell."""
    kind = dict(vectors.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nearest(rows, centers).astype("int32"))], [id_col, "vec", "cell"])

    return vectors.select(id_col, F.col("vec").cast("array<double>").alias("vec")).mapInArrow(run, f"{id_col} {kind}, vec array<double>, cell int")


class CellPlan:
    """Which blocks a cell's items lie in: ``parts[cell]`` blocks from ``first[cell]`` on; ``blocks`` in all."""

    def __init__(self, counts: np.ndarray, block_rows: int):
        self.parts = np.maximum(1, -(-counts // block_rows)).astype("int64")
        self.first = np.zeros(len(counts), "int64")
        block, room = -1, 0
        for cell, n in enumerate(counts.tolist()):
            if self.parts[cell] > 1:
                self.first[cell], block, room = block + 1, block + int(self.parts[cell]), 0
                continue
            if n > room:
                block, room = block + 1, block_rows
            self.first[cell], room = max(block, 0), room - n
        self.blocks = max(block + 1, 1)


def _probes(users: DataFrame, centers: np.ndarray, plan: CellPlan, n_probe: int) -> DataFrame:
    """``(ib, user_id, vec, cells)``: users at the blocks that hold a probed cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                b = batch.slice(a, 2048)
                rows = np.stack(b.column(1).to_numpy(zero_copy_only=False))
                near = probe_order(rows, centers)[:, :n_probe]
                out: dict[tuple[int, int], list[int]] = {}
                for u, cells in enumerate(near.tolist()):
                    for c in cells:
                        for ib in range(int(plan.first[c]), int(plan.first[c] + plan.parts[c])):
                            out.setdefault((u, ib), []).append(c)
                at = pa.array([u for u, _ in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ib for _, ib in out], pa.int64()), b.column(0).take(at), b.column(1).take(at), pa.array(list(out.values()), pa.list_(pa.int32()))],
                    ["ib", "user_id", "vec", "cells"],
                )

    return users.select("user_id", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(run, "ib bigint, user_id bigint, vec array<double>, cells array<int>")


def probe_order(users: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Cells by falling inner product with their centre, the first one among equals. Centres may have one more dimension than users."""
    return np.argsort(-(users @ centers[:, : users.shape[1]].T), axis=1, kind="stable")


def cell_candidates(
    users: np.ndarray, probes: list[np.ndarray], items: np.ndarray, cell: np.ndarray, seen_u: np.ndarray, seen_i: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows ``(user row, item row, score)`` with the k best probed unseen items per user. ``items`` are sorted by cell; ``seen_*`` are row
    numbers of both."""
    found, starts, counts = np.unique(cell, return_index=True, return_counts=True)
    where = np.searchsorted(found, np.concatenate([*probes, np.zeros(0, "int64")])).astype("int64")
    owner = np.repeat(np.arange(len(users)), [len(p) for p in probes])
    size = counts[where]
    ends = np.cumsum(size)
    first_of = np.searchsorted(owner, np.arange(len(users)))
    base = np.r_[0, ends][first_of]
    offset = ends - size - base[owner]
    total = np.bincount(owner, size, len(users)).astype("int64")
    out = []
    # Users with about the same number of candidates share a strip.
    by_total = np.argsort(-total, kind="stable")
    a = 0
    while a < len(users):
        width = int(total[by_total[a]])
        if not width:
            break
        rows = by_total[a : a + max(1, _STRIP // width)]
        a += len(rows)
        line = np.full(len(users), -1)
        line[rows] = np.arange(len(rows))
        scores, item = np.full((len(rows), width), -np.inf), np.zeros((len(rows), width), "int64")
        place = np.full((len(rows), len(found)), -1, "int64")
        mine = np.flatnonzero(line[owner] >= 0)
        place[line[owner[mine]], where[mine]] = offset[mine]
        for c in range(len(found)):
            at = np.flatnonzero(place[:, c] >= 0)
            if len(at):
                span = slice(starts[c], starts[c] + counts[c])
                columns = place[at, c][:, None] + np.arange(counts[c])[None, :]
                scores[at[:, None], columns] = np.round(users[rows[at]] @ items[span].T, 10)
                item[at[:, None], columns] = np.arange(starts[c], starts[c] + counts[c])[None, :]
        known = line[seen_u] >= 0
        u, i = line[seen_u[known]], seen_i[known]
        c = np.searchsorted(found, cell[i])
        probed = place[u, c] >= 0
        u, i, c = u[probed], i[probed], c[probed]
        scores[u, place[u, c] + i - starts[c]] = -np.inf
        r, x = _k_best(scores, ids[item], k)
        out.append((rows[r], item[r, x], scores[r, x]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0))


def _k_best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best finite scores per row, ties to the smaller id."""
    k = min(k, scores.shape[1])
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    above = scores > kth
    r, c = np.nonzero((scores == kth) & np.isfinite(scores))
    order = np.lexsort((ids[r, c], r))
    r, c = r[order], c[order]
    first = np.searchsorted(r, np.arange(len(scores)))
    keep = np.arange(len(r)) - first[r] < (k - above.sum(axis=1))[r]
    ra, ca = np.nonzero(above)
    return np.concatenate([ra, r[keep]]), np.concatenate([ca, c[keep]])


def _cell_task(k: int):
    def task(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        mine, seen = left[~left["is_seen"]].sort_values("user_id"), left[left["is_seen"]]
        right = right.sort_values(["cell", "item_id"])
        none = pd.DataFrame({"user_id": [], "item_id": [], "score": []}, dtype="int64")
        if not len(mine) or not len(right):
            return none
        users, ids = mine["user_id"].to_numpy("int64"), right["item_id"].to_numpy("int64")
        by_id = np.argsort(ids, kind="stable")
        su = np.minimum(np.searchsorted(users, seen["user_id"].to_numpy("int64")), len(users) - 1)
        si = by_id[np.minimum(np.searchsorted(ids[by_id], seen["item_id"].to_numpy("int64")), len(ids) - 1)]
        known = (users[su] == seen["user_id"].to_numpy("int64")) & (ids[si] == seen["item_id"].to_numpy("int64"))
        cell = right["cell"].to_numpy("int64")
        # A spread cell may have no item in this block.
        here = np.unique(cell)
        probes = [np.intersect1d(c, here) for c in mine["cells"]]
        u, i, score = cell_candidates(np.stack(mine["vec"].to_list()), probes, np.stack(right["vec"].to_list()), cell, su[known], si[known], ids, k)
        return pd.DataFrame({"user_id": users[u], "item_id": ids[i], "score": score})

    return task


def probed_top_k(
    users: DataFrame, indexed: DataFrame, seen: DataFrame, k: int, n_users: int, centers: np.ndarray, counts: np.ndarray, n_probe: int,
    block_rows: int = BLOCK_ROWS, user_block: int = USER_BLOCK,
) -> DataFrame:
    """Lists of the k best unseen items among the ``n_probe`` nearest cells of each user: ``users (user_id, vec)``,
    ``indexed (item_id, vec, cell)`` of which ``counts[cell]`` rows lie in each cell."""
    spark = users.sparkSession
    plan = CellPlan(counts, block_rows)
    cores = spark.sparkContext.defaultParallelism
    gu = max(ceil(n_users / user_block), ceil(2 * cores / plan.blocks))
    ub = F.pmod(F.xxhash64("user_id"), F.lit(gu))
    # One row per cell, at most the number of centres.
    cells = spark.createDataFrame([(c, int(f), int(p)) for c, (f, p) in enumerate(zip(plan.first, plan.parts, strict=True))], "cell int, first long, parts long")
    placed = indexed.join(F.broadcast(cells), "cell").withColumn("ib", F.col("first") + F.pmod(F.xxhash64("item_id"), F.col("parts")))
    none = F.lit(None)
    left = _probes(users, centers, plan, n_probe).select(
        ub.alias("ub"), "ib", F.lit(False).alias("is_seen"), "user_id", F.lit(0).cast("long").alias("item_id"), "vec", "cells"
    ).unionByName(
        seen.join(placed.select("item_id", "ib"), "item_id").select(
            ub.alias("ub"), "ib", F.lit(True).alias("is_seen"), "user_id", "item_id", none.cast("array<double>").alias("vec"), none.cast("array<int>").alias("cells")
        )
    )
    right = placed.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(gu - 1).cast("long"))).alias("ub"), "ib", "item_id", "vec", "cell")
    parts = min(gu * plan.blocks, MOST_PARTITIONS)
    left, right = left.repartition(parts, "ub", "ib"), right.repartition(parts, "ub", "ib")
    found = left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib")).applyInPandas(_cell_task(k), "user_id bigint, item_id bigint, score double")
    return top_k(found, k, [F.desc("score"), F.asc("item_id")]).select("user_id", "item_id", "rank", "score")
