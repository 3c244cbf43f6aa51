"""Exact top-k of sparse user-item products; dense vectors go through `pruned`.

Where most user-item pairs share a term, users and items are hashed to blocks; one grouped task multiplies one user block
with one item block, masks the pairs already seen in that cell, and emits only the k best items per user. Score pairs
therefore never exist as rows: the shuffle carries each user once per item block and each item once per user block, and a
seen pair exactly once, to the cell it falls in. Cell inputs are bounded by the block sizes whatever the skew of users or items.

Where few pairs do (neighbours, graph steps), blocks would send every item entry to every user block. There the items of each term
are written to files once, and a block of users reads the lists of the terms it holds: what is multiplied grows with the products that
exist, and nothing is sent per product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import attempt_name, create, mapped, new_folder
from ..session import durable, in_cells
from .ranking import drop_seen, top_k
from .reach import places, top_k_in_reach

# Scores held at once inside a task (64 MB of doubles, a few times that with masks).
_STRIP_CELLS = 1 << 23
# Terms in more than this share of a cell's (user, item) pairs are multiplied as dense columns.
_DENSE_SHARE = 1 / 64
_DENSE_COLUMNS = 512
_EXPAND = 1 << 22

# Terms of one user that a cell may hold.
LONG_ENTRIES = 100_000

# Shuffle partitions of one product; each holds one cell in memory at a time.
MOST_PARTITIONS = 20_000

# Rows of one table that a cell of the grid holds on average, at most.
_CELL_ROWS = 1 << 21
# Up to this share of all (user, item) pairs, the products that exist are formed instead of whole blocks.
SPARSE_SHARE = 1 / 32
# Products of the users of one cell, on average, and of one strip of them.
_CELL_PRODUCTS = 1 << 21

# Item entries of a segment of lists, and the fewest that a task of its own is worth.
_SEGMENT_ENTRIES = 1 << 22
_LEAST_ENTRIES = 1 << 18
_LIST_KINDS = {"terms": "<i8", "ptr": "<i8", "ids": "<i8", "w": "<f8"}

# Absent ids are 0 beside a flag, never null: pandas turns a 64-bit column with nulls into doubles, which cannot hold ids
# beyond 2^53.
_OUT = "user_id bigint, item_id bigint, score double"


class Lists(NamedTuple):
    folder: str
    # Name, smallest and largest term of every segment.
    segments: list[tuple[str, int, int]]


def _grid(
    df: DataFrame, n_users: int, n_items: int, user_rows: int, item_rows: int, user_block: int, item_block: int
) -> tuple[int, int]:
    """User and item block counts: no block beyond its size, about two cells per core at least, fewest rows sent.

    Each user row is sent once per item block and each item row once per user block.
    """
    low_u = max(ceil(n_users / user_block), ceil(user_rows / _CELL_ROWS), 1)
    low_i = max(ceil(n_items / item_block), ceil(item_rows / _CELL_ROWS), 1)
    cells = 2 * df.sparkSession.sparkContext.defaultParallelism
    choices = []
    for user_blocks in range(low_u, max(low_u, cells) + 1):
        item_blocks = max(low_i, ceil(cells / user_blocks))
        choices.append((user_rows * item_blocks + item_rows * user_blocks, user_blocks, item_blocks))
    _, user_blocks, item_blocks = min(choices)
    return user_blocks, item_blocks


def _best_cells(scores: np.ndarray, k: int, positive: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best finite scores per row; equal scores keep the leftmost columns."""
    k = min(k, scores.shape[1])
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    above = scores > kth
    tied = scores == kth
    keep = above | (tied & (np.cumsum(tied, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    keep &= scores > (0.0 if positive else -np.inf)
    return np.nonzero(keep)


def _emit(strips, users: np.ndarray, items: np.ndarray, seen_u: np.ndarray, seen_i: np.ndarray, k: int, positive: bool):
    """Mask, round and cut score strips ``(first row, scores)``; ``users`` and ``items`` are sorted ids."""
    su = np.searchsorted(users, seen_u)
    si = np.searchsorted(items, seen_i)
    known = (su < len(users)) & (si < len(items))
    known[known] = (users[su[known]] == seen_u[known]) & (items[si[known]] == seen_i[known])
    su, si = su[known], si[known]
    out = []
    for first, scores in strips:
        scores = np.round(scores, 10)
        mine = (su >= first) & (su < first + len(scores))
        scores[su[mine] - first, si[mine]] = -np.inf
        r, c = _best_cells(scores, k, positive)
        out.append(pd.DataFrame({"user_id": users[r + first], "item_id": items[c], "score": scores[r, c]}))
    return pd.concat(out) if out else pd.DataFrame({"user_id": [], "item_id": [], "score": []}, dtype="int64")


def rows_per_strip(n_items: int) -> int:
    return max(1, _STRIP_CELLS // max(n_items, 1))


def sparse_strip(u, t, w, n_rows, it, ii, iw, n_items, starts, counts):
    """Scores of one strip of users; item entries are sorted by term, ``starts``/``counts`` index them by term."""
    scores = np.zeros((n_rows, n_items))
    pairs = np.bincount(t, minlength=len(counts)) * counts
    dense = np.flatnonzero(pairs > _DENSE_SHARE * n_rows * n_items)
    for a in range(0, len(dense), _DENSE_COLUMNS):
        terms = dense[a : a + _DENSE_COLUMNS]
        place = np.full(len(counts), -1)
        place[terms] = np.arange(len(terms))
        left, right = np.zeros((n_rows, len(terms))), np.zeros((len(terms), n_items))
        mu, mi = place[t] >= 0, place[it] >= 0
        left[u[mu], place[t[mu]]] = w[mu]
        right[place[it[mi]], ii[mi]] = iw[mi]
        scores += left @ right
    rest = np.ones(len(counts), dtype=bool)
    rest[dense] = False
    keep = rest[t] & (counts[t] > 0)
    u, t, w = u[keep], t[keep], w[keep]
    ends = np.cumsum(counts[t])
    flat = scores.reshape(-1)
    a = 0
    while a < len(t):
        base = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, base + _EXPAND, side="right")))
        reps = counts[t[a:b]]
        offset = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        entry = np.repeat(starts[t[a:b]], reps) + offset
        np.add.at(flat, np.repeat(u[a:b], reps) * n_items + ii[entry], np.repeat(w[a:b], reps) * iw[entry])
        a = b
    return scores


def _sparse_cell(k: int, positive: bool) -> Callable:
    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        mine, seen = left[~left["is_seen"]], left[left["is_seen"]]
        users, u = np.unique(mine["user_id"].to_numpy("int64"), return_inverse=True)
        items, ii = np.unique(right["item_id"].to_numpy("int64"), return_inverse=True)
        if not len(users) or not len(items):
            return pd.DataFrame({"user_id": [], "item_id": [], "score": []})
        terms, it = np.unique(right["term_id"].to_numpy("int64"), return_inverse=True)
        by_term = np.argsort(it, kind="stable")
        it, ii, iw = it[by_term], ii[by_term], right["w"].to_numpy("float64")[by_term]
        counts = np.bincount(it, minlength=len(terms))
        starts = np.cumsum(counts) - counts
        asked = mine["term_id"].to_numpy("int64")
        t = np.searchsorted(terms, asked)
        known = t < len(terms)
        known[known] = terms[t[known]] == asked[known]
        u, t, w = u[known], t[known], mine["w"].to_numpy("float64")[known]
        by_user = np.argsort(u, kind="stable")
        u, t, w = u[by_user], t[by_user], w[by_user]
        step = rows_per_strip(len(items))

        def strips():
            for a in range(0, len(users), step):
                rows = min(step, len(users) - a)
                lo, hi = np.searchsorted(u, [a, a + rows])
                yield a, sparse_strip(u[lo:hi] - a, t[lo:hi], w[lo:hi], rows, it, ii, iw, len(items), starts, counts)

        return _emit(strips(), users, items, seen["user_id"].to_numpy("int64"), seen["item_id"].to_numpy("int64"), k, positive)

    return cell


def _run(left: DataFrame, right: DataFrame, cells: int, cell: Callable, k: int) -> DataFrame:
    # A fixed partition count keeps about one cell per task (adaptive merging goes by bytes and would undo it); a
    # large grid puts several cells, worked off one by one, into each of a bounded number of partitions.
    parts = min(cells, MOST_PARTITIONS)
    left, right = left.repartition(parts, "ub", "ib"), right.repartition(parts, "ub", "ib")
    parts = left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib")).applyInPandas(cell, _OUT)
    return top_k(parts, k, [F.desc("score"), F.asc("item_id")]).select("user_id", "item_id", "rank", "score")


def _spread(column: str, blocks: int):
    return F.pmod(F.xxhash64(column), F.lit(blocks))


def _all_blocks(blocks: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def products(users: DataFrame, items: DataFrame) -> int:
    """Number of pairs of a user's and an item's row with the same term."""
    asked = users.groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    held = items.groupBy("term_id").agg(F.count(F.lit(1)).alias("m"))
    return asked.join(held, "term_id").agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0


def _packed(items: DataFrame) -> DataFrame:
    """``(term_id, ids, ws)``: the items of a term in lists of at most one Arrow batch."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                terms = b.column(0).to_numpy()
                starts = np.r_[0, np.flatnonzero(np.diff(terms)) + 1]
                cuts = pa.array(np.r_[starts, len(terms)].astype("int32"))
                lists = [pa.ListArray.from_arrays(cuts, b.column(c)) for c in (1, 2)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(starts)), *lists], ["term_id", "ids", "ws"])

    ordered = items.select("term_id", "item_id", F.col("w").cast("double").alias("w")).repartition("term_id")
    ordered = ordered.sortWithinPartitions("term_id", "item_id")
    return ordered.mapInArrow(pack, "term_id bigint, ids array<bigint>, ws array<double>")


def needed_lists(users: DataFrame, items: DataFrame, blocks: int) -> DataFrame:
    """``(ub, term_id, ids, ws)``: the packed items of every term, at the user blocks that hold the term."""
    asked = users.select("term_id", _spread("user_id", blocks).alias("ub")).distinct()
    return _packed(items).join(asked, "term_id").select("ub", "term_id", "ids", "ws")


def write_lists(items: DataFrame, n_entries: int) -> Lists:
    """The items of every term as flat files in the shared folder, in the order of the terms; a long list may lie in several segments."""
    folder = new_folder(items.sparkSession, "lists")
    cores = items.sparkSession.sparkContext.defaultParallelism
    parts = max(1, ceil(n_entries / _SEGMENT_ENTRIES), min(cores, ceil(n_entries / _LEAST_ENTRIES)))
    ordered = items.select("term_id", "item_id", F.col("w").cast("double").alias("w")).repartitionByRange(parts, "term_id", "item_id")

    def save(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        term = rows.column("term_id").to_numpy()
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        name = attempt_name(TaskContext.get().partitionId())
        arrays = {"terms": term[first], "ptr": np.r_[first, len(term)], "ids": rows.column("item_id").to_numpy(), "w": rows.column("w").to_numpy()}
        for kind, data in arrays.items():
            with create(folder, f"{name}.{kind}") as f:
                f.write(np.ascontiguousarray(data, _LIST_KINDS[kind]).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array(term[:1]), pa.array(term[-1:])], ["name", "low", "high"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(h.num_rows for h in held) >= _SEGMENT_ENTRIES:
                yield save(held)
                held = []
        if held:
            yield save(held)

    manifest = durable(ordered.sortWithinPartitions("term_id", "item_id").mapInArrow(write, "name string, low bigint, high bigint"))
    # One row per segment of some four million entries.
    return Lists(folder, [(r["name"], r["low"], r["high"]) for r in manifest.orderBy("name").collect()])


def _user_cell(lists: Lists, k: int) -> Callable:
    """All lists of one block of users: products are summed by (user, item) strip by strip, seen pairs left out."""

    def cell(rows: pa.Table) -> pa.Table:
        kinds = rows.column("is_seen").to_numpy()
        who, what = rows.column("user_id").to_numpy(), rows.column("id").to_numpy()
        out = [[np.zeros(0, "int64")] * 2 + [np.zeros(0, "int32"), np.zeros(0)]]
        mine = np.flatnonzero(~kinds)
        mine = mine[np.argsort(who[mine], kind="stable")]
        asked, t = np.unique(what[mine], return_inverse=True)
        # Start and length of each asked term's list, in every segment that may hold one.
        held, counts = [], np.zeros(len(asked), "int64")
        for name, low, high in lists.segments:
            if len(asked) and low <= asked[-1] and high >= asked[0]:
                files = {kind: mapped(lists.folder, f"{name}.{kind}", dtype) for kind, dtype in _LIST_KINDS.items()}
                at = places(files["terms"], asked)
                start, size = files["ptr"][at], np.where(at >= 0, files["ptr"][np.maximum(at, 0) + 1] - files["ptr"][at], 0)
                if size.any():
                    held.append((files["ids"], files["w"], start, size))
                    counts += size
        known = counts[t] > 0
        mine, t = mine[known], t[known]
        users, u = np.unique(who[mine], return_inverse=True)
        w = rows.column("w").to_numpy()[mine]
        seen_u, seen_i = places(users, who[kinds]) if len(users) else np.full(int(kinds.sum()), -1), what[kinds]
        by_user = np.argsort(seen_u, kind="stable")
        seen_u, seen_i = seen_u[by_user], seen_i[by_user]
        # Strips end with a user.
        ends = np.cumsum(counts[t])
        user_ends = np.searchsorted(u, np.arange(len(users)), side="right")
        a = 0
        while a < len(t):
            full = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _CELL_PRODUCTS, side="right"))
            whole = user_ends[: int(np.searchsorted(user_ends, full, side="right"))]
            b = int(whole[-1]) if len(whole) and whole[-1] > a else int(user_ends[u[a]])
            parts = []
            for ids, ws, start, size in held:
                reps = size[t[a:b]]
                entry = np.repeat(start[t[a:b]] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
                parts.append((np.repeat(u[a:b], reps), ids[entry], np.repeat(w[a:b], reps) * ws[entry]))
            row, item, value = (np.concatenate(x) for x in zip(*parts, strict=True))
            items, ii = np.unique(item, return_inverse=True)
            lo, hi = np.searchsorted(seen_u, [u[a], u[b - 1] + 1])
            at = places(items, seen_i[lo:hi])
            seen = np.sort(seen_u[lo:hi][at >= 0] * len(items) + at[at >= 0])
            key = row * len(items) + ii
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            key, score = key[begin], np.round(np.add.reduceat(value, begin), 10)
            at = np.minimum(np.searchsorted(seen, key), len(seen) - 1) if len(seen) else None
            keep = (score > 0) if at is None else (score > 0) & (seen[at] != key)
            key, score = key[keep], score[keep]
            row, column = np.divmod(key, len(items))
            order = np.lexsort((column, -score, row))
            row, column, score = row[order], column[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            best = rank < k
            out.append([users[row[best]], items[column[best]], rank[best].astype("int32") + 1, score[best]])
            a = b
        names = ["user_id", "item_id", "rank", "score"]
        return pa.table(dict(zip(names, map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return cell


def _by_user(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int, n_products: int, cell_products: int, n_entries: int
) -> DataFrame:
    """Top-k by blocks of users only, each of which reads the lists of its terms from files."""
    blocks = max(2 * users.sparkSession.sparkContext.defaultParallelism, ceil(n_products / cell_products))
    ub = _spread("user_id", blocks).cast("int").alias("ub")
    left = users.select(ub, F.lit(False).alias("is_seen"), "user_id", F.col("term_id").alias("id"), F.col("w").cast("double").alias("w"))
    left = left.unionByName(
        seen.select(ub, F.lit(True).alias("is_seen"), "user_id", F.col("item_id").alias("id"), F.lit(0.0).alias("w"))
    )
    lists = write_lists(items, n_entries)
    schema = "user_id bigint, item_id bigint, rank int, score double"
    return in_cells(left, "ub", blocks).groupBy("ub").applyInArrow(_user_cell(lists, k), schema)


def sparse_top_k(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int, n_users: int, n_items: int, max_entries: int,
    entries: tuple[int, int], user_block: int = 8192, item_block: int = 32768, long_entries: int = LONG_ENTRIES,
    sparse_share: float = SPARSE_SHARE, cell_products: int = _CELL_PRODUCTS,
) -> DataFrame:
    """Top-k unseen items with a positive product of ``users (user_id, term_id, w)`` and ``items (item_id, term_id, w)``.

    ``entries`` are the (approximate) row counts of both tables, which decide the shape of the blocks;
    ``max_entries`` is the largest number of terms or seen items of one user. Users beyond ``long_entries`` would not fit a cell;
    their products are joined and summed by (user, item) instead, which costs one pass over the item entries each.
    Up to ``sparse_share`` of all pairs, products are formed by users, about ``cell_products`` at a time. Beyond, catalogs of more than
    ``item_block`` items are searched through an index with bounds, smaller ones in blocks.
    """
    if max_entries > long_entries:
        sizes = [table.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")) for table in (users, seen)]
        long_users = sizes[0].unionByName(sizes[1]).filter(F.col("n") > long_entries).select("user_id").distinct()
        scored = (
            users.join(long_users, "user_id", "left_semi")
            .join(items.withColumnRenamed("w", "wi"), "term_id")
            .groupBy("user_id", "item_id")
            .agg(F.round(F.sum(F.col("w") * F.col("wi")), 10).alias("score"))
        )
        long = top_k(drop_seen(scored.filter("score > 0"), seen), k, [F.desc("score"), F.asc("item_id")])
        short = sparse_top_k(
            users.join(long_users, "user_id", "left_anti"), items, seen.join(long_users, "user_id", "left_anti"), k, n_users, n_items,
            0, entries, user_block, item_block, sparse_share=sparse_share, cell_products=cell_products,
        )
        return short.unionByName(long.select(short.columns))
    n_products = products(users, items)
    if n_products <= sparse_share * n_users * n_items:
        return _by_user(users, items, seen, k, n_products, cell_products, entries[1])
    if n_items > item_block:
        return top_k_in_reach(users, items, seen, k, entries)
    gu, gi = _grid(users, n_users, n_items, *entries, user_block, item_block)
    left = users.select(
        _spread("user_id", gu).alias("ub"), _all_blocks(gi).alias("ib"), F.lit(False).alias("is_seen"), "user_id",
        F.lit(0).cast("long").alias("item_id"), "term_id", "w",
    ).unionByName(
        seen.select(
            _spread("user_id", gu).alias("ub"), _spread("item_id", gi).alias("ib"), F.lit(True).alias("is_seen"), "user_id",
            "item_id", F.lit(0).cast("long").alias("term_id"), F.lit(0.0).alias("w"),
        )
    )
    right = items.select(_all_blocks(gu).alias("ub"), _spread("item_id", gi).alias("ib"), "item_id", "term_id", "w")
    return _run(left, right, gu * gi, _sparse_cell(k, True), k)
