"""Exact top-k of sparse user-item products over an index in files, whose blocks of similar items are skipped by bounds.

Items lie in the order of their terms, the most frequent ones first, so that neighbours share terms, and are cut into blocks of 4. A segment
of the index holds some thousand blocks: the items' entries, and per block and term the largest and the smallest weight. A user's products
with those, added up, bound all scores of a block; only blocks that can still reach the user's k-th score are multiplied.

Users are dealt to cells once and a cell reads the index, segment by segment, from the shared folder: nothing is sent per user and block.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import attempt_name, create, mapped, new_folder
from ..session import durable, in_cells

# Items whose scores share one bound.
BLOCK = 4
# Entries of a segment and of a range of items that one task indexes.
_SEGMENT_ENTRIES = 1 << 19
_RANGE_ENTRIES = 1 << 21
# Terms of an item that its place in the order depends on.
_ORDER_TERMS = 24
# Rows of users and seen pairs in a cell, on average; users, bounds and weights of one strip of it.
_CELL_ROWS = 1 << 19
_STRIP_USERS = 512
_STRIP_CELLS = 1 << 23
# Item entries multiplied at once, and bytes of segments that a cell keeps open.
_EXPAND = 1 << 21
_OPEN_BYTES = 1 << 28
# Scores kept before they are cut to the k best.
_MOST_FOUND = 1 << 20
# Blocks of a user met first in a segment, and how many that are still in reach, on average, are met at once.
_FIRST = 32
_FEW = 512
# Terms in more than this share of a strip's (user, block) pairs are multiplied as dense columns.
_DENSE_SHARE = 1 / 256
_DENSE_COLUMNS = 512
# Scores are rounded to 10 decimals; a bound closer than this decides nothing.
_SLACK = 1e-8

_KINDS = {
    "ids": "<i8", "ptr": "<i8", "term": "<i4", "w": "<f8", "terms": "<i8", "bterm": "<i4", "bblock": "<i4", "high": "<f8", "low": "<f8",
}


class Index(NamedTuple):
    folder: str
    # Name and number of blocks (leaves of dense vectors) of every segment.
    segments: list[tuple[str, int]]


def _segment(ids: np.ndarray, sizes: np.ndarray, term: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a segment; entries of an item are adjacent."""
    terms, local = np.unique(term, return_inverse=True)
    block = np.repeat(np.arange(len(ids)) // BLOCK, sizes)
    order = np.lexsort((block, local))
    t, b, v = local[order], block[order], w[order]
    first = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (b[1:] != b[:-1])])
    return {
        "ids": ids, "ptr": np.r_[0, np.cumsum(sizes)], "term": local, "w": w, "terms": terms, "bterm": t[first], "bblock": b[first],
        "high": np.maximum(np.maximum.reduceat(v, first), 0), "low": np.minimum(np.minimum.reduceat(v, first), 0),
    }


def build(items: DataFrame, n_entries: int) -> Index:
    """Index ``items (item_id, term_id, w)``, one row per item and term; ``n_entries`` is about their number."""
    folder = new_folder(items.sparkSession, "reach")
    often = items.groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct((-F.col("n")).alias("n"), "term_id", F.col("w").cast("double").alias("w"))
    # An item's entries are those of one document.
    listed = items.join(often, "term_id").groupBy("item_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    key = F.transform(F.slice("e", 1, _ORDER_TERMS), lambda x: F.struct(x["n"], x["term_id"]))
    keyed = listed.select("item_id", F.col("e.term_id").alias("terms"), F.col("e.w").alias("ws"), key.alias("key"))
    parts = max(1, ceil(n_entries / _RANGE_ENTRIES))
    ordered = keyed.repartitionByRange(parts, "key", "item_id").sortWithinPartitions("key", "item_id").select("item_id", "terms", "ws")

    def save(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids, lists = rows.column("item_id").to_numpy(), rows.column("terms").chunk(0)
        term, w = lists.flatten().to_numpy(), rows.column("ws").chunk(0).flatten().to_numpy()
        name = attempt_name(TaskContext.get().partitionId())
        for kind, data in _segment(ids, lists.value_lengths().to_numpy().astype("int64"), term, w).items():
            with create(folder, f"{name}.{kind}") as f:
                f.write(np.ascontiguousarray(data, _KINDS[kind]).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([ceil(len(ids) / BLOCK)], pa.int64())], ["name", "blocks"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy())
            a = 0
            while a < batch.num_rows:
                before = int(ends[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(ends, before + _SEGMENT_ENTRIES - n, side="right")))
                held.append(batch.slice(a, b - a))
                n += int(ends[b - 1]) - before
                a = b
                if n >= _SEGMENT_ENTRIES or a < batch.num_rows:
                    yield save(held)
                    held, n = [], 0
        if held:
            yield save(held)

    manifest = durable(ordered.mapInArrow(write, "name string, blocks bigint"))
    # One row per segment of some 500,000 entries.
    return Index(folder, [(r["name"], r["blocks"]) for r in manifest.orderBy("name").collect()])


class _Segments:
    """Segments as they are asked for; those used last stay open up to a number of bytes."""

    def __init__(self, index: Index, kinds: dict[str, str] = _KINDS):
        self.index = index
        self.kinds = kinds
        self.open: OrderedDict[int, dict[str, np.ndarray]] = OrderedDict()

    def __getitem__(self, s: int) -> dict[str, np.ndarray]:
        if s not in self.open:
            name = self.index.segments[s][0]
            self.open[s] = {kind: mapped(self.index.folder, f"{name}.{kind}", dtype) for kind, dtype in self.kinds.items()}
            while len(self.open) > 1 and sum(a.nbytes for x in self.open.values() for a in x.values()) > _OPEN_BYTES:
                self.open.popitem(last=False)
        self.open.move_to_end(s)
        return self.open[s]


def places(terms: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each asked term in the sorted ``terms``, -1 where it is missing."""
    at = np.minimum(np.searchsorted(terms, asked), len(terms) - 1)
    return np.where(terms[at] == asked, at, -1)


def _bounds(seg: dict[str, np.ndarray], blocks: int, n: int, u: np.ndarray, t: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``(user, block)``: what no score of the user in the block exceeds; ``t`` are places among the segment's terms, -1 where missing."""
    out = np.zeros((n, blocks), "float32")
    counts = np.bincount(seg["bterm"], minlength=len(seg["terms"]))
    starts = np.cumsum(counts) - counts
    for side, wanted in (("high", w > 0), ("low", w < 0)):
        keep = np.flatnonzero(wanted & (t >= 0))
        if not len(keep) or side == "low" and not seg["low"].any():
            continue
        pairs = np.bincount(t[keep], minlength=len(counts)) * counts
        dense = np.flatnonzero(pairs > _DENSE_SHARE * n * blocks)
        for a in range(0, len(dense), _DENSE_COLUMNS):
            terms = dense[a : a + _DENSE_COLUMNS]
            place = np.full(len(counts), -1)
            place[terms] = np.arange(len(terms))
            left, right = np.zeros((n, len(terms)), "float32"), np.zeros((len(terms), blocks), "float32")
            mine = keep[place[t[keep]] >= 0]
            left[u[mine], place[t[mine]]] = w[mine]
            held = np.flatnonzero(place[seg["bterm"]] >= 0)
            right[place[seg["bterm"][held]], seg["bblock"][held]] = seg[side][held]
            out += left @ right
        rest = np.ones(len(counts), bool)
        rest[dense] = False
        keep = keep[rest[t[keep]]]
        ends = np.cumsum(counts[t[keep]])
        a = 0
        while a < len(keep):
            z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _EXPAND, side="right")))
            reps = counts[t[keep[a:z]]]
            entry = np.repeat(starts[t[keep[a:z]]] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
            value = np.repeat(w[keep[a:z]], reps) * seg[side][entry]
            np.add.at(out.reshape(-1), np.repeat(u[keep[a:z]], reps) * blocks + seg["bblock"][entry], value.astype("float32"))
            a = z
    return out


def _scores(seg: dict[str, np.ndarray], row: np.ndarray, block: np.ndarray, place: np.ndarray, weights: np.ndarray) -> Iterator[tuple]:
    """Rows, items and rounded scores of (user, block) pairs in bounded pieces; ``weights`` is (user, term) with a last column of zeros,
    ``place`` its column for each of the segment's terms."""
    low, high = block * BLOCK, np.minimum((block + 1) * BLOCK, len(seg["ids"]))
    from_, to = seg["ptr"][low], seg["ptr"][high]
    ends = np.cumsum(to - from_)
    flat, width = weights.reshape(-1), weights.shape[1]
    a = 0
    while a < len(row):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _EXPAND, side="right")))
        reps = to[a:z] - from_[a:z]
        entry = np.repeat(from_[a:z] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
        value = flat[np.repeat(row[a:z] * width, reps) + place[seg["term"][entry]]] * seg["w"][entry]
        n = high[a:z] - low[a:z]
        item = np.repeat(low[a:z] - np.cumsum(n) + n, n) + np.arange(n.sum())
        begin = seg["ptr"][item] + np.repeat(np.cumsum(reps) - reps - from_[a:z], n)
        yield np.repeat(row[a:z], n), seg["ids"][item], np.round(np.add.reduceat(value, begin), 10)
        a = z


def _best(row: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((item, -score, row))
    row, item, score = row[order], item[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    return row[keep], item[keep], score[keep], rank[keep]


def _strip(segments: _Segments, n: int, u: np.ndarray, t: np.ndarray, w: np.ndarray, seen_u: np.ndarray, seen_i: np.ndarray, k: int):
    """``(row, item, score, rank)`` of a few users ``0..n-1`` with the terms ``t``."""
    terms, t = np.unique(t, return_inverse=True)
    weights = np.zeros((n, len(terms) + 1))
    weights[u, t] = w
    known = np.unique(seen_i)
    seen = np.sort(seen_u * len(known) + np.searchsorted(known, seen_i))
    best = tuple(np.zeros(0, x) for x in ("int64", "int64", "float64", "int64"))
    needed = np.zeros(n)
    # Bounds are sums of at most that many products in single precision.
    margin = 1 + (len(terms) + 8) * 2.0**-22

    def keep_best(found: list) -> tuple:
        kept = _best(*(np.concatenate(x) for x in zip(*found, strict=True)), k)
        last = kept[3] == k - 1
        needed[kept[0][last]] = kept[2][last]
        return kept

    for s, (_, blocks) in enumerate(segments.index.segments):
        seg = segments[s]
        bounds = _bounds(seg, blocks, n, u, places(seg["terms"], terms)[t], w)
        place = places(terms, seg["terms"])
        first = _FIRST
        while True:
            limit = ((needed - _SLACK) / margin).astype("float32")
            row, block = np.divmod(np.flatnonzero(bounds > np.maximum(limit, 0)[:, None]), blocks)
            if not len(row):
                break
            if len(row) > _FEW * n and blocks > first:
                nearest = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
                row, block = np.repeat(np.arange(n), first), nearest.reshape(-1)
                reached = bounds[row, block] > np.maximum(limit, 0)[row]
                row, block = row[reached], block[reached]
            bounds[row, block] = 0
            found, n_found = [best[:3]], 0
            for r, item, score in _scores(seg, row, block, place, weights):
                if n_found > _MOST_FOUND:
                    best = keep_best(found)
                    found, n_found = [best[:3]], 0
                keep = (score > 0) & (score >= needed[r])
                r, item, score = r[keep], item[keep], score[keep]
                if len(known):
                    at = places(known, item)
                    key = r * len(known) + at
                    keep = (at < 0) | (seen[np.minimum(np.searchsorted(seen, key), len(seen) - 1)] != key)
                    r, item, score = r[keep], item[keep], score[keep]
                found.append((r, item, score))
                n_found += len(r)
            best = keep_best(found)
            first *= 4
    return best


def _cell(index: Index, k: int) -> Callable:
    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        kinds, who, what = (rows.column(c).to_numpy() for c in ("is_seen", "user_id", "id"))
        mine = np.flatnonzero(~kinds)
        mine = mine[np.argsort(who[mine], kind="stable")]
        users, u = np.unique(who[mine], return_inverse=True)
        t, w = what[mine], rows.column("w").to_numpy()[mine]
        seen = np.flatnonzero(kinds)
        seen_u = places(users, who[seen]) if len(users) else np.full(len(seen), -1)
        seen, seen_u = seen[seen_u >= 0], seen_u[seen_u >= 0]
        order = np.argsort(seen_u, kind="stable")
        seen_u, seen_i = seen_u[order], what[seen][order]
        segments = _Segments(index)
        most = max(1, min(_STRIP_USERS, _MOST_FOUND // max(k, 1), _STRIP_CELLS // max([1, *(blocks for _, blocks in index.segments)])))
        a = 0
        while a < len(users) and index.segments:
            n = min(most, len(users) - a)
            lo, hi = np.searchsorted(u, [a, a + n])
            while n > 1 and n * len(np.unique(t[lo:hi])) > _STRIP_CELLS:
                n //= 2
                hi = np.searchsorted(u, a + n)
            s, e = np.searchsorted(seen_u, [a, a + n])
            row, item, score, rank = _strip(segments, n, u[lo:hi] - a, t[lo:hi], w[lo:hi], seen_u[s:e] - a, seen_i[s:e], k)
            # The lists of a strip leave at once: a cell holds as many users as their terms allow, however long their lists are.
            out = [pa.array(x) for x in (users[row + a], item, (rank + 1).astype("int32"), score)]
            yield pa.RecordBatch.from_arrays(out, ["user_id", "item_id", "rank", "score"])
            a += n

    return cell


def top_k_in_reach(users: DataFrame, items: DataFrame, seen: DataFrame, k: int, entries: tuple[int, int], cell_rows: int = _CELL_ROWS) -> DataFrame:
    """Top-k unseen items with a positive product of ``users (user_id, term_id, w)`` and ``items (item_id, term_id, w)``.

    Rows are one per user and term, and per item and term; ``entries`` are the (approximate) row counts of both tables.
    """
    index = build(items, entries[1])
    cells = max(2 * users.sparkSession.sparkContext.defaultParallelism, ceil(entries[0] / cell_rows))
    ub = F.pmod(F.xxhash64("user_id"), F.lit(cells)).cast("int").alias("ub")
    left = users.select(ub, F.lit(False).alias("is_seen"), "user_id", F.col("term_id").alias("id"), F.col("w").cast("double").alias("w"))
    left = left.unionByName(
        seen.select(ub, F.lit(True).alias("is_seen"), "user_id", F.col("item_id").alias("id"), F.lit(0.0).alias("w"))
    )
    schema = "user_id bigint, item_id bigint, rank int, score double"
    return in_cells(left, "ub", cells).groupBy("ub").applyInArrow(_cell(index, k), schema)
