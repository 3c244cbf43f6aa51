"""Factor training in strata: blocks of (users x items) that share no factor row are trained side by side, step by step.

Users and items are hashed to ``n`` blocks each. In stratum s, user block b meets item block (b + s) mod n, so every factor row has one
owner and steps need no global sums; after n strata all pairs were met. Between strata only factor rows move. Inside a block, item
factors are held, users stream past in bounded chunks with their pairs, and a step takes a few hundred pairs.

A pair's negative is drawn from the pair's own item block, where the user's whole history lies in the same task. Item blocks are hashed anew every
epoch, so over epochs negatives come from the whole catalog. Factors depend on the data, the seed and ``n``, not on cores or partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, durable

# Pairs of a chunk of users that a task holds at once, and pairs per step.
CHUNK_PAIRS = 65536
STEP_PAIRS = 256
_ATTEMPTS = 8

_STATE = "kind int, id bigint, other bigint, m double, factors array<double>, bias double"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def draw_unseen(u: np.ndarray, seen_u: np.ndarray, seen_i: np.ndarray, n_items: int, salt: np.ndarray) -> np.ndarray:
    """An item number below ``n_items`` per entry of ``u`` that ``(seen_u, seen_i)`` does not hold, by hash of ``salt``; -1 if there is none."""
    keys = np.unique(seen_u.astype("int64") * n_items + seen_i)
    out = np.full(len(u), -1, "int64")
    left = np.arange(len(u))
    for attempt in range(_ATTEMPTS):
        if not len(left):
            return out
        j = (_mix(salt[left] + np.uint64(attempt)) % np.uint64(n_items)).astype("int64")
        at = u[left] * n_items + j
        free = keys[np.minimum(np.searchsorted(keys, at), len(keys) - 1)] != at
        out[left[free]] = j[free]
        left = left[~free]
    for e in left.tolist():  # users who have seen almost all items of the block
        lo, hi = np.searchsorted(keys, [u[e] * n_items, (u[e] + 1) * n_items])
        if hi - lo < n_items:
            rest = np.setdiff1d(np.arange(n_items), keys[lo:hi] - u[e] * n_items, assume_unique=True)
            out[e] = rest[int(_mix(salt[e : e + 1])[0]) % len(rest)]
    return out


def _step(sums: Callable, u, i, other, m, P, bu, Q, bi, lr: float, reg: float, pairwise: bool) -> None:
    """One step on a few pairs, on the factor rows they touch; no longer than the curvature allows."""
    uu, u = np.unique(u, return_inverse=True)
    both = np.concatenate([i, other]) if pairwise else i
    ii, at = np.unique(both, return_inverse=True)
    last = at[len(i) :] if pairwise else other
    users, items = sums((u, at[: len(i)], last, m), P[uu], Q[ii], bu[uu], bi[ii], reg)
    for rows, factors, bias, (f, b, h, hb) in ((uu, P, bu, users), (ii, Q, bi, items)):
        factors[rows] += f * (lr / np.maximum(1.0, h * lr))[:, None]
        bias[rows] += b * lr / np.maximum(1.0, hb * lr)


def _train_chunk(sums, pairwise: bool, ids, U, bu, owner, items, m, item_ids, Q, bi, lr: float, reg: float, salt: int) -> None:
    """All pairs of a chunk of users, in hashed order; ``U``, ``bu``, ``Q`` and ``bi`` move in place."""
    if not len(owner):
        return
    key = _mix(ids[owner].astype("u8") * np.uint64(0x9E3779B97F4A7C15) + item_ids[items].astype("u8") + np.uint64(salt))
    negative = draw_unseen(owner, owner, items, len(item_ids), key)
    order = np.argsort(key, kind="stable")
    order = order[negative[order] >= 0]
    for a in range(0, len(order), STEP_PAIRS):
        o = order[a : a + STEP_PAIRS]
        if pairwise:
            _step(sums, owner[o], items[o], negative[o], m[o], U, bu, Q, bi, lr, reg, True)
        else:
            both = np.concatenate([items[o], negative[o]])
            label = np.repeat([1.0, 0.0], len(o))
            _step(sums, np.tile(owner[o], 2), both, label, np.tile(m[o], 2), U, bu, Q, bi, lr, reg, False)


def _stratum(sums: Callable, pairwise: bool, k: int, lr: float, reg: float, salt: int):
    """A task: item rows (kind 0) first, then per user the factor row (kind 1) and the pairs (kind 2); returns the moved rows."""

    def rows_out(kind: int, ids, factors, bias) -> pa.RecordBatch:
        n = len(ids)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(factors.ravel()))
        columns = [pa.array(np.full(n, kind, "int32")), pa.array(ids), pa.array(np.zeros(n, "int64")), pa.array(np.zeros(n)), flat, pa.array(bias)]
        return pa.RecordBatch.from_arrays(columns, ["kind", "id", "other", "m", "factors", "bias"])

    def factors_of(table: pa.Table):
        flat = table.column("factors").combine_chunks()
        flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
        return table.column("id").to_numpy().copy(), flat.flatten().to_numpy().reshape(-1, k).copy(), table.column("bias").to_numpy().copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[pa.RecordBatch] = []
        held: list[pa.RecordBatch] = []
        state = None

        def chunk(table: pa.Table) -> pa.RecordBatch:
            kinds = table.column("kind").to_numpy()
            ids, U, bu = factors_of(table.filter(pa.array(kinds == 1)))
            pairs = table.filter(pa.array(kinds == 2))
            owner = np.searchsorted(ids, pairs.column("id").to_numpy())
            item = np.searchsorted(state[0], pairs.column("other").to_numpy())
            _train_chunk(sums, pairwise, ids, U, bu, owner, item, pairs.column("m").to_numpy(), *state, lr, reg, salt)
            return rows_out(1, ids, U, bu)

        size = 0
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            n_items = int(np.searchsorted(kinds != 0, True))
            if n_items:
                items.append(batch.slice(0, n_items))
            if n_items == batch.num_rows:
                continue
            if state is None:
                state = factors_of(pa.Table.from_batches(items)) if items else (np.zeros(0, "int64"), np.zeros((0, k)), np.zeros(0))
            held.append(batch.slice(n_items))
            size += held[-1].num_rows
            while size > CHUNK_PAIRS:
                table = pa.Table.from_batches(held)
                # The chunk ends where the first user after CHUNK_PAIRS rows begins.
                starts = np.flatnonzero(table.column("kind").to_numpy()[CHUNK_PAIRS:] == 1)
                if not len(starts):
                    break
                cut = CHUNK_PAIRS + int(starts[0])
                yield chunk(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), size - cut
        if size:
            yield chunk(pa.Table.from_batches(held))
        if state is None and items:
            state = factors_of(pa.Table.from_batches(items))
        if state is not None and len(state[0]):
            yield rows_out(0, *state)

    return run


def _block(column: str, n: int, salt: int):
    return F.pmod(F.xxhash64(column, F.lit(salt)), F.lit(n))


def train_epoch(
    pairs: DataFrame, users: DataFrame, items: DataFrame, sums: Callable, pairwise: bool, k: int, lr: float, reg: float, n: int, epoch: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """One pass over ``pairs (user_id, item_id, m)``; ``users`` and ``items`` are ``(id, factors, bias)``. Returns them moved, written once."""
    salt = seed * 1_000_003 + epoch
    none = F.lit(None)
    state = users.select(F.lit(1).alias("kind"), "id", F.lit(0).cast("long").alias("other"), F.lit(0.0).alias("m"), "factors", "bias").unionByName(
        items.select(F.lit(0).alias("kind"), "id", F.lit(0).cast("long").alias("other"), F.lit(0.0).alias("m"), "factors", "bias")
    )
    met = pairs.select(
        F.lit(2).alias("kind"), F.col("user_id").alias("id"), F.col("item_id").alias("other"), F.col("m").cast("double").alias("m"),
        none.cast("array<double>").alias("factors"), none.cast("double").alias("bias"),
    )
    place, owner = _block("id", n, seed), _block("id", n, salt)
    stratum = F.pmod(_block("other", n, salt) - place, F.lit(n))
    # Pairs are dealt to their strata once, in files of their own.
    met = durable(met.withColumn("block", place.cast("int")).withColumn("stratum", stratum.cast("int")).repartition(n, "stratum"))
    for s in range(n):
        block = F.when(F.col("kind") == 0, F.pmod(owner - s, F.lit(n))).otherwise(place).cast("int")
        now = state.withColumn("block", block).unionByName(met.filter(F.col("stratum") == s).drop("stratum"))
        # One task per block; items come first, then every user's factors before the user's pairs.
        first = F.when(F.col("kind") == 0, 0).otherwise(1)
        dealt = now.withColumn("first", first).repartitionById(n, "block").sortWithinPartitions("first", "id", "kind", "other").drop("first", "block")
        state = dealt.mapInArrow(_stratum(sums, pairwise, k, lr, reg, salt * n + s), _STATE)
    state = durable(state)
    discard(met)
    moved = state.filter("kind = 1").select("id", "factors", "bias"), state.filter("kind = 0").select("id", "factors", "bias")
    for table in moved:
        table._written_to = state._written_to
    return moved
