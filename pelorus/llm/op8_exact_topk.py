"""Exact top-k inner products from an impact-ordered index, scored one impact level at a time.

Component x becomes the integer impact floor(64 x). The index deals the rows out to equal blocks, one file set each:
postings (position in the block's dimension x row grid, impact) sorted by descending magnitude, cut into segments
between levels of magnitude, and the plain rows for rescoring. A task takes a bounded chunk of queries past all blocks. Within
a block it adds segments in order; what is still missing from a score is at most ``sum over d of |q_d| * (largest impact
left in dimension d)``, and at most the query's norm times the norm of the row's unread impacts. A query stops as soon as that bound leaves so few rows that rescoring them is less work than the unread
postings; its possible members are rescored exactly, and the k best carried on, whose worst score is the bar for the next block. No
row is dropped without that proof.

Edge cases: vectors that are null, or hold null or non-finite components, take no part; shorter vectors count as padded
with zeros; an empty vector scores 0 everywhere. Rows equal in id and vector count once; other rows with the same id
are candidates and queries of their own. A row never finds its own id. Fewer than k candidates: all of them. Rows with a
null id take no part. Products must fit 64 bits.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import attempt_name, create, mapped, new_folder
from ..session import durable


def impacts(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, q)``: distinct usable rows with integer components."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & ~bad)
    q = F.transform(x, lambda v: F.floor(v.cast("double") * 64).cast("long"))
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), q.alias("q")).distinct()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), "int64")
    flat = column.values.slice(column.offsets[0].as_py(), int(sizes.sum())).to_numpy(zero_copy_only=False)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


# Shares of a block's postings after which a segment ends, at the next border between magnitudes.
_SHARES = (0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


class ImpactIndex:
    """``blocks``: per block its file name, row count, and the end posting of every segment; files hold, per segment, the largest
    impact left in each dimension and the norm of each row's unread impacts."""

    def __init__(self, folder: str, width: int, blocks: list[tuple[str, int, list[int]]]):
        self.folder, self.width, self.blocks = folder, width, blocks


def build(rows: DataFrame, block_rows: int = 16384) -> ImpactIndex:
    """Index all ``(vec_id, q)`` rows; dealt out evenly, so equal or frequent vectors make no large block."""
    spark = rows.sparkSession
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    width = max(width, 1)
    folder = new_folder(spark, "impacts")

    def write(batches):
        ids, parts = [], []
        for b in batches:
            if b.num_rows:
                ids.append(b.column(0).to_numpy())
                parts.append(_matrix(b.column(1), width))
        if not ids:
            return
        ids, rows = np.concatenate(ids), np.concatenate(parts)
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], rows[order]
        grid = np.ascontiguousarray(rows.T)
        flat = np.abs(grid.ravel())
        posting = np.argsort(-flat, kind="stable")[: int((flat > 0).sum())]
        least = sorted({int(flat[posting[ceil(x * len(posting)) - 1]]) for x in _SHARES}, reverse=True) if len(posting) else []
        ends = [int((flat >= m).sum()) for m in least]
        left = [np.where(np.abs(grid) < m, np.abs(grid), 0).max(axis=1) for m in least]
        tail = [np.sqrt((np.where(np.abs(grid) < m, grid, 0).astype("float64") ** 2).sum(axis=0)) for m in least]
        name = attempt_name(TaskContext.get().partitionId())
        for kind, data in (
            ("ids", ids.astype("<i8")), ("rows", rows.astype("<i8")), ("pos", posting.astype("<i8")), ("val", grid.ravel()[posting].astype("<i8")),
            ("left", np.array(left, "<i8").reshape(len(least), width)), ("tail", np.array(tail, "<f8").reshape(len(least), len(ids))),
        ):
            with create(folder, f"{name}.{kind}") as f:
                f.write(data.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([len(ids)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], ["name", "n", "ends"]
        )

    dealt = rows.repartition(max(1, ceil(n / block_rows)))
    manifest = durable(dealt.mapInArrow(write, "name string, n bigint, ends array<bigint>"))
    # One row per block of ``block_rows`` vectors.
    return ImpactIndex(folder, width, [(r["name"], r["n"], list(r["ends"])) for r in manifest.orderBy("name").collect()])


def _block_members(index, block, ids, queries, k, bars):
    """``(query row, vec_id, score)`` arrays with the k best of one block per query and all that tie with the last, and the
    postings each query has read."""
    name, n, ends = block
    docs = mapped(index.folder, f"{name}.ids", "<i8")
    rows = mapped(index.folder, f"{name}.rows", "<i8").reshape(n, index.width)
    total = ends[-1] if ends else 0
    read = np.full(len(queries), total)
    who, doc, exact = [np.zeros(0, "int64")], [np.zeros(0, "int64")], [np.zeros(0, "int64")]

    def rescore(q: np.ndarray, d: np.ndarray) -> None:
        score = np.zeros(len(q), "int64")
        for a in range(0, len(q), 1 << 16):
            s = slice(a, a + (1 << 16))
            score[s] = (queries[q[s]] * rows[d[s]]).sum(axis=1)
        who.append(q)
        doc.append(d)
        exact.append(score)

    if total:
        pos, val = mapped(index.folder, f"{name}.pos", "<i8"), mapped(index.folder, f"{name}.val", "<i8")
        left = mapped(index.folder, f"{name}.left", "<i8").reshape(len(ends), index.width)
        tail = mapped(index.folder, f"{name}.tail", "<f8").reshape(len(ends), n)
    else:  # a block of zero vectors has no segment
        rescore(*np.nonzero(ids[:, None] != docs[None, :]))
    weight, norm = np.abs(queries), np.sqrt((queries.astype("float64") ** 2).sum(axis=1))
    bound = int(weight.sum(axis=1).max(initial=0)) * (int(abs(val[0])) if total else 0)
    kind = "float32" if bound < 1 << 24 else "float64" if bound < 1 << 53 else "int64"
    least = -(1 << 62) if kind == "int64" else -np.inf
    acc = np.zeros((len(queries), n), kind)
    own = ids[:, None] == docs[None, :]
    take, start = min(k, n), 0
    active = np.arange(len(queries))
    for segment, end in enumerate(ends):
        slab = np.zeros(index.width * n, kind)
        slab[pos[start:end]] = val[start:end]
        acc[active] += queries[active].astype(kind) @ slab.reshape(index.width, n)
        start = end
        rest = (weight[active] @ left[segment]).astype("float64")
        mine = np.where(own[active], least, acc[active])
        unread = total - end
        who_can = np.arange(len(active))
        if unread:
            # Where a bound cannot even exclude the average row, no member is looked for yet.
            typical = np.minimum(rest, norm[active] * np.median(tail[segment]))
            who_can = np.flatnonzero(2 * typical < mine.max(axis=1) - acc[active].mean(axis=1))
            if not len(who_can):
                continue
        here = active[who_can]
        mine = mine[who_can]
        if unread:
            # Rounded up, since the norms are floating-point numbers.
            missing = np.minimum(rest[who_can][:, None], norm[here][:, None] * tail[segment][None, :] * (1 + 1e-9) + 1)
            low, high = mine - missing, mine + missing
        else:
            low = high = mine
        floor = np.partition(low, n - take, axis=1)[:, n - take]
        if bars is not None:
            floor = np.maximum(floor, bars[here].astype("int64" if kind == "int64" and not unread else "float64"))
        possible = (high >= floor[:, None]) & ~own[here]
        stops = possible.sum(axis=1) * index.width <= unread if unread else np.ones(len(who_can), bool)
        q, d = np.nonzero(possible[stops])
        q = here[stops][q]
        if unread:
            rescore(q, d)
            read[here[stops]] = end
            active = np.delete(active, who_can[stops])
            if not len(active):
                break
        else:
            who.append(q)
            doc.append(d)
            exact.append(acc[q, d].astype("int64"))
    return np.concatenate(who), docs[np.concatenate(doc)], np.concatenate(exact), read


def _best(who, found, score, k):
    """The k best per query row, by score and then smaller id."""
    order = np.lexsort((found, -score, who))
    who, found, score = who[order], found[order], score[order]
    first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, "int64")
    rank = np.arange(len(who)) - np.repeat(first, np.diff(np.r_[first, len(who)]))
    keep = rank < k
    return who[keep], found[keep], score[keep], rank[keep] + 1


def search(index: ImpactIndex, queries: DataFrame, k: int = 20, chunk: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every ``(vec_id, q)`` row in ``queries``."""
    spark = queries.sparkSession
    n = queries.count()
    tasks = max(1, min(n, max(ceil(n / chunk), spark.sparkContext.defaultParallelism)))
    width = index.width

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, chunk):
                part = b.slice(a, chunk)
                ids = part.column(0).to_numpy()
                # A query component beyond the index's width meets zeros only.
                q = _matrix(part.column(1), max(width, int(np.diff(part.column(1).offsets.to_numpy()).max())))[:, :width]
                who, found, score, rank = (np.zeros(0, "int64") for _ in range(4))
                for block in index.blocks:
                    bars = None
                    full = np.bincount(who, minlength=len(ids)) == k
                    if full.any():
                        bars = np.full(len(ids), -(1 << 62), "int64")
                        bars[full] = score[np.r_[who[1:] != who[:-1], True]][full[np.unique(who)]]
                    new = _block_members(index, block, ids, q, k, bars)[:3]
                    who, found, score, rank = _best(*(np.concatenate(x) for x in zip((who, found, score), new, strict=True)), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[who]), pa.array(rank.astype("int32")), pa.array(found), pa.array(score)], ["query_id", "rank", "vec_id", "score"]
                )

    return queries.repartition(tasks).mapInArrow(run, "query_id bigint, rank int, vec_id bigint, score bigint")


SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM scored
)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM ranked WHERE k <= 20
"""
