"""Hard negatives by Four-Russians scoring: subset-sum tables of anchors, looked up with bit-plane bytes of candidates.

Component x becomes the integer floor(256 x). The index holds every row: sorted by label, cut into blocks of one label each,
and within a block packed into bit planes: the byte ``planes[p, g, row]`` holds bit p (two's complement) of the row's dimensions
8g .. 8g+7. A task takes a bounded chunk of anchors. For each group of eight dimensions it computes, once, the
sums of all 256 subsets of an anchor's components; the inner product with a candidate is then one lookup per plane and group, added up from
the sign plane down with a shift by one bit between planes. Scores are complete and exact, nothing is estimated.

Every (anchor, row) pair is scored once: anchors meet the blocks of their own label for their positives, then the blocks of all
other labels for negatives, where positives' scores set the windows. The grid of work is anchor chunks x stripes of at most
``STRIPE_BLOCKS`` blocks, so a task's work is bounded at any size; a task hands back its best few rows per
anchor, and a window joins the stripes.

Edge cases: rows with a null id, label or vector, or a null or non-finite component, take no part; shorter vectors count as
padded with zeros. Rows equal in id, label and vector count once; rows that share only the id are rows of their own, but a row
never is its own id's positive. Anchors without positives, and positives without a negative in their window, return nothing
(a negative positive score has an empty window). An empty table returns no rows. Products must fit 64 bits.
"""

from __future__ import annotations

import io
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..files import attempt_name, create, mapped, new_folder
from ..session import durable
from .common import tidy

BLOCK_ROWS = 16384
STRIPE_BLOCKS = 64
_TILE = 1024
_GROUP = 256
_TABLE_BYTES = 64 << 20
_NONE = -(1 << 62)


def prepare(vectors: DataFrame, label: Column, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, label, q)``: distinct usable rows with integer components, written once."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = vectors.withColumn("_label", label).filter(F.col(id_col).isNotNull() & F.col("_label").isNotNull() & x.isNotNull() & ~bad)
    q = F.transform(x, lambda v: F.floor(v.cast("double") * 256).cast("long"))
    return durable(usable.select(F.col(id_col).cast("long").alias("vec_id"), F.col("_label").cast("long").alias("label"), q.alias("q")).distinct())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), "int64")
    flat = column.values.slice(column.offsets[0].as_py(), int(sizes.sum())).to_numpy(zero_copy_only=False)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def pack_planes(rows: np.ndarray) -> np.ndarray:
    """Bit planes ``(planes, groups, rows)`` of integer rows; the last plane is the sign's."""
    n, width = rows.shape
    extent = np.where(rows < 0, ~rows, rows)
    bits = int(extent.max(initial=0)).bit_length() + 1
    padded = np.zeros((n, -(-width // 8) * 8), "int64")
    padded[:, :width] = rows
    planes = [np.packbits(((padded >> p) & 1).astype("u1"), axis=1, bitorder="little").T for p in range(bits)]
    return np.ascontiguousarray(np.stack(planes))


def subset_sums(anchors: np.ndarray, kind: str) -> np.ndarray:
    """``(groups, 256, anchors)``: for eight dimensions at a time, the sum of the components a byte's bits name."""
    m, width = anchors.shape
    groups = -(-width // 8)
    padded = np.zeros((m, groups * 8), kind)
    padded[:, :width] = anchors
    out = np.zeros((groups, 256, m), kind)
    for g in range(groups):
        for i in range(8):
            out[g, 1 << i : 2 << i] = out[g, : 1 << i] + padded[:, 8 * g + i]
    return out


def lookup_scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products ``(rows, anchors)`` by shift-added lookups."""
    out = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    found = np.empty_like(out)
    top = len(planes) - 1
    for p in range(top, -1, -1):
        if p < top:
            out += out
        for table, bytes_ in zip(tables, planes[p], strict=True):
            np.take(table, bytes_, axis=0, out=found, mode="clip")
            if p == top:
                out -= found
            else:
                out += found
    return out


class Best:
    """The k best (score, smaller id first) per slot, over tiles of scores."""

    def __init__(self, slots: int, k: int):
        self.k, self.bar = k, np.full(slots, _NONE, "int64")
        self.who, self.ids, self.scores = (np.zeros(0, "int64") for _ in range(3))

    def offer(self, slots: np.ndarray, ids: np.ndarray, scores: np.ndarray, allowed: np.ndarray) -> None:
        """``scores[row, i]`` belong to slot ``slots[i]``; entries outside ``allowed`` are not members."""
        bar = self.bar[slots]
        if (bar == _NONE).any() and len(ids) > self.k:
            # No full slot yet: the tile's own k-th score is a bar.
            held = np.where(allowed, scores, _NONE)
            bar = np.maximum(bar, np.partition(held, len(ids) - self.k, axis=0)[len(ids) - self.k])
        row, i = np.nonzero(allowed & (scores >= bar[None, :]))
        if not len(row):
            return
        who = np.concatenate([self.who, slots[i]])
        found, score = np.concatenate([self.ids, ids[row]]), np.concatenate([self.scores, scores[row, i].astype("int64")])
        order = np.lexsort((found, -score, who))
        who, found, score = who[order], found[order], score[order]
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        rank = np.arange(len(who)) - np.repeat(first, np.diff(np.r_[first, len(who)]))
        keep = rank < self.k
        self.who, self.ids, self.scores = who[keep], found[keep], score[keep]
        full = rank == self.k - 1
        self.bar[who[full]] = score[full]


class PlaneIndex:
    """``blocks``: ``(file name, label, rows, planes)`` in order of labels; one entry per ``BLOCK_ROWS`` vectors or label."""

    def __init__(self, folder: str, width: int, blocks: list[tuple[str, int, int, int]]):
        self.folder, self.width, self.blocks = folder, width, blocks

    def read(self, block) -> tuple[np.ndarray, np.ndarray]:
        name, _, n, planes = block
        ids = mapped(self.folder, f"{name}.ids", "<i8")
        return ids, mapped(self.folder, f"{name}.planes", "u1").reshape(planes, -1, n)


def build(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> PlaneIndex:
    """Index all ``(vec_id, label, q)`` rows. Rows are range-partitioned by label and id, so a label with a third of all rows is
    many blocks, and a task holds one block at a time."""
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    width = max(width, 1)
    folder = new_folder(rows.sparkSession, "planes")

    def write(batches):
        tidy()
        held: list[pa.RecordBatch] = []

        def block():
            table = pa.Table.from_batches(held).combine_chunks()
            planes = pack_planes(_matrix(table.column("q").chunk(0), width))
            name, label = attempt_name(TaskContext.get().partitionId()), table.column("label")[0].as_py()
            for kind, data in (("ids", table.column("vec_id").to_numpy().astype("<i8")), ("planes", planes)):
                with create(folder, f"{name}.{kind}") as f:
                    f.write(data.tobytes())
            return pa.RecordBatch.from_pylist([{"name": name, "label": label, "n": table.num_rows, "planes": len(planes)}])

        size = 0
        for batch in batches:
            labels = batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), batch.num_rows]
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                while a < z:
                    if held and (size == block_rows or held[0].column(1)[0].as_py() != labels[a]):
                        yield block()
                        held, size = [], 0
                    take = min(z - a, block_rows - size)
                    held.append(batch.slice(a, take))
                    a, size = a + take, size + take
        if held:
            yield block()

    dealt = rows.repartitionByRange(max(1, ceil(n / block_rows)), "label", "vec_id").sortWithinPartitions("label", "vec_id")
    manifest = durable(dealt.mapInArrow(write, "name string, label bigint, n bigint, planes bigint"))
    return PlaneIndex(folder, width, sorted((tuple(r) for r in manifest.collect()), key=lambda r: (r[1], r[0])))


def _chunk_files(index: PlaneIndex, anchors: DataFrame, chunk: int | None) -> tuple[str, list[str]]:
    """Anchor rows ``(uid, vec_id, label, q, floors, ceilings)`` as files of bounded chunks, neighbours in label together."""
    spark = anchors.sparkSession
    n, widest = anchors.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(1))).first()
    width = index.width
    folder = new_folder(spark, "anchors")
    bound = max(1, min(chunk or 1024, _TABLE_BYTES // (-(-width // 8) * 256 * 8)))
    tasks = max(1, min(n, max(ceil(n / bound), spark.sparkContext.defaultParallelism)))

    def write(batches):
        held = []
        for b in batches:
            for a in range(0, b.num_rows, bound):
                held.append(b.slice(a, bound))
                if sum(h.num_rows for h in held) >= bound:
                    yield from flush(held)
                    held = []
        if held:
            yield from flush(held)

    def flush(held):
        t = pa.Table.from_batches(held).combine_chunks()
        data = {c: t.column(c).to_numpy() for c in ("uid", "vec_id", "label")}
        # A component beyond the index's width would meet zeros only.
        data["q"] = _matrix(t.column("q").chunk(0), max(width, widest))[:, :width]
        sizes = np.diff(t.column("floors").chunk(0).offsets.to_numpy())
        slots = int(sizes.max(initial=0))
        data["floors"], data["ceilings"] = (_matrix(t.column(c).chunk(0), slots) for c in ("floors", "ceilings"))
        data["sizes"] = sizes
        out = io.BytesIO()
        np.savez(out, **data)
        name = attempt_name(TaskContext.get().partitionId())
        with create(folder, name) as f:
            f.write(out.getvalue())
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    dealt = anchors.repartitionByRange(tasks, "label", "vec_id", "uid").sortWithinPartitions("label", "vec_id", "uid")
    manifest = durable(dealt.select("uid", "vec_id", "label", "q", "floors", "ceilings").mapInArrow(write, "name string"))
    # One name per chunk.
    return folder, sorted(r["name"] for r in manifest.collect())


def _label_groups(labels: np.ndarray):
    """Slices of equal labels, at most ``_GROUP`` anchors each; the labels are sorted."""
    cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        for s in range(a, z, _GROUP):
            yield slice(s, min(s + _GROUP, z))


def _search(index: PlaneIndex, anchors: DataFrame, k: int, same: bool, chunk: int | None = None, stripe_blocks: int = STRIPE_BLOCKS) -> DataFrame:
    """``(uid, slot, vec_id, score)``: per anchor the k best rows of its own label, other ids only (slot 0), or per window of the
    anchor (slot from 0) the k best rows of other labels inside it. Best over all stripes, with their rank."""
    spark = anchors.sparkSession
    folder, names = _chunk_files(index, anchors, chunk)
    stripes = [index.blocks[a : a + stripe_blocks] for a in range(0, len(index.blocks), stripe_blocks)]
    n = len(names) * len(stripes)
    top_bits = max((b[3] for b in index.blocks), default=1)

    def run(batches):
        tidy()
        for batch in batches:
            for cell in batch.column(0).to_pylist():
                data = np.load(io.BytesIO(mapped(folder, names[cell // len(stripes)], "u1")))
                data = {c: data[c] for c in data.files}
                yield from search(data, stripes[cell % len(stripes)])

    def search(data, blocks):
        groups = list(_label_groups(data["label"]))
        slots = 1 if same else data["floors"].shape[1]
        best = Best(len(data["uid"]) * max(slots, 1), k)
        tables: dict[int, np.ndarray] = {}
        for block in blocks:
            mine = [g for g in groups if (data["label"][g.start] == block[1]) == same]
            if not mine:
                continue
            ids, planes = index.read(block)
            for g in mine:
                if g.start not in tables:
                    q = data["q"][g]
                    reach = int(np.abs(q).sum(axis=1).max(initial=0)) * ((1 << (top_bits - 1)) + 1)
                    tables[g.start] = subset_sums(q, "int32" if reach < 1 << 31 else "int64")
                at = np.arange(g.start, g.stop)
                for a in range(0, len(ids), _TILE):
                    scores = lookup_scores(tables[g.start], planes[:, :, a : a + _TILE])
                    part = ids[a : a + _TILE]
                    if same:
                        best.offer(at, part, scores, part[:, None] != data["vec_id"][g][None, :])
                        continue
                    for j in range(slots):
                        inside = (scores >= data["floors"][g, j]) & (scores <= data["ceilings"][g, j]) & (j < data["sizes"][g])
                        best.offer(at * slots + j, part, scores, inside)
        yield pa.RecordBatch.from_arrays(
            [pa.array(data["uid"][best.who // max(slots, 1)]), pa.array(best.who % max(slots, 1)), pa.array(best.ids), pa.array(best.scores)],
            ["uid", "slot", "vec_id", "score"],
        )

    found = spark.range(0, n, 1, max(n, 1)).mapInArrow(run, "uid bigint, slot bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, index: PlaneIndex | None = None,
    chunk: int | None = None, stripe_blocks: int = STRIPE_BLOCKS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the prepared ``rows`` that ``anchors``
    selects: the best rows of other labels whose score is ``low`` to ``high`` per cent of a positive's."""
    index = index or build(rows)
    none = F.array().cast("array<bigint>")
    chosen = durable(rows.filter(anchors).withColumn("uid", F.monotonically_increasing_id()))
    same = _search(index, chosen.withColumns({"floors": none, "ceilings": none}), positives, True, chunk, stripe_blocks)
    near = durable(same.select("uid", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # At most ``positives`` per anchor; windows in whole numbers: ceil(low p / 100) <= s <= floor(high p / 100).
    scores = F.sort_array(F.collect_list(F.struct("place", "positive_score")))["positive_score"]
    held = near.groupBy("uid").agg(scores.alias("p"))
    windows = held.select(
        "uid",
        F.transform("p", lambda p: -F.floor(-p * low / F.lit(100).cast("decimal(38,0)")).cast("long")).alias("floors"),
        F.transform("p", lambda p: F.floor(p * high / F.lit(100).cast("decimal(38,0)")).cast("long")).alias("ceilings"),
    )
    far = _search(index, chosen.join(windows, "uid"), negatives, False, chunk, stripe_blocks)
    joined = far.withColumn("place", (F.col("slot") + 1).cast("int")).join(near, ["uid", "place"]).join(chosen.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    return joined.select("anchor_id", "positive_id", F.col("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id, label, q) AS u FROM usable
), scored AS (
  SELECT a.u, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM numbered a JOIN numbered b ON a.label <> b.label OR a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT u, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same QUALIFY place <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.u, p.place ORDER BY n.score DESC, n.vec_id) AS k
  FROM positives p JOIN scored n ON n.u = p.u AND NOT n.same
  WHERE 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, k::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE k <= 3
"""
