"""Merkle manifest of a table by time-forward processing: digests go forward to parents, proofs go back to leaves.

Every node has a label (tree, block, level, index) and is processed in label order, children before parents. A digest is a message to
the parent's label, waiting in a priority queue that is ordered by label. The queue is external: messages that leave a block
of ``FAN ** LEVELS`` nodes are rows, which Spark's shuffle brings to their block and sorts (spilling where it must), and messages
inside a block wait in a heap of the task, whose size the block bounds. One sweep over the rows lifts all trees by ``LEVELS``
levels; sweeps repeat until every tree is one node, about log(rows) / log(729) times.

The reversed sweeps visit labels from the top. A node receives from its parent the proof suffix, the siblings of all levels above it, puts
its siblings in front and passes that on; leaves hash it and fold their (possibly tampered) digest along it.

Trees: one per source, over its rows in ascending id, then one over the sources' roots in source order. A third of all rows in one source is
many blocks of one tree; no task holds more than a block, and nothing but counts of partitions passes the driver.

Edge cases: null columns enter the digest as ``-``. Null ids come first and are never tampered; a null source comes first
and is a source of its own. Rows that repeat an id follow each other by digest; equal rows are interchangeable. A single row is its own root and
has an empty proof. An empty table returns no rows. Texts of any length are hashed inside the JVM, only digests travel.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import _in_order
from ..session import durable
from .common import arrow_schema, tidy

FAN = 3
LEVELS = 6


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """``rows`` with ``idx``, the place within the tree in ``order``, and ``size``, the tree's number of rows.

    Places come from one range sort over (tree, order): position within the partition, plus the counts of the tree's earlier
    partitions. A large tree spans partitions."""
    placed = _in_order(rows, F.asc(tree), *[F.asc(c) for c in order])
    # One row per partition and tree in it.
    runs = placed.groupBy(tree, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(tree)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(tree, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size"))
    return placed.join(runs, [tree, "_part"]).withColumn("idx", F.col("_place") + F.col("_shift")).drop("_part", "_place", "_shift")


def _height(size: int, levels: int, fan: int) -> int:
    """Levels that a block of a tree with ``size`` nodes rises: all, or as many as make the tree one node."""
    h, reach = 0, 1
    while h < levels and reach < size:
        h, reach = h + 1, reach * fan
    return h


class Block:
    """The nodes of one block, received in label order."""

    def __init__(self, tree, block: int, size: int, levels: int, fan: int):
        self.tree, self.block, self.size, self.fan = tree, block, size, fan
        self.height = _height(size, levels, fan)
        self.first = block * fan**levels
        self.queue: list[tuple[int, int, bytes]] = []
        # Digests of the children of every processed node, by label; the reversed sweep reads it backwards.
        self.tape: dict[tuple[int, int], list[bytes]] = {}
        self.top: bytes | None = None

    def leaf(self, idx: int, value: bytes) -> None:
        self.send(0, idx - self.first, value)

    def send(self, level: int, i: int, value: bytes) -> None:
        if level == self.height:
            self.top = value
        else:
            # A message to the parent's label; the child's place breaks ties among siblings.
            heapq.heappush(self.queue, (level + 1, i, value))

    def forward(self) -> bytes:
        """Process the labels above the leaves in order; the digest of the block's top."""
        while self.queue:
            level, i, value = heapq.heappop(self.queue)
            children = [value]
            while self.queue and self.queue[0][0] == level and self.queue[0][1] // self.fan == i // self.fan:
                children.append(heapq.heappop(self.queue)[2])
            self.tape[level, i // self.fan] = children
            self.send(level, i // self.fan, hashlib.sha256("".join(c.hex() for c in children).encode()).digest())
        return self.top

    def backward(self, suffix: list[tuple[bytes, bytes]]) -> dict[int, list[tuple[bytes, bytes]]]:
        """Proof of every leaf by place: (digests to the left, digests to the right) per level, given the top's proof."""
        proofs: dict[int, list] = {}
        queue = [((-self.height, 0), suffix)]
        while queue:
            (level, i), proof = heapq.heappop(queue)
            level, i = -level, -i
            if not level:
                proofs[i] = proof
                continue
            children = self.tape[level, i]
            for k in range(len(children)):
                mine = (b"".join(children[:k]), b"".join(children[k + 1 :]))
                heapq.heappush(queue, ((1 - level, -(i * self.fan + k)), [mine, *proof]))
        return proofs


def _blocks(batches, levels: int, fan: int):
    """``(block, its rows)`` of sorted batches; a row is a dict. Only one block is held."""
    here, rows = None, []
    for b in batches:
        for row in b.to_pylist():
            label = (row["tree"], row["block"])
            if label != here and rows:
                yield Block(*here, rows[-1]["size"], levels, fan), rows
                rows = []
            here = label
            rows.append(row)
    if rows:
        yield Block(*here, rows[-1]["size"], levels, fan), rows


def _to_blocks(nodes: DataFrame, width: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / width).cast("long"))


_NODE = "tree string, idx bigint, size bigint, digest binary"


def climb(nodes: DataFrame, levels: int = LEVELS, fan: int = FAN) -> list[DataFrame]:
    """The nodes ``(tree, idx, size, digest)`` of every sweep, from the leaves to one node per tree."""
    width, schema = fan**levels, arrow_schema(_NODE)

    def sweep(batches):
        tidy()
        out = []
        for block, rows in _blocks(batches, levels, fan):
            for row in rows:
                block.leaf(row["idx"], row["digest"])
            out.append({"tree": block.tree, "idx": block.block, "size": -(-block.size // width), "digest": block.forward()})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema)

    sweeps = [nodes.select("tree", "idx", "size", "digest")]
    while (sweeps[-1].agg(F.max("size")).first()[0] or 1) > 1:
        lined = _to_blocks(sweeps[-1], width).repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
        sweeps.append(durable(lined.mapInArrow(sweep, _NODE)))
    return sweeps


_PROOF = "array<struct<left:binary,right:binary>>"


def _delivered(nodes: DataFrame, suffixes: DataFrame, width: int, extra: list[str]) -> DataFrame:
    """Nodes and the proof of their block's top as one stream, the proof first in each block."""
    below = _to_blocks(nodes, width).withColumn("proof", F.lit(None).cast(_PROOF))
    tops = suffixes.select("tree", F.col("idx").alias("block"), "proof", F.lit(-1).cast("long").alias("idx"))
    both = below.unionByName(tops, allowMissingColumns=True)
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx").select("tree", "block", "idx", "size", "digest", "proof", *extra)


def descend(sweeps: list[DataFrame], suffixes: DataFrame, levels: int = LEVELS, fan: int = FAN) -> DataFrame:
    """``(tree, idx, proof)`` of the tops of the lowest blocks, given ``suffixes (tree, idx, proof)`` of the trees' tops."""
    width, schema = fan**levels, arrow_schema(f"tree string, idx bigint, proof {_PROOF}")

    def sweep(batches):
        tidy()
        for block, rows in _blocks(batches, levels, fan):
            proofs = _proofs(block, rows)
            for a in range(1, len(rows), 200):
                part = [{"tree": block.tree, "idx": r["idx"], "proof": _structs(proofs[r["idx"] - block.first])} for r in rows[a : a + 200]]
                yield pa.RecordBatch.from_pylist(part, schema)

    for nodes in reversed(sweeps[1:-1]):
        suffixes = durable(_delivered(nodes, suffixes, width, []).mapInArrow(sweep, f"tree string, idx bigint, proof {_PROOF}"))
    return suffixes


def _structs(proof) -> list[dict]:
    return [{"left": a, "right": b} for a, b in proof]


def _proofs(block: Block, rows: list[dict]) -> dict[int, list]:
    """The first row of a block holds its top's proof, the others are its nodes."""
    for row in rows[1:]:
        block.leaf(row["idx"], row["digest"])
    block.forward()
    return block.backward([(p["left"], p["right"]) for p in rows[0]["proof"]])


def _hex_runs(data: bytes) -> bytes:
    return data.hex().encode()


def fold(value: bytes, proof: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf's digest leads to along its proof; every step is one level."""
    for left, right in proof:
        value = hashlib.sha256(_hex_runs(left) + _hex_runs(value) + _hex_runs(right)).digest()
    return value


def proof_digest(proof: list[tuple[bytes, bytes]]) -> str:
    return hashlib.sha256(b"".join(_hex_runs(side) for step in proof for side in step)).hexdigest()


class Manifest:
    """``leaves (id, tree, idx, size, digest, told)``, ``sweeps`` per source, ``above`` over the sources' roots, ``subroots`` and ``root``."""

    def __init__(self, leaves: DataFrame, levels: int, fan: int):
        self.levels, self.fan = levels, fan
        self.leaves = leaves
        self.sweeps = climb(leaves, levels, fan)
        roots = self.sweeps[-1].filter("size = 1").select("tree", "digest")
        # Trees end in different sweeps; a tree of one node stays as it is until all have ended.
        ordered = numbered(roots.select(F.col("tree").alias("name"), "digest", F.lit("").alias("tree")), "tree", "name")
        self.subroots = durable(ordered.select("tree", "name", "idx", "size", "digest"))
        self.above = climb(self.subroots, levels, fan)
        self.root = self.above[-1]

    def proofs(self) -> DataFrame:
        """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` per leaf; ``told`` is the digest of the row as it is now."""
        width, levels, fan = self.fan**self.levels, self.levels, self.fan
        root = self.root.first()  # one node, none for an empty table
        tops = self.root.select("tree", F.lit(0).cast("long").alias("idx"), F.array().cast(_PROOF).alias("proof"))
        reached = descend(self.above, tops, levels, fan)
        above_ddl = f"tree string, idx bigint, subroot string, proof {_PROOF}"
        above_schema = arrow_schema(above_ddl)

        def sources(batches):
            tidy()
            for block, rows in _blocks(batches, levels, fan):
                proofs = _proofs(block, rows)
                out = [{"tree": r["name"], "idx": 0, "subroot": r["digest"].hex(), "proof": _structs(proofs[r["idx"] - block.first])} for r in rows[1:]]
                yield pa.RecordBatch.from_pylist(out, above_schema)

        named = durable(_delivered(self.subroots, reached, width, ["name"]).mapInArrow(sources, above_ddl))
        lowest = descend(self.sweeps, named.select("tree", "idx", "proof"), levels, fan)
        kind = dict(self.leaves.dtypes)["id"]
        ddl = f"id {kind}, tree string, leaf string, proof_sha256 string, folded_root string"
        schema = arrow_schema(ddl)

        def leaves(batches):
            tidy()
            for block, rows in _blocks(batches, levels, fan):
                proofs = _proofs(block, rows)
                out = []
                for r in rows[1:]:
                    proof = proofs[r["idx"] - block.first]
                    out.append((r["id"], block.tree, r["digest"].hex(), proof_digest(proof), fold(r["told"], proof).hex()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        found = _delivered(self.leaves.select("tree", "idx", "size", "digest", "told", "id"), lowest, width, ["told", "id"]).mapInArrow(leaves, ddl)
        joined = found.join(named.select("tree", "subroot"), "tree").withColumn("root", F.lit(root["digest"].hex() if root else None))
        return joined.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def build(rows: DataFrame, columns: list[str], now: dict[str, Column], id_col: str = "doc_id", source_col: str = "source", levels: int = LEVELS, fan: int = FAN) -> Manifest:
    """The manifest of ``rows`` over ``columns``; ``now`` gives columns as they are when verified."""
    # The mark sorts null before every source and keeps their bytewise order.
    tree = F.when(F.col(source_col).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source_col).cast("string")))
    told = [now.get(c, F.col(c)) for c in columns]
    leaves = durable(rows.select(F.col(id_col).alias("id"), tree.alias("tree"), digest(*[F.col(c) for c in columns]).alias("digest"), digest(*told).alias("told")))
    return Manifest(durable(numbered(leaves, "tree", "id", "digest", "told")), levels, fan)


def report(docs: DataFrame, id_col: str = "doc_id", levels: int = LEVELS, fan: int = FAN) -> DataFrame:
    """Leaves, roots, proofs, and the verdict on rows whose line feeds are lost where crc32 of the id is even."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    now = {"text": F.when(hit, F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))).otherwise(F.col("text").cast("string"))}
    found = build(docs, [id_col, "source", "lang", "n_chars", "text"], now, id_col, levels=levels, fan=fan).proofs()
    return found.withColumnRenamed("id", id_col)


SQL = """
WITH RECURSIVE told AS (
  SELECT *, CASE WHEN xor(list_reduce(list_transform(range(len(doc_id::VARCHAR)), lambda i: ascii((doc_id::VARCHAR)[i + 1])::UBIGINT),
      lambda c, b: list_reduce(list_transform(range(8), lambda z: z::UBIGINT), lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1)), xor(c, b)),
      4294967295::UBIGINT), 4294967295::UBIGINT) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS now
  FROM documents
), fields AS (
  SELECT doc_id, source, now, text, coalesce('1' || source, '0') AS tree,
    concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END,
      CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
      CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
      CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END) AS head
  FROM told
), digests AS (
  SELECT doc_id, tree, sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
    sha256(concat(head, CASE WHEN now IS NULL THEN '-' ELSE concat(strlen(now), ':', now) END)) AS told
  FROM fields
), leaves AS (
  SELECT *, row_number() OVER () AS u, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, told) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM digests
), low AS (
  SELECT tree, 0 AS level, idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY tree, level, idx // 3, n
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS m FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, place AS idx, m AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY level, idx // 3, n
), steps AS (
  SELECT a.u, 0 AS stage, l.level, string_agg(l.digest, '' ORDER BY l.idx) FILTER (l.idx < a.idx // (3 ** l.level)::BIGINT) AS before,
    string_agg(l.digest, '' ORDER BY l.idx) FILTER (l.idx > a.idx // (3 ** l.level)::BIGINT) AS after
  FROM leaves a JOIN low l ON l.tree = a.tree AND l.n > 1 AND l.idx // 3 = a.idx // (3 ** (l.level + 1))::BIGINT GROUP BY a.u, l.level
  UNION ALL
  SELECT a.u, 1, h.level, string_agg(h.digest, '' ORDER BY h.idx) FILTER (h.idx < s.place // (3 ** h.level)::BIGINT),
    string_agg(h.digest, '' ORDER BY h.idx) FILTER (h.idx > s.place // (3 ** h.level)::BIGINT)
  FROM leaves a JOIN subroots s USING (tree) JOIN high h ON h.n > 1 AND h.idx // 3 = s.place // (3 ** (h.level + 1))::BIGINT GROUP BY a.u, h.level
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY u ORDER BY stage, level) AS step FROM steps
), proofs AS (
  SELECT u, sha256(string_agg(concat(before, after), '' ORDER BY step)) AS proof_sha256, max(step) AS last FROM ordered GROUP BY u
), folds AS (
  SELECT u, 0 AS step, told AS digest FROM leaves
  UNION ALL
  SELECT f.u, o.step, sha256(concat(o.before, f.digest, o.after)) FROM folds f JOIN ordered o ON o.u = f.u AND o.step = f.step + 1
)
SELECT a.doc_id, a.leaf, s.digest AS subroot, h.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = h.digest AS verified
FROM leaves a JOIN subroots s USING (tree) JOIN high h ON h.n = 1 LEFT JOIN proofs p USING (u) JOIN folds f ON f.u = a.u AND f.step = coalesce(p.last, 0)
"""
