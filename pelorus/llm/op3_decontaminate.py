"""Benchmark decontamination with an FM-index per training shard.

Benchmark windows are runs of ``size`` consecutive item words (a shorter item is one window). Items are dealt to blocks of bounded size,
written once as files; a task reads the blocks one after another. A shard is a bounded slice of documents. Its
words become ids of the block's vocabulary; stretches that could hold no window (a word or a pair of neighbours
that no window has) are left out, the rest is indexed: suffix array, Burrows-Wheeler transform in a wavelet matrix, sampled
suffix positions. All distinct windows are searched backwards at once, occurrences located, and the covered words merged into spans. The work is
one narrow pass over the documents.

Edge cases: null and wordless texts have no words and are never hit; null or wordless items have no window. A null item id hits words but
is in no list. Rows of one item id count as one item. Document ids may repeat or be null; every row is judged by itself.
Without a benchmark nothing is hit. Further columns of the tables are not looked at.
"""

from __future__ import annotations

import hashlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..files import attempt_name, create, mapped, new_folder
from ..session import durable
from .common import slices, text_of, tidy
from .fm_index import FMIndex
from .op5_toxicity import WORD_BYTES, words

SHARD_BYTES = 6 << 20
_BLOCK_BYTES = 4 << 20


class Phrases:
    """One block of benchmark items: vocabulary, distinct windows, and the items of each window."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[int]] = {}
        names: dict[str, int] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text.split()]
            for at in range(max(1, len(ids) - size + 1) if ids else 0):
                owners = windows.setdefault(tuple(ids[at : at + size]), set())
                if item is not None:
                    owners.add(names.setdefault(item, len(names)))
        self.names = np.array([*names, ""], object)[: len(names)]
        self.lengths = np.array([len(w) for w in windows], "int64")
        self.shortest = int(self.lengths.min(initial=size))
        self.patterns = np.zeros((len(windows), size), "int64")
        for row, w in enumerate(windows):
            self.patterns[row, size - len(w) :] = w
        pairs = {p for w in windows for p in zip(w[:-1], w[1:], strict=True)}
        self.pairs = np.sort(np.array([a << 32 | b for a, b in pairs] or [-1], "int64"))
        # Windows of one phrase have the same items: each set of items is kept once.
        sets: dict[tuple[int, ...], int] = {}
        self.owner_set = np.array([sets.setdefault(tuple(sorted(o)), len(sets)) for o in windows.values()], "int64")
        self.sets = list(sets)

    def search(self, ids: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Covered positions (as a mask) and distinct ``(document, set of items)`` pairs in a sequence of ids, 0 between documents;
        ``docs`` are the documents' first positions."""
        hit, none = np.zeros(len(ids), bool), np.zeros((0, 2), "int64")
        if not len(self.patterns) or not len(ids):
            return hit, none
        key = ids[:-1] << 32 | ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        joined = self.pairs[at] == key
        # Stretches of words in which every neighbouring pair is in some window.
        known = ids > 0
        first = known & np.r_[True, ~joined]
        run = np.cumsum(first) * known
        sizes = np.bincount(run)
        keep = np.flatnonzero(known & (sizes[run] >= self.shortest))
        if not len(keep):
            return hit, none
        # Symbol 1 separates stretches; words follow from 2 on.
        gaps = np.flatnonzero(first[keep])
        seq, where = np.insert(ids[keep] + 1, gaps, 1), np.insert(keep, gaps, -1)
        index = FMIndex(seq)
        patterns = np.where(self.patterns > 0, self.patterns + 1, 0)
        low, high = index.find(patterns, self.lengths)
        counts = high - low
        window = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts) + low[window]
        starts = where[index.locate(rows)]
        edge = np.zeros(len(ids) + 1, "int64")
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.lengths[window], -1)
        hit = np.cumsum(edge[:-1]) > 0
        # However often a document repeats a phrase of many items, it names their set once.
        doc = np.searchsorted(docs, starts, "right") - 1
        return hit, np.unique(np.stack([doc, self.owner_set[window]], axis=1), axis=0)


class PhraseBlocks:
    """The written benchmark; tasks read block after block, and keep a single one in memory."""

    def __init__(self, folder: str, names: list[str], size: int):
        self.folder, self.names, self.size = folder, names, size

    def load(self, name: str) -> Phrases:
        table = pa.ipc.open_stream(pa.py_buffer(mapped(self.folder, name, "u1"))).read_all()
        return Phrases(list(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True)), self.size)

    def each(self):
        """A function that yields the blocks; a lone block is parsed once per task."""
        lone = [self.load(n) for n in self.names] if len(self.names) == 1 else None
        return lambda: iter(lone) if lone is not None else (self.load(n) for n in self.names)


def phrases(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text", block_bytes: int = _BLOCK_BYTES) -> PhraseBlocks:
    """Cut the benchmark into blocks of about ``block_bytes`` of text and write them to the shared folder."""
    spark = benchmark.sparkSession
    folder = new_folder(spark, "phrases")
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), text_of(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def write(batches):
        stream, name = None, attempt_name(TaskContext.get().partitionId())
        for b in batches:
            rows = [(i, b" ".join(words(t))) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            rows = [r for r in rows if r[1]]
            if rows:
                out = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["item", "words"])
                if stream is None:
                    sink = create(folder, name)
                    stream = pa.ipc.new_stream(sink, out.schema)
                stream.write_batch(out)
        if stream is not None:
            stream.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    manifest = durable(items.repartition(max(1, ceil(total / block_bytes))).mapInArrow(write, "name string"))
    # One name per block.
    return PhraseBlocks(folder, sorted(r[0] for r in manifest.collect()), size)


def _judge_shard(texts: list[str], blocks) -> tuple[list[list[bytes]], list[np.ndarray], list[set[str]]]:
    """Words, hit masks and item names of each text of one shard."""
    cut = [words(t) for t in texts]
    sizes = np.array([len(c) for c in cut], "int64")
    starts = np.cumsum(sizes + 1) - sizes - 1
    hit, items = np.zeros(int((sizes + 1).sum()), bool), [set() for _ in texts]
    for block in blocks():
        ids = np.zeros(len(hit), "int64")
        get = block.vocabulary.get
        for start, c in zip(starts.tolist(), cut, strict=True):
            ids[start : start + len(c)] = [get(w, 0) for w in c]
        covered, found = block.search(ids, starts)
        hit |= covered
        for d, owners in found.tolist():
            items[d].update(block.names[i] for i in block.sets[owners])
    return cut, [hit[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)], items


def _spans(text: str, mask: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of the text's merged runs of hit words."""
    flat = np.frombuffer(text.encode().translate(WORD_BYTES), "u1") != 32
    edge = np.diff(np.concatenate([[0], flat.view("i1"), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    runs = np.diff(np.concatenate([[0], mask.view("i1"), [0]]))
    return list(zip(begin[np.flatnonzero(runs == 1)].tolist(), end[np.flatnonzero(runs == -1) - 1].tolist(), strict=True))


def report(docs: DataFrame, blocks: PhraseBlocks, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans``; spans are byte ranges to remove."""
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType(
        [docs.select(F.col(id_col)).schema[0]]
        + [StructField(n, LongType()) for n in ("n_words", "n_hit", "n_items")]
        + [StructField("items_sha256", StringType()), StructField("spans", ArrayType(span))]
    )

    def run(batches):
        tidy()
        each = blocks.each()
        for part in slices(batches, 1, SHARD_BYTES):
            texts = part.column(1).to_pylist()
            cut, masks, items = _judge_shard(texts, each)
            names = [",".join(sorted(s)) for s in items]
            spans = [[{"start": a, "end": b} for a, b in _spans(t, m)] if m.any() else [] for t, m in zip(texts, masks, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(c) for c in cut], pa.int64()),
                    pa.array([int(m.sum()) for m in masks], pa.int64()),
                    pa.array([len(s) for s in items], pa.int64()),
                    pa.array([hashlib.sha256(n.encode()).hexdigest() for n in names]),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                schema.names,
            )

    judged = docs.select(F.col(id_col), text_of(text_col)).mapInArrow(run, schema)
    return judged.select(F.col(f"`{id_col}`"), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "spans")


def without_phrases(docs: DataFrame, blocks: PhraseBlocks, text_col: str = "text") -> DataFrame:
    """``docs`` with the same rows and columns; every merged span of hit words is cut out of its text, a line break in its place."""
    schema = StructType([StructField("row", docs.schema, False), StructField("kept", StringType())])

    def run(batches):
        tidy()
        each = blocks.each()
        for part in slices(batches, 1, SHARD_BYTES):
            texts = part.column(1).to_pylist()
            _, masks, _ = _judge_shard([t or "" for t in texts], each)
            kept = []
            for text, mask in zip(texts, masks, strict=True):
                if mask.any():
                    raw, at, pieces = text.encode(), 0, []
                    for a, b in _spans(text, mask):
                        pieces.append(raw[at:a])
                        at = b
                    text = b"\n".join([*pieces, raw[at:]]).decode()
                kept.append(text)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.string())], ["row", "kept"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    cut = docs.select(row, F.col(text_col).alias("_text")).mapInArrow(run, schema)
    return cut.select(*[(F.col("kept") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
