"""Repeated substrings by blockwise suffix sorting with cover-sample ranks.

Bytes covered by a ``LENGTH``-byte string that starts anywhere else are removed. Every window of that length has an anchor: the ``ANCHOR``
bytes inside it with the smallest hash, so equal windows have equal anchors at equal distance.

1. Bundles exchange their anchors (`bundles`); windows whose anchor occurs once are unique.
2. The surroundings of repeated anchors, a fragment of at most 300 bytes each, meet by anchor. A task lines
   fragments up at their anchors and ranks the cover sample: all positions at a multiple of 8 bytes from the anchor, by their next
   64 and 128 bytes (prefix doubling). Then the suffixes are sorted one bucket at a time, a bucket being the starts at one distance before the
   anchor. Suffixes of a bucket reach the sample after the same few bytes, so those bytes and two sample ranks decide any tie over all
   200 bytes, and only one bucket's keys are in memory. Neighbours that agree are repeats.
3. An anchor with more than ``HOT`` occurrences would fill a task with copies. A second exchange, of its windows' 64-bit hashes (one entry
   per bundle however often a window occurs), only trims: windows whose hash occurs once are cut off. Trimmed fragments that are
   equal are added up over all bundles, so that each travels to the sort once, which decides by bytes as in step 2. An anchor that still has more
   than ``CROWD`` different fragments has its windows added up by their bytes instead, in one aggregation.
4. Spans go back to the bundles, which cut the texts.

Edge cases: null texts are empty; texts shorter than the length lose nothing; repeats within one document, overlapping ones
too, count; matches never cross documents. Rows that repeat an id are documents of their own, null ids are returned as null.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable, shared_folder
from .bundles import answered, beside, bundle_files, repeated_keys, slots_for, unpack_rows
from .common import arrow_schema, tidy

LENGTH = 200
ANCHOR = 100
HOT = 1000
CROWD = 50_000
_SALTS = 16
_BUNDLE_BYTES = 1 << 20
_PIECE_BYTES = 1 << 19
_CHUNK_ROWS = 8192
# Column of the anchor in a lined-up fragment, a multiple of 8.
_AT = 104
_WIDTH = _AT + LENGTH

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_CODE = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype="u8")


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2^64."""
    out = np.full(n, base, "u8")
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every run of ``length`` bytes."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, "u8")
    sums = np.zeros(len(data) + 1, "u8")
    np.cumsum(_BYTE_CODE[data] * _powers(_BASE, len(data)), out=sums[1:])
    h = sums[length:] - sums[:n]
    h *= _powers(pow(_BASE, -1, 1 << 64), n)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: position and key of every anchor, and its first and last window start."""
    none = np.zeros(0, "int64")
    windows = len(data) - LENGTH + 1
    if windows <= 0:
        return none, none.astype("u8"), none, none
    h = window_hashes(data, ANCHOR)
    bits = np.uint64(int(len(h)).bit_length())
    value = (h >> bits << bits) | np.arange(len(h), dtype="u8")
    span = LENGTH - ANCHOR + 1
    padded = np.full(-(-len(value) // span) * span, np.iinfo("u8").max, "u8")
    padded[: len(value)] = value
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
    edge = np.zeros(len(data) + 1, "int32")
    long = ends - starts >= LENGTH
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, ends[long] - LENGTH + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:windows]) > 0)
    if not len(at):
        return none, none.astype("u8"), none, none
    place = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype("int64")
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    # Anchors have small hashes by their choice; another mixing spreads them over the whole range of keys.
    key = h[place[first]] * np.uint64(0x9FB21C651E98DF25)
    return place[first], key ^ (key >> np.uint64(32)), at[first], at[last]


def _pieces(rows: pa.RecordBatch):
    """Texts of a bundle laid end to end, in pieces of bounded size: ``(row numbers, bytes, starts, ends)``."""
    texts = [(t or "").encode() for t in rows.column(1).to_pylist()]
    held, size = [], 0
    for i, text in enumerate(texts):
        held.append(i)
        size += len(text)
        if size >= _PIECE_BYTES or i == len(texts) - 1:
            ends = np.cumsum([len(texts[k]) for k in held])
            yield np.array(held), np.frombuffer(b"".join(texts[k] for k in held), "u1"), np.r_[0, ends[:-1]], ends
            held, size = [], 0


def _anchor_keys(rows: pa.RecordBatch) -> np.ndarray:
    return np.concatenate([anchors(data, starts, ends)[1] for _, data, starts, ends in _pieces(rows)] or [np.zeros(0, "u8")])


_FRAGMENTS = "key bigint, hot boolean, piece binary, left int, low int, n bigint, places binary"


def _fragments(hot: int):
    """Distinct fragments around the repeated anchors of a bundle, with the places (row number, position) of each."""

    def apply(bundle, rows, keys, counts):
        out: dict[tuple, list[int]] = {}
        if rows is not None:
            uid0 = bundle_uid(bundle)
            for held, data, starts, ends in _pieces(rows):
                at, h, first, last = anchors(data, starts, ends)
                k = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                many = keys[k] == h if len(keys) else np.zeros(len(h), bool)
                at, h, first, last, k = at[many], h[many], first[many], last[many], k[many]
                doc = np.searchsorted(starts, at, "right") - 1
                raw = data.tobytes()
                for key, many, p, s, e, d in zip(h.view("i8").tolist(), counts[k].tolist(), at.tolist(), first.tolist(), last.tolist(), doc.tolist(), strict=True):
                    out.setdefault((key, many > hot, raw[s : e + LENGTH], p - s, p - e), []).extend((uid0 + int(held[d]), p - int(starts[d])))
        columns = list(zip(*out, strict=True)) or [[] for _ in range(5)]
        kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.int32()]
        places = [np.array(v, "<i8").tobytes() for v in out.values()]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.table([*arrays, pa.array([len(v) // 2 for v in out.values()], pa.int64()), pa.array(places, pa.binary())], ["key", "hot", "piece", "left", "low", "n", "places"])

    return apply


def bundle_uid(bundle: int) -> int:
    """First row number of a bundle; numbers are unique over all bundles (21 bits each for partition, bundle and row)."""
    return (bundle >> 32) << 42 | (bundle & 0xFFFFFFFF) << 21


def _pair_rank(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs of ranks."""
    key = left * (int(right.max(initial=0)) + 1) + right
    return np.unique(key, return_inverse=True)[1].reshape(key.shape)


def repeated_range(pieces: list[bytes], left: np.ndarray, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per fragment the largest and the smallest distance before the anchor at which a repeated window starts (-1: none)."""
    m = len(pieces)
    sizes = np.array([len(p) for p in pieces])
    lined = np.zeros((m, _WIDTH), "u1")
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lined[np.repeat(np.arange(m), sizes), inner + np.repeat(_AT - left, sizes)] = np.frombuffer(b"".join(pieces), "u1")
    # Ranks of the sample: blocks of 8 bytes, doubled to 64 and 128 bytes.
    rank = np.unique(lined.view(">u8"), return_inverse=True)[1].reshape(m, -1)
    for step in (1, 2, 4):
        rank = _pair_rank(rank[:, :-step], rank[:, step:])
    rank64, rank128 = rank, _pair_rank(rank[:, :-8], rank[:, 8:])
    base = int(rank64.max(initial=0)) + 1
    most, least = np.full(m, -1, "int64"), np.full(m, -1, "int64")
    for a in range(int(low.min()), int(left.max()) + 1):
        bucket = np.flatnonzero((low <= a) & (a <= left))
        if not len(bucket):
            continue
        start = _AT - a
        gap = -start % 8
        block = (start + gap) // 8
        columns = np.r_[np.arange(start, start + gap), np.arange(start + gap + LENGTH - 8, start + LENGTH)]
        ends = np.ascontiguousarray(lined[bucket[:, None], columns[None, :]]).view(">u8").ravel().astype("u8")
        middle = rank128[bucket, block] * base + rank64[bucket, block + 16]
        order = np.lexsort((ends, middle))
        same = (middle[order][1:] == middle[order][:-1]) & (ends[order][1:] == ends[order][:-1])
        twice = np.zeros(len(bucket), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        found = bucket[twice | (n[bucket] > 1)]
        most[found] = a
        least[found[least[found] < 0]] = a
    return most, least


def _spans(places: list[bytes], most: np.ndarray, least: np.ndarray) -> pa.RecordBatch:
    """``(bundle, uid, start, end)`` of the removed bytes around every place, merged per document."""
    keep = np.flatnonzero(most >= 0)
    pairs = [np.frombuffer(places[i], "<i8").reshape(-1, 2) for i in keep.tolist()]
    sizes = [len(p) for p in pairs]
    flat = np.concatenate([*pairs, np.zeros((0, 2), "<i8")])
    uid, start = flat[:, 0], flat[:, 1] - np.repeat(most[keep], sizes)
    end = flat[:, 1] + LENGTH - np.repeat(least[keep], sizes)
    order = np.lexsort((start, uid))
    uid, start, end = uid[order], start[order], end[order]
    if len(uid):
        # The running end of a document's spans; documents are kept apart by an offset.
        far = np.int64(int(end.max()) + 1)
        group = np.cumsum(np.r_[False, uid[1:] != uid[:-1]])
        reach = np.maximum.accumulate(end + group * far)
        new = np.r_[True, start[1:] + group[1:] * far > reach[:-1]]
        first = np.flatnonzero(new)
        uid, start, end = uid[first], start[first], (reach - group * far)[np.r_[first[1:], len(new)] - 1]
    bundle = (uid >> 42) << 32 | (uid >> 21) & ((1 << 21) - 1)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (bundle, uid, start, end)], ["bundle", "uid", "start", "end"])


_SPANS = "bundle bigint, uid bigint, start bigint, end bigint"


def _ranges(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    c = {name: table.column(name) for name in ("piece", "left", "low", "n")}
    return repeated_range(c["piece"].to_pylist(), c["left"].to_numpy().astype("int64"), c["low"].to_numpy().astype("int64"), c["n"].to_numpy())


def _sorted_buckets(work):
    """``work`` on tables of fragments that arrive in order of their anchors; a table ends where an anchor ends."""

    def run(batches):
        tidy()
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= _CHUNK_ROWS:
                table = pa.Table.from_batches(held)
                keys = table.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1], "left"))
                if cut:
                    yield work(table.slice(0, cut))
                    held, rows = table.slice(cut).to_batches(), len(keys) - cut
        if rows:
            yield work(pa.Table.from_batches(held))

    return run


def _found_spans(table: pa.Table) -> pa.RecordBatch:
    return _spans(table.column("places").to_pylist(), *_ranges(table))


_RANGES = "key bigint, d1 bigint, d2 bigint, most int, least int"


def _found_ranges(table: pa.Table) -> pa.RecordBatch:
    most, least = _ranges(table)
    keep = np.flatnonzero(most >= 0)
    names = ["key", "d1", "d2"]
    arrays = [pa.array(table.column(c).to_numpy()[keep]) for c in names]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(most[keep].astype("int32")), pa.array(least[keep].astype("int32"))], [*names, "most", "least"])


def _window_keys(rows: pa.RecordBatch) -> np.ndarray:
    hashes = [np.zeros(0, "u8")]
    for piece, n in zip(rows.column("piece").to_pylist(), rows.column("n").to_pylist(), strict=True):
        h = window_hashes(np.frombuffer(piece, "u1"), LENGTH)
        hashes += [h, h] if n > 1 else [h]
    return np.concatenate(hashes)


_TRIMMED = "key bigint, d1 bigint, d2 bigint, piece binary, left int, low int, n bigint, places binary"


def _trimmed(bundle, rows, keys, counts):
    """Distinct fragments of a bundle, cut to the windows from the first to the last whose hash occurs again; ``d1, d2`` tell them apart."""
    out: dict[tuple, list] = {}
    for key, piece, left, n, places in zip(*(rows.column(c).to_pylist() for c in ("key", "piece", "left", "n", "places")), strict=True) if rows is not None else ():
        h = window_hashes(np.frombuffer(piece, "u1"), LENGTH)
        found = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h) if len(keys) else []
        if len(found):
            a, z = int(found[0]), int(found[-1])
            entry = out.setdefault((key, piece[a : z + LENGTH], left - a, left - z), [0, []])
            entry[0] += n
            entry[1].append(places)
    digests = [hashlib.blake2b(piece + left.to_bytes(2) + low.to_bytes(2), digest_size=16).digest() for _, piece, left, low in out]
    d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    key, piece, left, low = list(zip(*out, strict=True)) or [[] for _ in range(4)]
    values = [
        pa.array(key, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(piece, pa.binary()), pa.array(left, pa.int32()), pa.array(low, pa.int32()),
        pa.array([n for n, _ in out.values()], pa.int64()), pa.array([b"".join(p) for _, p in out.values()], pa.binary()),
    ]
    return pa.table(values, ["key", "d1", "d2", "piece", "left", "low", "n", "places"])


def _window_by_window(distinct: DataFrame) -> DataFrame:
    """``_RANGES`` of the fragments of crowded anchors: equal windows at equal distance are added up by their bytes."""
    starts = F.sequence(F.col("low"), F.col("left"))
    windows = distinct.select("key", "d1", "d2", "left", "n", "piece", F.explode(starts).alias("a"))
    windows = windows.select("key", "d1", "d2", "n", "a", F.substring("piece", F.col("left") - F.col("a") + 1, F.lit(LENGTH)).alias("window"))
    twice = windows.groupBy("key", "a", "window").agg(F.sum("n").alias("times")).filter("times > 1").select("key", "a", "window")
    found = windows.join(twice, ["key", "a", "window"])
    return found.groupBy("key", "d1", "d2").agg(F.max("a").cast("int").alias("most"), F.min("a").cast("int").alias("least"))


def _hot_spans(fragments: DataFrame, size: int, crowd: int) -> DataFrame:
    """``_SPANS`` around anchors that occur very often."""
    crowded = bundle_files(fragments.select("key", "piece", "left", "low", "n", "places"), 1, _BUNDLE_BYTES)
    again = repeated_keys(crowded, lambda: _window_keys, slots_for(size // 4))
    trimmed = durable(answered(crowded, again, _trimmed, _TRIMMED))
    same = trimmed.groupBy("key", "d1", "d2").agg(F.sum("n").alias("n"), F.first("piece").alias("piece"), F.first("left").alias("left"), F.first("low").alias("low"))
    distinct = durable(same)
    many = distinct.groupBy("key").agg(F.count("*").alias("m")).filter(F.col("m") > crowd).select("key")
    plain = distinct.join(many, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    ranges = plain.mapInArrow(_sorted_buckets(_found_ranges), _RANGES)
    if not many.isEmpty():
        ranges = ranges.unionByName(_window_by_window(distinct.join(many, "key", "left_semi")))
    # A fragment has a row in every bundle that holds it, so these are spread over salts.
    salted = ranges.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    rows = trimmed.select("key", "d1", "d2", "places").withColumn("salt", F.pmod(F.xxhash64("places"), F.lit(_SALTS)).cast("int"))

    def spans(batches):
        tidy()
        for b in batches:
            yield _spans(b.column(0).to_pylist(), b.column(1).to_numpy().astype("int64"), b.column(2).to_numpy().astype("int64"))

    return rows.join(salted, ["key", "d1", "d2", "salt"]).select("places", "most", "least").mapInArrow(spans, _SPANS)


def removals(bundles: DataFrame, n_bytes: int, hot: int = HOT, crowd: int = CROWD) -> DataFrame:
    """``(bundle, uid, start, end)``: byte ranges to remove, several per document, possibly overlapping."""
    answers = repeated_keys(bundles, lambda: _anchor_keys, slots_for(n_bytes // 50))
    # Neighbouring fragments overlap, which zstd sees.
    path = f"{shared_folder(bundles.sparkSession)}/fragments-{uuid.uuid4().hex}"
    answered(bundles, answers, _fragments(hot), _FRAGMENTS).write.option("compression", "zstd").parquet(path)
    fragments = bundles.sparkSession.read.schema(_FRAGMENTS).parquet(path)
    plain = fragments.filter(~F.col("hot")).repartition("key").sortWithinPartitions("key")
    spans = plain.mapInArrow(_sorted_buckets(_found_spans), _SPANS)
    size = fragments.filter("hot").agg(F.sum(F.octet_length("piece"))).first()[0]
    return spans.unionByName(_hot_spans(fragments.filter("hot"), size, crowd)) if size else spans


def _cut(rows: pa.RecordBatch, base: int, spans: pa.Table | None):
    """Per document of a bundle: its bytes, and the mask of removed ones."""
    texts = [(t or "").encode() for t in rows.column(1).to_pylist()]
    marks: dict[int, list] = {}
    if spans is not None:
        for u, s, e in zip(*(spans.column(c).to_pylist() for c in ("uid", "start", "end")), strict=True):
            marks.setdefault(u - base, []).append((s, e))
    for i, text in enumerate(texts):
        merged: list[list[int]] = []
        for s, e in sorted(marks.get(i, ())):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        yield text, merged


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per document."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    bundles = bundle_files(rows, 1, _BUNDLE_BYTES)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spans = removals(bundles, n_bytes, hot, crowd)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        ids, figures = None, []
        if left.num_rows:
            held = unpack_rows(left.column("blob")[0].as_py())
            ids = held.column(0)
            for text, merged in _cut(held, bundle_uid(left.column("bundle")[0].as_py()), right):
                digest, at = hashlib.sha256(), 0
                for s, e in merged:
                    digest.update(text[at:s])
                    at = e
                digest.update(text[at:])
                figures.append((len(text), sum(e - s for s, e in merged), len(merged), digest.hexdigest()))
        columns = list(zip(*figures, strict=True)) or [[], [], [], []]
        arrays = [ids if ids is not None else pa.array([], id_arrow)]
        arrays += [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
        return pa.table(arrays, names)

    ddl = f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    names, id_arrow = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"], arrow_schema(ddl).field(0).type
    return beside(bundles, spans, finish, ddl)
