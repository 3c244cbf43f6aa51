"""Documents packed into bundles, and the exchange that tells every bundle which of its keys occur elsewhere.

A bundle holds a few megabytes of documents, compressed. ``bundle_files`` writes bundles to flat files in the shared folder, one
after another in one file per task, and a row says where its bundle lies: texts are written once and never shuffled, tasks read a
bundle where they need it. ``bundle_table`` keeps them in the rows instead. For the exchange a bundle sends its distinct keys with their counts, split into slots of equal key ranges. One task per slot
adds up the counts and sends back, per bundle, only the keys with two or more occurrences. A key in a third of
all documents is one entry per bundle, and keys are hashes, so slots are even whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..files import attempt_name, create, new_folder
from ..session import durable
from .common import tidy

BUNDLE_BYTES = 4 << 20
_KEYS_PER_SLOT = 1 << 20
COUNT_CAP = 0xFFFF
MOST_TASKS = 20_000
# Marks a place in a file; Arrow streams start with another byte.
_PLACE = b"@"


def pack_rows(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_rows(blob: bytes) -> pa.RecordBatch:
    """The rows of a bundle, or of the place in a file that ``bundle_files`` names."""
    if blob[:1] == _PLACE:
        blob = _read(blob[1:].decode())
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_next_batch()


def _read(place: str) -> bytes:
    uri, offset, size = place.rsplit(":", 2)
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        f.seek(int(offset))
        return f.read(int(size))


def bundle_table(rows: DataFrame, size_column: int, max_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """A written table ``(bundle, blob)``; bundles follow the input's partitions, so nothing is shuffled.

    ``size_column`` is the position of the large column that decides how many rows make a bundle.
    """
    return durable(rows.mapInArrow(_bundler(size_column, max_bytes, None), "bundle bigint, blob binary"))


def bundle_files(rows: DataFrame, size_column: int, max_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Like ``bundle_table``, but ``blob`` names the place of the bundle in a file; rows are dealt to even tasks."""
    folder = new_folder(rows.sparkSession, "bundles")
    places = durable(rows.mapInArrow(_bundler(size_column, max_bytes, folder), "bundle bigint, blob binary"))
    tasks = tasks_for(places)
    spread = places.repartition(tasks)
    spread._tasks = tasks
    return spread


def tasks_for(bundles: DataFrame) -> int:
    """A few bundles per task, a bounded number of tasks."""
    n = bundles.count()
    return max(1, min(n, MOST_TASKS, max(2 * bundles.sparkSession.sparkContext.defaultParallelism, ceil(n / 4))))


def _bundler(size_column: int, max_bytes: int, folder: str | None):
    def run(batches):
        tidy()
        base, seq, offset = TaskContext.get().partitionId() << 32, 0, 0
        held, size, file, name = [], 0, None, attempt_name(TaskContext.get().partitionId())

        def row():
            nonlocal seq, held, size, offset, file
            blob = pack_rows(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
            if folder:
                file = file or create(folder, name)
                file.write(blob)
                offset, blob = offset + len(blob), _PLACE + f"{folder}/{name}:{offset}:{len(blob)}".encode()
            out = pa.RecordBatch.from_arrays([pa.array([base + seq], pa.int64()), pa.array([blob], pa.binary())], ["bundle", "blob"])
            seq, held, size = seq + 1, [], 0
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            step = max(1, int(batch.num_rows * max_bytes / 4 / max(batch.column(size_column).nbytes, 1)))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                held.append(part)
                size += part.column(size_column).nbytes
                if size >= max_bytes:
                    yield row()
        # The file is closed before the last row is handed over: a committed row names bytes that are there.
        last = [row()] if held else []
        if file:
            file.close()
        yield from last

    return run


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct unsigned 64-bit keys as compressed differences, bytes of equal weight together."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(gaps.view("u1").reshape(-1, 8).T.tobytes())


def unpack_keys(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1")
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel(), dtype="u8")


def pack_counts(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.minimum(counts, COUNT_CAP).astype("<u2").tobytes())


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u2")


def slots_for(n_keys: int) -> int:
    """Bits of the key that name its slot."""
    return max(4, int(np.ceil(np.log2(max(n_keys, 1) / _KEYS_PER_SLOT)))) if n_keys else 4


def repeated_keys(bundles: DataFrame, keys_of: Callable[[], Callable[[pa.RecordBatch], np.ndarray]], slot_bits: int, key_bits: int = 64) -> DataFrame:
    """``(bundle, keys, counts)``, several rows per bundle: its keys that occur at least twice over all bundles.

    ``keys_of`` is called once per task and gives a function from a bundle's rows to all its keys (uint64, repeats included, the
    upper ``64 - key_bits`` bits zero). Counts are totals, cut at 65,535.
    """

    def send(batches):
        tidy()
        keys = keys_of()
        for b in batches:
            for bundle, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                values, counts = np.unique(keys(unpack_rows(blob)), return_counts=True)
                if not len(values):
                    continue
                slot = (values >> np.uint64(key_bits - slot_bits)).astype("int64")
                cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(values)]
                spans = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(slot[a]) for a, _ in spans], pa.int64()),
                        pa.array([bundle] * len(spans), pa.int64()),
                        pa.array([pack_keys(values[a:z]) for a, z in spans], pa.binary()),
                        pa.array([pack_counts(counts[a:z]) for a, z in spans], pa.binary()),
                    ],
                    ["slot", "bundle", "keys", "counts"],
                )

    def add_up(table: pa.Table) -> pa.Table:
        tidy()
        bundles = table.column("bundle").to_numpy()
        parts = [unpack_keys(k) for k in table.column("keys").to_pylist()]
        keys = np.concatenate(parts)
        counts = np.concatenate([unpack_counts(c) for c in table.column("counts").to_pylist()]).astype("int64")
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        total = np.empty(len(keys), "int64")
        total[order] = np.repeat(np.add.reduceat(counts[order], first), np.diff(np.r_[first, len(keys)]))
        out, at = [], 0
        for bundle, part in zip(bundles.tolist(), parts, strict=True):
            mine = total[at : at + len(part)]
            many = mine >= 2
            if many.any():
                out.append((bundle, pack_keys(part[many]), pack_counts(mine[many])))
            at += len(part)
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["bundle", "keys", "counts"])

    sent = bundles.mapInArrow(send, "slot bigint, bundle bigint, keys binary, counts binary")
    return sent.groupBy("slot").applyInArrow(add_up, "bundle bigint, keys binary, counts binary")


def collected(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of a bundle's answers, and their counts."""
    keys = np.concatenate([np.zeros(0, "u8"), *[unpack_keys(k) for k in answers.column("keys").to_pylist()]])
    counts = np.concatenate([np.zeros(0, "<u2"), *[unpack_counts(c) for c in answers.column("counts").to_pylist()]]).astype("int64")
    order = np.argsort(keys, kind="stable")
    return keys[order], counts[order]


def answered(bundles: DataFrame, answers: DataFrame, apply: Callable[[int, pa.RecordBatch, np.ndarray, np.ndarray], pa.Table], schema) -> DataFrame:
    """Run ``apply(bundle, rows, keys, counts)`` on every bundle with its repeated keys, sorted; bundles without any are skipped."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        if not left.num_rows or not right.num_rows:
            return apply(0, None, np.zeros(0, "u8"), np.zeros(0, "int64"))
        return apply(left.column("bundle")[0].as_py(), unpack_rows(left.column("blob")[0].as_py()), *collected(right))

    return beside(bundles, answers, run, schema)


def beside(bundles: DataFrame, rows: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``run(bundle row, its rows)`` per bundle. Places are small, so the number of tasks is set by the count of bundles."""
    n = getattr(bundles, "_tasks", None) or tasks_for(bundles)
    return bundles.repartition(n, "bundle").groupBy("bundle").cogroup(rows.repartition(n, "bundle").groupBy("bundle")).applyInArrow(run, schema)
