"""Token ids as flat unsigned-integer files with 64-bit document offsets.

Documents are range-partitioned by id; every task encodes its range in order and appends to one pair of files:
``.bin`` holds ids (16 bits where the vocabulary allows, else 32), ``.idx`` the 64-bit end offset of every document
within the file, ``.doc`` the document ids (Arrow). A task returns one manifest row. The base of a file is the sum of
the token counts of all files before it, so a document starts at base plus its own offset; no task
sees another's data. Readers memory-map the files.

Edge cases: a null text is empty and holds the end id only; null document ids come first; rows that repeat an id
are ordered by the hash of their text, and rows equal in both are interchangeable. An empty table writes no file. A
range never holds more than its share: rows of one hot id are spread by text hash and row number.
"""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import attempt_name, create, mapped, new_folder
from ..session import durable
from .bpe_pieces import EagerPieceCache, byte_symbols, special_tokens
from .common import slices, text_of, tidy

def _library_encoder(path: str, width: int = 4):
    """The tokenizer and a function from pre-tokens to their packed ids (``width`` bytes each), both by the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    symbols, tokenize, kind = byte_symbols(), tokenizer.model.tokenize, {2: "H", 4: "I"}[width]

    space = symbols[ord(" ")]

    def spelled(s: str) -> str:
        """The token in byte symbols; ASCII letters stand for themselves."""
        return space + s[1:] if s[:1] == " " and s.isascii() and s[1:].isalpha() else s.encode().decode("latin-1").translate(symbols)

    def encode(tokens: list[str]) -> list[bytes]:
        return [array(kind, [t.id for t in tokenize(spelled(s))]).tobytes() for s in tokens]

    return tokenizer, encode


# Encoded pieces of a Python worker, by vocabulary file and width, kept over its tasks; a cache is bounded.
_CACHES: dict[tuple[str, int], EagerPieceCache] = {}


def _worker_cache(path: str, width: int) -> EagerPieceCache:
    if (path, width) not in _CACHES:
        special = {s: np.array([i], f"<u{width}").tobytes() for s, i in special_tokens(path).items()}
        _CACHES[path, width] = EagerPieceCache(_library_encoder(path, width)[1], b"".join, special, 400_000)
    return _CACHES[path, width]


class TokenFiles:
    """A written set of files: ``folder`` and manifest rows ``(part, name, n_docs, n_tokens, base)`` in order."""

    def __init__(self, spark, folder: str, width: int, id_type: str, manifest: list[tuple[int, str, int, int, int]]):
        self.spark, self.folder, self.width, self.id_type, self.manifest = spark, folder, width, id_type, manifest

    def documents(self, id_col: str = "doc_id") -> DataFrame:
        """``(doc_id, start, n_tokens, ids_crc32)`` read back from the files, one file per task."""
        folder, width, manifest = self.folder, self.width, self.manifest
        ddl = f"`{id_col}` {self.id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"

        def read(batches):
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    _, name, _, _, base = manifest[k]
                    ids = mapped(folder, f"{name}.bin", f"<u{width}")
                    ends = mapped(folder, f"{name}.idx", "<i8")
                    docs = pa.ipc.open_stream(pa.py_buffer(mapped(folder, f"{name}.doc", "u1"))).read_all().column(0)
                    starts = np.concatenate([[0], ends[:-1]]).astype("int64")
                    for a in range(0, len(ends), 4096):
                        b = min(a + 4096, len(ends))
                        crc = [zlib.crc32(ids[starts[i] : ends[i]].astype("<u4").tobytes()) for i in range(a, b)]
                        columns = [docs.slice(a, b - a).combine_chunks(), starts[a:b] + base, ends[a:b] - starts[a:b], crc]
                        arrays = [x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns]
                        yield pa.RecordBatch.from_arrays(arrays, [id_col, "start", "n_tokens", "ids_crc32"])

        n = len(manifest)
        return self.spark.range(0, n, 1, max(n, 1)).mapInArrow(read, ddl)


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text"
) -> TokenFiles:
    """Encode whole texts with the tokenizers library, append ``end_id``, write them in ascending id order."""
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)[id_col]
    folder = new_folder(spark, "tokens")
    size = _library_encoder(tokenizer)[0].get_vocab_size()
    width = 2 if max(size, (end_id or 0) + 1) <= 1 << 16 else 4

    def write(batches):
        tidy()
        cache = _worker_cache(tokenizer, width)
        end = b"" if end_id is None else np.array([end_id], f"<u{width}").tobytes()
        part = TaskContext.get().partitionId()
        name, n_docs, n_tokens, opened = attempt_name(part), 0, 0, []
        for batch in slices(batches, 1, 4 << 20):
            if batch.num_rows == 0:
                continue
            key = pa.RecordBatch.from_arrays([batch.column(0)], ["id"])
            if not opened:
                opened = [create(folder, f"{name}.{kind}") for kind in ("bin", "idx", "doc")]
                keys = pa.ipc.new_stream(opened[2], key.schema)
            codes = [b"".join(found) + end for found in cache.look(batch.column(1).to_pylist())]
            ends = n_tokens + np.cumsum([len(c) // width for c in codes], dtype="int64")
            opened[0].write(b"".join(codes))
            opened[1].write(ends.astype("<i8").tobytes())
            keys.write_batch(key)
            n_docs, n_tokens = n_docs + len(codes), int(ends[-1])
        if opened:
            keys.close()
            for f in opened:
                f.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([name]), pa.array([n_docs], pa.int64()), pa.array([n_tokens], pa.int64())],
                ["part", "name", "n_docs", "n_tokens"],
            )

    keyed = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    keyed = keyed.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange("id", "h", "row").sortWithinPartitions("id", "h").select("id", "text")
    written = durable(ordered.mapInArrow(write, "part bigint, name string, n_docs bigint, n_tokens bigint"))
    # One row per partition; the prefix sums of their counts are the bases.
    rows = sorted(tuple(r) for r in written.collect())
    bases = np.concatenate([[0], np.cumsum([r[3] for r in rows], dtype="int64")])
    return TokenFiles(spark, folder, width, id_type, [(*r, int(b)) for r, b in zip(rows, bases, strict=False)])
