"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a slice of texts are laid out as one linked sequence of symbols. An index maps every adjacent
pair that has a merge rank to all its positions; a heap holds the active ranks. The lowest active rank is applied at all
its positions at once, and only the neighbouring pairs' lists are updated. Words do not touch, so the
order of merges inside each word is the tokenizer's own.

Edge cases: a null text is empty and has no ids; strings of special tokens become their ids; ids that are not in the
vocabulary make decoding fail; bytes that are not UTF-8 decode to U+FFFD. Rows are independent, so repeated
and null document ids are returned as they come.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from .bpe_pieces import PieceCache, byte_symbols, special_tokens
from .common import map_documents


class PairIndexBPE:
    """Encoder and decoder of one vocabulary file (``tokenizers`` JSON of a byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        back = {c: b for b, c in symbols.items()}
        self.byte_symbol = np.array([vocab[symbols[b]] for b in range(256)], "int64")
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in merges]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        keys = np.array([a << 32 | b for a, b, _ in self.merges], "int64")
        self.pair_ranks = np.argsort(keys, kind="stable")
        self.pair_keys = keys[self.pair_ranks]
        self.token_bytes = {i: bytes(back[c] for c in s) for s, i in vocab.items()}
        self.special = special_tokens(path)
        self.token_bytes |= {i: s.encode() for s, i in self.special.items()}

    def _ranked(self, keys: np.ndarray) -> np.ndarray:
        """The merge rank of every pair, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def _merge_words(self, words: list[bytes]) -> list[list[int]]:
        if not words:
            return []
        sizes = np.fromiter(map(len, words), "int64", len(words))
        ends = np.cumsum(sizes + 1) - 1
        # Symbols in one line with a border (-1) behind every word; -2 marks symbols merged into the one before.
        sym = np.full(int(ends[-1]) + 1, -1, "int64")
        inside = np.ones(len(sym), bool)
        inside[ends] = False
        sym[inside] = self.byte_symbol[np.frombuffer(b"".join(words), "u1")]
        nxt, prv = np.arange(1, len(sym) + 1), np.arange(-1, len(sym) - 1)
        where: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def index(keys: np.ndarray, spots: np.ndarray) -> None:
            """Add positions to the lists of their pairs; pairs are named by their rank."""
            ranks = self._ranked(keys)
            known = ranks >= 0
            if not known.any():
                return
            ranks, spots = ranks[known], spots[known]
            order = np.argsort(ranks, kind="stable")
            ranks, spots = ranks[order], spots[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for rank, a, b in zip(ranks[starts[:-1]].tolist(), starts[:-1], starts[1:], strict=True):
                if rank in where:
                    where[rank].append(spots[a:b])
                else:
                    where[rank] = [spots[a:b]]
                    heapq.heappush(active, rank)

        both = np.flatnonzero((sym[:-1] >= 0) & (sym[1:] >= 0))
        index(sym[both] << 32 | sym[both + 1], both)
        while active:
            rank = heapq.heappop(active)
            lists = where.pop(rank)
            left, right, new = self.merges[rank]
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = at[sym[at] == left]
            at = at[sym[nxt[at]] == right]
            if not len(at):
                continue
            if left == right:  # a run of equal symbols pairs up from its left end
                at, taken = np.unique(at), []
                for p, q in zip(at.tolist(), nxt[at].tolist(), strict=True):
                    if not taken or taken[-1][1] != p:
                        taken.append((p, q))
                at = np.array([p for p, _ in taken])
            gone = nxt[at]
            after = nxt[gone]
            sym[at], sym[gone] = new, -2
            nxt[at] = after
            prv[after] = at
            before = prv[at]
            s, t = sym[after], np.where(before >= 0, sym[before], -1)
            keys = np.concatenate([new << 32 | s[s >= 0], t[t >= 0] << 32 | new])
            if len(keys):
                index(keys, np.concatenate([at[s >= 0], before[t >= 0]]))
        keep = sym >= 0
        flat = sym[keep].tolist()
        stops = np.cumsum(keep)[ends].tolist()
        return [flat[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def cache(self, value, join) -> PieceCache:
        """A cache of ``value(ids)`` per piece, for use in one task; ``join`` makes one value of several."""
        return PieceCache(
            lambda tokens: [value(ids) for ids in self._merge_words([t.encode() for t in tokens])],
            join, {s: value([i]) for s, i in self.special.items()}, 120_000,
        )

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.cache(list, _chained).look([text])[0]))

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def _chained(lists: list[list[int]]) -> list[int]:
    return list(chain.from_iterable(lists))


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the token ids of every text."""
    kind = dict(docs.dtypes)[id_col]

    def make():
        cache = PairIndexBPE(tokenizer).cache(list, _chained)

        def apply(ids, texts):
            return {id_col: ids, "ids": [list(chain.from_iterable(v)) for v in cache.look(texts)]}

        return apply

    return map_documents(docs, id_col, text_col, make, f"`{id_col}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids give an empty text."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    kind = dict(encoded.dtypes)[id_col]

    def run(batches):
        bpe = PairIndexBPE(tokenizer)
        for b in batches:
            texts = [bpe.decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return encoded.select(id_col, F.col("ids")).mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, and ``ids`` if asked for.

    Decoded texts are digested in the task that makes them, so nothing is shuffled.
    """
    kind = dict(docs.dtypes)[id_col]

    def make():
        bpe = PairIndexBPE(tokenizer)
        # Packed values: a piece's ids as text for the digest, and as 32-bit integers.
        cache = bpe.cache(
            lambda ids: (",".join(map(str, ids)), array("I", ids).tobytes()), lambda values: (",".join([v[0] for v in values]), b"".join([v[1] for v in values]))
        )
        token = bpe.token_bytes

        def apply(ids, texts):
            n, coded, decoded, kept = [], [], [], []
            for found in cache.look(texts):
                tokens = np.frombuffer(b"".join([v[1] for v in found]), "<u4").tolist()
                n.append(len(tokens))
                if with_ids:
                    kept.append(tokens)
                coded.append(hashlib.sha256(",".join([v[0] for v in found]).encode()).hexdigest())
                text = b"".join(map(token.__getitem__, tokens)).decode("utf-8", "replace")
                decoded.append(hashlib.sha256(text.encode()).hexdigest())
            return {id_col: ids, "n_tokens": n, "ids_sha256": coded, "decoded_sha256": decoded, "ids": kept}

        return apply

    ddl = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_documents(docs, id_col, text_col, make, ddl, 2 << 20)
