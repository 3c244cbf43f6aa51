"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, a sample of all other text is unlabelled. A linear classifier over hashed words and word beginnings is trained in
numpy on the class-prior-corrected risk

    prior * E_p[l(z)] + max(0, E_u[l(-z)] - prior * E_p[l(-z)])

with logistic loss l; where the second part falls below zero, its gradient is followed upwards. Words and word beginnings enter as present or
absent, weighted by their log ratio between positives and unlabelled text, which is shrunk towards 0 the more, the less certain the
difference of their rates is; so few positives still teach something, and many drown in no chance words. Every whole text is then scored in
a narrow map job with one broadcast weight vector of fixed size.

The training sample is bounded: at most ``max_positive`` and ``max_unlabelled`` documents, those with the smallest hash of their
id. Spark counts the sample's words; the driver gets counts (one row per slot) and, per sampled document, the slots that carry a weight. The class prior is the rate of toxic labels among all training labels.

Edge cases: null and empty texts have no words and get the score of the bias alone; a document labelled several times is toxic
if any label says so; null labels are no labels; without a confirmed toxic document every score is 0. Repeated document ids
are scored row by row; a null id is never held out and never a training row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import durable
from .common import release, slices, text_of, tidy

# Bytes of words (letters A-Z as lower case, digits, all beyond ASCII); every other byte separates.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
THRESHOLD = 0.3
_HALF_Z = 5.0
_LEAST_Z = 3.0


def words(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def features(word: bytes) -> list[bytes]:
    """What a word says: itself, and how it begins (3 to 6 characters), since many languages build words on a stem."""
    chars = word.decode("utf-8", "replace")
    return [word, *((chars[:n] + "*").encode() for n in range(3, 7) if n <= len(chars))]


def slots_of(word: bytes, mask: int) -> list[int]:
    return [xxhash.xxh64_intdigest(f) & mask for f in features(word)]


@dataclass
class Model:
    """``weights`` by word slot (2^bits of them) and the bias; ``weights`` is None if there was nothing to learn from."""

    weights: np.ndarray | None
    bias: float
    bits: int
    prior: float

    def scorer(self):
        """A function from text to score, with a bounded memory of word weights."""
        if self.weights is None:
            return lambda text: 0.0
        table, mask = self.weights, (1 << self.bits) - 1

        class Slots(dict):
            """The slots with a weight of a word; most words have none."""

            def __missing__(self, word):
                found = tuple(i for i in slots_of(word, mask) if table[i])
                if len(self) < 200_000:
                    self[word] = found
                return found

        slots, bias = Slots(), self.bias

        def score(text: str) -> float:
            present = set().union(*filter(None, map(slots.__getitem__, set(words(text)))))
            z = bias + math.fsum(float(table[i]) for i in present)
            return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))

        return score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _slots(docs: DataFrame, bits: int) -> DataFrame:
    """``(positive, slots)``: the distinct word slots of each text, packed as 32-bit integers."""

    def run(batches):
        tidy()
        mask = (1 << bits) - 1

        @lru_cache(maxsize=100_000)
        def coded(word):
            return slots_of(word, mask)

        for b in batches:
            packed = []
            for text in b.column(1).to_pylist():
                present = set().union(*map(coded, set(words(text))))
                packed.append(np.sort(np.fromiter(present, "<u4", len(present))).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["positive", "slots"])

    return docs.select("positive", "text").mapInArrow(run, "positive boolean, slots binary")


def certainty(df_p: np.ndarray, df_u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """How far a slot's log ratio counts, 0 to 1, by the z of a two-proportion test: half at ``_HALF_Z``, 0 below ``_LEAST_Z``, where it
    would be under 2 per cent."""
    pooled = (df_p + df_u) / (n_p + n_u)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n_p + 1 / max(n_u, 1)))
    z = np.abs(df_p / n_p - df_u / max(n_u, 1)) / error / _HALF_Z
    return np.where((df_p + df_u >= 3) & (z >= _LEAST_Z / _HALF_Z), z**8 / (z**8 + 1), 0.0)


def _telling(coded: DataFrame, bits: int) -> list[tuple[bool, bytes]]:
    """``(unlabelled, slots)`` of every sampled text, positives first, with the slots that will have a weight."""

    def count(batches):
        sums = {True: np.zeros(1 << bits, "int64"), False: np.zeros(1 << bits, "int64")}
        rows = {True: 0, False: 0}
        for b in batches:
            for positive, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[positive][np.frombuffer(packed, "<u4")] += 1
                rows[positive] += 1
        slot = np.flatnonzero(sums[True] + sums[False])
        # The numbers of texts come as slot -1.
        columns = [np.append(slot, -1), np.append(sums[True][slot], rows[True]), np.append(sums[False][slot], rows[False])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slot", "p", "u"])

    counts = coded.mapInArrow(count, "slot bigint, p bigint, u bigint").groupBy("slot").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    # At most 2^bits rows, whatever the length of the texts.
    found = np.array([tuple(r) for r in counts.filter("slot < 0 or p + u >= 3").collect()], "int64").reshape(-1, 3)
    slot, df_p, df_u = found.T
    n_p, n_u = int(df_p[slot < 0].sum()), int(df_u[slot < 0].sum())
    active = np.sort(slot[(slot >= 0) & (certainty(df_p, df_u, n_p, n_u) > 0)]).astype("u4") if n_p else np.zeros(0, "u4")

    def cut(batches):
        for b in batches:
            kept = [np.intersect1d(np.frombuffer(p, "<u4"), active, assume_unique=True).astype("<u4").tobytes() for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.binary())], ["positive", "slots"])

    return sorted((not r["positive"], bytes(r["slots"])) for r in coded.mapInArrow(cut, "positive boolean, slots binary").collect())


def nn_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, bits: int, epochs: int, decay: float) -> tuple[np.ndarray, float]:
    """Weights per slot and bias that minimise the non-negative risk; full-batch Adam, so the result is deterministic."""
    size, n_p, n_u = 1 << bits, len(positive), len(unlabelled)
    df_p = np.bincount(np.concatenate(positive), minlength=size)
    df_u = np.bincount(np.concatenate([*unlabelled, np.zeros(0, "u4")]).astype("int64"), minlength=size)
    share = certainty(df_p, df_u, n_p, n_u)
    active = np.flatnonzero(share)
    ratio = share[active] * (np.log((df_p[active] + 0.5) / (n_p + 1)) - np.log((df_u[active] + 0.5) / (n_u + 1)))
    place = np.full(size, -1, "int64")
    place[active] = np.arange(len(active))
    docs = [place[d][place[d] >= 0] for d in positive + unlabelled]
    owner, word = np.repeat(np.arange(len(docs)), [len(d) for d in docs]), np.concatenate([*docs, np.zeros(0, "int64")]).astype("int64")
    value = ratio[word]
    w, bias = np.zeros(len(active)), math.log(prior / (1 - prior))
    m, v = np.zeros(len(active) + 1), np.zeros(len(active) + 1)
    for step in range(1, epochs + 1):
        z = bias + np.bincount(owner, value * w[word], len(docs))
        s = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        loss_neg = np.logaddexp(0, z)  # l(-z)
        negative = loss_neg[n_p:].mean() - prior * loss_neg[:n_p].mean() if n_u else 0.0
        d_negative = np.concatenate([-prior * s[:n_p] / n_p, s[n_p:] / max(n_u, 1)])
        d_positive = np.concatenate([prior * (s[:n_p] - 1) / n_p, np.zeros(n_u)])
        dz = d_positive + d_negative if negative >= 0 else -d_negative
        grad = np.append(np.bincount(word, value * dz[owner], len(active)) + decay * w, dz.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    # The scores of unlabelled text must average to the prior; the bias that does so is found by bisection.
    z = np.bincount(owner, value * w[word], len(docs))[n_p:]
    low, high = -30.0, 30.0
    for _ in range(60 if n_u else 0):
        bias = (low + high) / 2
        low, high = (bias, high) if (1 / (1 + np.exp(-np.clip(z + bias, -50, 50)))).mean() < prior else (low, bias)
    out = np.zeros(size, "float32")
    out[active] = w * ratio
    return out, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, bits: int = 20, max_positive: int = 3000, max_unlabelled: int = 9000, epochs: int = 300,
    decay: float = 1e-4, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Model:
    """Fit on rows that are not held out; only their ids choose the sample, and only texts enter the features."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        return Model(None, 0.0, bits, 0.0)
    prior = min(max(toxic / n, 1e-4), 0.5)
    order = F.xxhash64("id")
    picked = known.filter("toxic = 1").orderBy(order, "id").limit(max_positive).select("id", F.lit(True).alias("positive"))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).filter(F.col("id").isNotNull() & ~held_out(F.col("id")))
    others = texts.select("id").distinct().orderBy(order, "id").limit(max_unlabelled).select("id", F.lit(False).alias("positive"))
    # Unlabelled text is all text, known positives included, as the prior asks for. At most max_positive + max_unlabelled ids; a
    # repeated id brings one text.
    chosen = others.unionByName(picked)
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "positive").agg(F.min("text").alias("text"))
    rows = _telling(durable(_slots(sample, bits)), bits)
    packed = [np.frombuffer(b, "<u4") for _, b in rows]
    n_p = sum(1 for first, _ in rows if not first)
    if not n_p:
        return Model(None, 0.0, bits, prior)
    weights, bias = nn_pu(packed[:n_p], packed[n_p:], prior, bits, epochs, decay)
    del rows, packed
    release()
    return Model(weights, bias, bits, prior)


def with_score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``(row, score)``: every row of ``docs`` as a struct, and its score."""
    schema = StructType([StructField("row", docs.schema, False), StructField("score", DoubleType(), False)])

    def run(batches):
        tidy()
        score = model.scorer()
        for part in slices(batches, 1, 8 << 20):
            values = pa.array([score(t) for t in part.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(0), values], ["row", "score"])

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of(text_col).alias("text")).mapInArrow(run, schema)


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = with_score(narrow.withColumn("id", F.col("id")), model)
    return keyed.select(
        F.col("row.id").alias(id_col),
        held_out(F.col("row.id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    return with_score(docs, model, text_col).filter(F.col("score") < threshold).select("row.*")
