import hashlib
import random

import numpy as np
import pytest

from pelorus.llm import op9_substrings as op
from pelorus.llm.common import table
from pelorus.llm.registry import op9_repeated_substrings

SF = "/root/testdata/sf0.001"


def brute(rows):
    where = {}
    texts = [(t or "").encode() for _, t in rows]
    for d, t in enumerate(texts):
        for i in range(len(t) - 199):
            where[t[i : i + 200]] = where.get(t[i : i + 200], 0) + 1
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        end = 0
        for s in range(len(t) - 199):
            if where[t[s : s + 200]] > 1:
                for k in range(max(s, end), s + 200):
                    gone[k] = 1
                end = s + 200
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(8)

    def text(n):
        return "".join(rng.choice("abcdé fgh\n") for _ in range(n))

    passages = [text(n) for n in (99, 199, 200, 201, 250, 700)]
    rows = [(i, text(rng.randrange(0, 900))) for i in range(30)]
    for i in range(60):
        body = [text(rng.randrange(0, 150)) for _ in range(3)]
        for _ in range(2):
            body.insert(rng.randrange(4), rng.choice(passages))
        rows.append((100 + i, "".join(body)))
    base = text(1500)
    for i in range(12):  # near copies
        k = rng.randrange(1400)
        rows.append((300 + i, base[:k] + text(3) + base[k + 3 :]))
    rows += [(400, "a" * 3000), (401, "xyz " * 700), (402, "a" * 200), (403, "b" * 199), (404, None), (405, ""), (300, base), (None, base[:400])]
    rows += [(500 + i, rows[3][1] + text(250)) for i in range(2)]
    return rows


@pytest.mark.parametrize("hot, crowd", [(1000, 1000), (3, 1000), (3, 2)])
def test_against_brute_force(spark, cases, hot, crowd):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in cases], "doc_id long, text string, bundle int, start int")
    assert rows_of(op.report(docs, hot=hot, crowd=crowd)) == brute(cases)


def test_hashes_of_hot_windows_only_trim(spark, cases, monkeypatch):
    # As if the hash of every window occurred again: nothing is trimmed, and the bytes decide.
    keys = op._window_keys
    monkeypatch.setattr(op, "_window_keys", lambda rows: np.repeat(keys(rows), 2))
    docs = spark.createDataFrame(cases, "doc_id long, text string")
    assert rows_of(op.report(docs, hot=3)) == brute(cases)


def test_small_pieces(spark, cases, monkeypatch):
    for name, value in (("_PIECE_BYTES", 500), ("_BUNDLE_BYTES", 3000), ("_CHUNK_ROWS", 40)):
        monkeypatch.setattr(op, name, value)
    docs = spark.createDataFrame(cases, "doc_id long, text string")
    assert rows_of(op.report(docs)) == brute(cases)


def test_empty_table(spark):
    assert op.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    want = brute(rows)
    assert rows_of(op9_repeated_substrings(spark, SF)) == want and sum(r[2] for r in want) > 0


def test_anchor_keys_are_even():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 300_000).astype("u1")
    keys = op.anchors(data, np.array([0]), np.array([len(data)]))[1]
    counts = np.bincount((keys >> np.uint64(60)).astype("int64"), minlength=16)
    assert counts.max() < 1.3 * counts.mean()
