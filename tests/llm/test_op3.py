import hashlib
import random
import re

import numpy as np
import pytest

from pelorus.llm import op3_decontaminate as op
from pelorus.llm.fm_index import FMIndex
from pelorus.llm.registry import op3_decontamination
from pelorus.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def word_list(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = word_list(text)
        for at in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[at : at + size]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = word_list(text), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit.update(range(at, at + n))
                    found |= {str(x) for x in windows[tuple(w[at : at + n])] if x is not None}
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(0)
    for seq in (rng.integers(1, 4, 300), np.ones(100, int), np.array([1])):
        index = FMIndex(seq)
        for n in (1, 2, 5):
            patterns = np.array([rng.integers(1, 5, n) for _ in range(40)])
            low, high = index.find(patterns, np.full(40, n))
            for p, a, b in zip(patterns, low, high, strict=True):
                want = [i for i in range(len(seq) - n + 1) if (seq[i : i + n] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.fixture
def cases():
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(["A", "b", "é", "dd", "9x"]) for _ in range(rng.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(12, items[5][1].upper()), (13, None), (14, "..."), (None, "null item words here"), (5, "second text of item five")]
    docs = [(i, ", ".join(rng.choice(["A", "b", "é", "dd", "9x"]) for _ in range(60))) for i in range(20)]
    docs += [(100 + i, f"before {t} after") for i, (_, t) in enumerate(items) if t]
    docs += [(200, None), (201, ""), (202, "!?"), (None, items[4][1]), (100, items[4][1]), (203, "b " * 20000 + items[11][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_against_brute_force(spark, cases, block_bytes):
    docs, items = cases
    df = spark.createDataFrame([(i, t, 0, "s") for i, t in docs], "doc_id long, text string, n_hit int, spans string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    blocks = op.phrases(bench, block_bytes=block_bytes)
    assert rows_of(op.report(df, blocks)) == brute(docs, items)
    cut = op.without_phrases(df, blocks)
    assert cut.columns == df.columns and cut.count() == len(docs)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[200] is None and texts[102].startswith("before") and texts[102].endswith("after")


def test_empty_tables(spark, cases):
    df = spark.createDataFrame(cases[0], "doc_id long, text string")
    bench = spark.createDataFrame(cases[1], "item_id long, text string")
    none = op.phrases(bench.limit(0))
    assert rows_of(op.report(df, none)) == brute(cases[0], [])
    assert op.report(df.limit(0), op.phrases(bench)).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    want = brute(docs, items)
    assert rows_of(op3_decontamination(spark, SF)) == want and any(r[5] for r in want)


def test_a_phrase_of_a_thousand_items_is_named_once_per_document(spark):
    phrase = " ".join(f"p{i}" for i in range(14))
    items = spark.createDataFrame([(f"i{n:04d}", phrase + f" only{n}") for n in range(1000)], "item_id string, text string")
    blocks = op.phrases(items)
    block = blocks.load(blocks.names[0])
    words = (phrase + " x ") * 300
    ids = np.array([block.vocabulary.get(w.encode(), 0) for w in words.split()] + [0])
    _, found = block.search(ids, np.array([0]))
    # Four whole windows of the phrase are in every item, whatever the number of places.
    assert len(found) <= 5 and {len(block.sets[s]) for _, s in found.tolist()} == {1000}
    got = op.report(spark.createDataFrame([(1, words), (2, "none")], "doc_id long, text string"), blocks).collect()
    assert {r.doc_id: r.n_items for r in got} == {1: 1000, 2: 0}
