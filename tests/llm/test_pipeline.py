import hashlib

from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pelorus.llm.common import table
from pelorus.llm.registry import tokenizer_path
from pelorus.session import durable

from test_op2 import brute as line_brute
from test_op3 import word_list
from test_op4 import brute as near_brute
from test_op4 import shingles

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    inputs = []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs.collect())
        docs = durable(stage(spark, docs, SF))
        if name != "bpe":
            assert docs.columns == columns
    start, clean, cut, single, decontaminated = inputs
    assert {r.doc_id for r in clean} < {r.doc_id for r in start}
    words = {"idiot", "moron", "scum", "stupid", "trash", "loser", "clown", "pathetic", "worthless", "disgusting"}
    assert all(len(words & set(word_list(r.text))) < 5 for r in clean)

    want = {d: h for d, _, _, h in line_brute([(r.doc_id, r.text, r.source) for r in clean], 10)}
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in cut} == want
    assert all(r.n_chars == len(r.text) for r in cut)

    groups = near_brute([(r.doc_id, r.text) for r in cut])
    assert {r.doc_id for r in single} == {d if not n else c for d, n, c in groups}

    items = [word_list(r.text) for r in table(spark, SF, "benchmark").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    before = {r.doc_id: word_list(r.text) for r in single}
    for r in decontaminated:
        w = before[r.doc_id]
        hit = set()
        for i in range(len(w) - 9):
            if tuple(w[i : i + 10]) in windows:
                hit.update(range(i, i + 10))
        assert word_list(r.text) == [x for i, x in enumerate(w) if i not in hit]
    assert any(len(word_list(r.text)) < len(before[r.doc_id]) for r in decontaminated)

    t = Tokenizer.from_file(tokenizer_path())
    texts = {r.doc_id: r.text for r in decontaminated}
    final = docs.collect()
    assert len(final) == len(texts)
    for r in final:
        assert list(r.ids) == t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_near_copies_and_shingles_helper():
    assert len(shingles("a b c d e f")) == 2
