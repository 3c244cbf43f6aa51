import random
import re

import pytest

from pelorus.llm import op4_jaccard as op
from pelorus.llm.common import table
from pelorus.llm.components import components
from pelorus.llm.registry import op4_ngram_jaccard

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    name = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            name[find(i)] = min(name.get(find(i), d), d)
    return sorted(((d, len(s), name.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def rows_of(df):
    return sorted((tuple(r)[:3] for r in df.collect()), key=repr)


@pytest.fixture
def cases():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        words = [rng.choice(vocab) for _ in range(rng.choice([3, 5, 8, 40, 200]))]
        for copy in range(rng.choice([1, 2, 9])):
            mine = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, len(mine) // 40])):
                mine[rng.randrange(len(mine))] = rng.choice(vocab)
            rows.append((base * 100 + copy, " ".join(mine)))
    line = " ".join(rng.choice(vocab) for _ in range(25))
    rows += [(2000 + i, line + "\n" + " ".join(rng.choice(vocab) for _ in range(rng.choice([2, 8, 60])))) for i in range(40)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "One two"), (3004, "one TWO"), (3005, "é" * 20000), (3006, "É" * 20000)]
    rows += [rows[5], (None, rows[5][1]), (None, "alone without id here today"), (3007, "same " * 3000), (3008, "same " * 10)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [128, 3])
def test_against_brute_force(spark, cases, block):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in cases], "doc_id long, text string, component int, uid string")
    assert rows_of(op.components_of(docs, block=block)) == brute(cases)


def test_longer_prefixes_when_lists_are_long():
    import numpy as np

    assert op.choose_prefix(100, np.ones(100, "int64"))[0] == 1
    counts = np.sort(np.r_[np.full(30, 1000), np.full(70, 1001)])
    l, length = op.choose_prefix(100, counts)
    assert l > 1 and length == 25 + l


def test_one_per_group(spark, cases):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in cases], "doc_id long, text string, component int, uid string")
    kept = op.one_per_group(docs)
    assert kept.columns == docs.columns
    want = brute(cases)
    linked = {c for d, n, c in want if n}
    got = kept.collect()
    assert len(got) == len({(c if n else ("own", k)) if c is not None else ("none", k) for k, (d, n, c) in enumerate(want)})
    assert {r.doc_id for r in got if shingles(r.text) and r.doc_id is not None} == {c for c in linked if c is not None}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.components_of(docs).count() == 0 and op.one_per_group(docs).count() == 0


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    root = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in range(len(pairs)):
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == root


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert rows_of(op4_ngram_jaccard(spark, SF)) == brute(rows)


def test_string_ids_name_components(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([("b", text), ("a", text), ("c", "something else altogether in this text"), (None, text)], "doc_id string, text string")
    assert rows_of(op.components_of(docs)) == sorted([("a", 4, "a"), ("b", 4, "a"), ("c", 2, "c"), (None, 4, "a")], key=repr)
    assert {r.doc_id for r in op.one_per_group(docs).collect()} == {"a", "c"}
