import math
import random

import duckdb
import numpy as np
import pytest

from pelorus.llm import op8_exact_topk as op
from pelorus.llm.registry import op8_exact_top20

SF = "/root/testdata/sf0.001"


def brute(rows, k, query=lambda i: i % 20 == 0):
    usable = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in usable:
        if query(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in usable if j != i)
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [0.2, 40.0, 1e4, 3e6])
def test_against_brute_force(spark, scale):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, scale) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [scale] * 6) for i in range(60)]  # ties, more of them than k
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")]), (403, [float("inf")]), (404, []), (None, [1.0]), (420, [1.0, 2.0]), (20, rows[20][1])]
    rows += [(500 + i, [0.0] * 5 + [8 * scale]) for i in range(3)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    vectors = op.impacts(df)
    for block_rows, chunk in ((1000, 256), (40, 3)):
        got = op.search(op.build(vectors, block_rows), vectors.filter("vec_id % 20 = 0"), 20, chunk)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, 20)


def test_early_stop_keeps_every_member(spark):
    # A few large components decide; the small rest is bounded away.
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.0, 30.0 + i % 7]), 0.02 * rng.random(), 0.02 * rng.random()]) for i in range(400)]
    vectors = op.impacts(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = op.search(op.build(vectors, 100), vectors.filter("vec_id % 20 = 0"), 5)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert op.search(op.build(op.impacts(none)), op.impacts(none)).count() == 0
    one = op.impacts(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>"))
    assert op.search(op.build(one), one).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(tuple(r) for r in op8_exact_top20(spark, SF).collect()) == sorted(con.execute(op.SQL).fetchall())


def test_postings_are_left_unread_on_the_embeddings(spark):
    vectors = op.impacts(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    index = op.build(vectors, 1000)
    rows = [(r.vec_id, r.q) for r in vectors.filter("vec_id % 20 = 0").collect()]
    ids, q = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    for block in index.blocks:
        who, found, score, read = op._block_members(index, block, ids, q, 20, None)
        assert read.mean() < 0.95 * block[2][-1] and (read < block[2][-1]).mean() > 0.2
        assert (np.bincount(who, minlength=len(ids)) >= 20).all()
