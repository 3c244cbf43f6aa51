import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelorus.llm import op11_hard_negatives as op

SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def brute(rows, step=50):
    usable = {(i, c, tuple(math.floor(256 * x) for x in v)) for i, v, c in rows if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, c, q in usable:
        if i % step:
            continue
        score = [(-sum(a * b for a, b in zip(q, v, strict=False)), j, d) for j, d, v in usable]
        for p, j, _ in sorted(x for x in score if x[2] == c and x[1] != i)[:5]:
            far = sorted(x for x in score if x[2] != c and 50 * -p <= 100 * -x[0] <= 95 * -p)
            out += [(i, j, rank + 1, k, -p, -s) for rank, (s, k, _) in enumerate(far[:3])]
    return sorted(out)


def test_lookups_are_inner_products():
    rng = np.random.default_rng(1)
    for width, reach in ((1, 3), (8, 200), (13, 70000), (16, 1)):
        rows, anchors = rng.integers(-reach, reach + 1, (50, width)), rng.integers(-reach, reach + 1, (7, width))
        got = op.lookup_scores(op.subset_sums(anchors, "int64"), op.pack_planes(rows))
        assert (got == rows @ anchors.T).all()
    assert (op.lookup_scores(op.subset_sums(anchors, "int32"), op.pack_planes(np.zeros((3, 16), "int64"))) == 0).all()


@pytest.mark.parametrize("scale", [0.1, 1e5])
def test_against_brute_force(spark, scale):
    rng = random.Random(2)
    rows = [(i, [scale * (rng.random() + 0.5) for _ in range(11)], 1 if i % 3 else rng.randrange(5)) for i in range(160)]
    rows += [(200 + i, [scale] * 11, i % 2) for i in range(40)]  # ties
    rows += [(400, None, 1), (401, [1.0, None], 1), (450, [float("nan")], 1), (451, [scale] * 11, None), (500, [], 1), (None, [scale] * 11, 2)]
    rows += [(550, [scale] * 4, 1), (50, rows[50][1], rows[50][2]), (50, [2 * scale] * 11, 3), (600, [-scale] * 11, 4)]
    df = spark.createDataFrame([(i, v, c, "x") for i, v, c in rows], SCHEMA)
    ready = op.prepare(df, F.col("label"))
    want = brute(rows)
    assert want
    for block, chunk, stripe in ((1000, None, 64), (7, 2, 3)):
        got = op.mine(ready, F.col("vec_id") % 50 == 0, index=op.build(ready, block), chunk=chunk, stripe_blocks=stripe)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_empty_and_lonely(spark):
    none = op.prepare(spark.createDataFrame([], SCHEMA), F.col("label"))
    assert op.mine(none, F.col("vec_id") % 50 == 0).count() == 0
    one = op.prepare(spark.createDataFrame([(0, [1.0], 1, ""), (1, [0.7], 2, "")], SCHEMA), F.col("label"))
    assert op.mine(one, F.col("vec_id") % 50 == 0).count() == 0


def test_a_hot_label_is_many_blocks(spark):
    df = spark.createDataFrame([(i, [float(i % 9)], 1, "") for i in range(300)], SCHEMA)
    index = op.build(op.prepare(df, F.col("label")), 20)
    assert len(index.blocks) >= 15 and max(b[2] for b in index.blocks) <= 20
