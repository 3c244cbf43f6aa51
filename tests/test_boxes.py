from collections import defaultdict

import numpy as np
import pytest

from pelorus.operators import boxes, pruned


def tables(spark, p, q, base=0):
    users = spark.createDataFrame([(base + i, v.tolist()) for i, v in enumerate(p)], "user_id long, vec array<double>")
    return users, spark.createDataFrame([(base + i, v.tolist()) for i, v in enumerate(q)], "item_id long, vec array<double>")


def written(spark, q, segment_items=1 << 16):
    _, items = tables(spark, q[:1], q)
    return boxes._Segments(boxes.build(items, len(q), segment_items), boxes._KINDS)


@pytest.mark.parametrize(("base", "k", "step"), [(0, 5, 0.25), (1 << 60, 5, 0.25), (0, 3, 1e-9), (0, 40, 0.25), (0, 400, 0.25)])
def test_lists_in_boxes_equal_brute_force(spark, monkeypatch, base, k, step):
    """Many tied and equal vectors, small leaves, segments and strips, seen pairs, a user who has seen nearly all, long lists, large ids."""
    for name, value in (("LEAF", 8), ("_STRIP_USERS", 7), ("_FIRST", 1), ("_MOST_FOUND", 20), ("_CELL_USERS", 11)):
        monkeypatch.setattr(boxes, name, value)
    monkeypatch.setattr(pruned, "_product", None)
    rng = np.random.default_rng(3)
    p, q = rng.integers(-3, 4, (40, 3)) * step, rng.integers(-3, 4, (300, 3)) / 4
    p[3] = 0
    users, items = tables(spark, p, q, base)
    seen = {(u, i) for u in range(40) for i in range(300) if (u * i) % 7 == 3 or u == 0 and i < 296}
    table = spark.createDataFrame([(base + u, base + i) for u, i in sorted(seen)], "user_id long, item_id long")
    got = defaultdict(list)
    for r in pruned.dense_top_k(users, items, table, k, 40, 300, item_block=70).collect():
        got[r["user_id"] - base].append((r["rank"], r["item_id"] - base, r["score"]))
    scores = np.round(p @ q.T, 10)
    for u in range(40):
        order = sorted((-float(scores[u, i]), i) for i in range(300) if (u, i) not in seen)[:k]
        assert sorted(got[u]) == [(n + 1, i, -s) for n, (s, i) in enumerate(order)]


def test_leaves_out_of_reach_are_not_multiplied(spark, monkeypatch):
    """Vectors that all differ: most leaves are skipped by their bounds once a user has k items."""
    rng = np.random.default_rng(5)
    p, q = rng.normal(size=(50, 4)), rng.normal(size=(20_000, 4))
    met = []
    meet = boxes._meet

    def counted(seg, leaf, rows, *rest):
        met.append(len(rows))
        return meet(seg, leaf, rows, *rest)

    monkeypatch.setattr(boxes, "_meet", counted)
    none = np.zeros(0, "int64")
    row, item, score = boxes._strip(written(spark, q, 4000), p, none, none, 5, False)
    want = np.sort(np.round(p @ q.T, 10), axis=1)[:, :-6:-1]
    assert score.reshape(50, 5) == pytest.approx(want)
    assert sum(met) < 0.25 * 50 * 20_000 / boxes.LEAF


def test_ties_beyond_the_list_are_not_multiplied(spark, monkeypatch):
    """Of many equal vectors only the leaves with the smallest ids are met."""
    q = np.repeat([[1.0, 0.0], [0.5, 0.5]], 5000, axis=0)
    met = []
    meet = boxes._meet
    monkeypatch.setattr(boxes, "_meet", lambda seg, leaf, *rest: met.append(leaf) or meet(seg, leaf, *rest))
    none = np.zeros(0, "int64")
    _, item, _ = boxes._strip(written(spark, q), np.array([[1.0, 0.0]]), none, none, 10, False)
    assert item.tolist() == list(range(10)) and len(met) <= 3


def test_positive_lists_and_unusable_vectors(spark):
    users, items = tables(spark, np.array([[1.0], [-1.0], [0.0]]), np.array([[-1.0], [0.0], [2.0], [np.nan]]))
    none = spark.createDataFrame([], "user_id long, item_id long")
    got = boxes.top_k_in_boxes(users, items, none, 3, 3, 4, 2, positive=True).collect()
    assert sorted(tuple(r) for r in got) == [(0, 2, 1, 2.0), (1, 0, 1, 1.0)]
    every = boxes.top_k_in_boxes(users, items, none, 3, 3, 4, 2)
    assert every.filter("item_id = 3").count() == 0 and every.count() == 9
