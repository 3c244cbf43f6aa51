from collections import defaultdict

import numpy as np
import pytest

from pelorus.operators import blocks, reach


def tables(spark, base=0, n_users=40, n_items=200, n_terms=30, signed=False):
    """Users and items over groups of exclusive terms and some rare ones, so that bounds differ between blocks."""
    rng = np.random.default_rng(11)
    a, b = np.zeros((n_users, n_terms)), np.zeros((n_items, n_terms))
    for group in (range(0, 3), range(3, 9), range(9, 29)):
        a[np.arange(n_users), rng.choice(group, n_users)] += rng.integers(1, 5, n_users)
        b[np.arange(n_items), rng.choice(group, n_items)] += rng.integers(1, 5, n_items)
    a[rng.random(a.shape) < 0.1] = 2
    b[::7, 29] = 1
    if signed:
        a *= rng.choice([-1, 1], a.shape)
        b *= rng.choice([-1, 1], b.shape)
    users = [(base + u, base + t, float(a[u, t])) for u, t in zip(*map(np.ndarray.tolist, np.nonzero(a)), strict=True)]
    items = [(base + i, base + t, float(b[i, t])) for i, t in zip(*map(np.ndarray.tolist, np.nonzero(b)), strict=True)]
    left = spark.createDataFrame(users, "user_id long, term_id long, w double")
    return a, b, left, spark.createDataFrame(items, "item_id long, term_id long, w double")


@pytest.mark.parametrize(("base", "signed"), [(0, False), (1 << 60, False), (0, True)])
def test_lists_in_reach_equal_brute_force(spark, monkeypatch, base, signed):
    """Many small segments, strips and pieces; seen pairs; a user who has seen nearly all; large ids; weights of both signs."""
    for name, value in (("_SEGMENT_ENTRIES", 70), ("_STRIP_USERS", 7), ("_EXPAND", 50), ("_FIRST", 2), ("_FEW", 3), ("_MOST_FOUND", 20), ("_OPEN_BYTES", 3000)):
        monkeypatch.setattr(reach, name, value)
    a, b, users, items = tables(spark, base, signed=signed)
    seen = {(u, i) for u in range(40) for i in range(200) if (u * i) % 7 == 3 or u == 0 and i < 196}
    table = spark.createDataFrame([(base + u, base + i) for u, i in sorted(seen)], "user_id long, item_id long")
    got = defaultdict(list)
    for r in reach.top_k_in_reach(users, items, table, 5, (users.count(), items.count()), cell_rows=60).collect():
        got[r["user_id"] - base].append((r["rank"], r["item_id"] - base, r["score"]))
    scores = a @ b.T
    for u in range(40):
        order = sorted((-float(scores[u, i]), i) for i in range(200) if (u, i) not in seen and scores[u, i] > 0)[:5]
        assert sorted(got[u]) == [(n + 1, i, -s) for n, (s, i) in enumerate(order)]


def test_a_cell_holds_the_lists_of_one_strip(spark, monkeypatch):
    """Lists leave a cell strip by strip, and long lists make strips short."""
    monkeypatch.setattr(reach, "_MOST_FOUND", 20)
    _, _, users, items = tables(spark)
    index = reach.build(items, items.count())
    rows = users.selectExpr("false AS is_seen", "user_id", "term_id AS id", "w").toArrow()
    out = list(reach._cell(index, 5)(iter(rows.to_batches(max_chunksize=16))))
    assert len(out) == 10 and all(len(set(batch.column(0).to_pylist())) <= 4 for batch in out)
    assert {u for batch in out for u in batch.column(0).to_pylist()} == set(range(40))


def test_large_catalogs_send_users_and_items_once(spark, monkeypatch):
    """A catalog beyond one block of items goes through the index: nothing is dealt to a grid of (user block, item block)."""
    a, b, users, items = tables(spark)
    seen = spark.createDataFrame([(0, 0)], "user_id long, item_id long")
    monkeypatch.setattr(blocks, "_grid", None)
    recs = blocks.sparse_top_k(users, items, seen, 3, 40, 200, 30, (users.count(), items.count()), item_block=50)
    assert recs.count() == 40 * 3


def test_blocks_out_of_reach_are_not_multiplied(spark, monkeypatch):
    """Most blocks are skipped by their bounds once a user has k items."""
    monkeypatch.setattr(reach, "_FIRST", 4)
    monkeypatch.setattr(reach, "_FEW", 4)
    _, b, users, items = tables(spark, n_users=20, n_items=3000)
    index = reach.build(items, items.count())
    rows = users.orderBy("user_id", "term_id").toPandas()
    met = []
    scores = reach._scores

    def counted(seg, row, *rest):
        met.append(len(row))
        return scores(seg, row, *rest)

    monkeypatch.setattr(reach, "_scores", counted)
    none = np.zeros(0, "int64")
    reach._strip(reach._Segments(index), 20, rows["user_id"].to_numpy(), rows["term_id"].to_numpy(), rows["w"].to_numpy(), none, none, 5)
    assert 0 < sum(met) < 0.25 * 20 * 3000 / reach.BLOCK


def test_users_who_have_seen_much_take_the_join(spark):
    """A cell never holds a history beyond the limit, however few terms the user has."""
    a, b, users, items = tables(spark)
    pairs = [(u, i) for u in (0, 1) for i in range(150)] + [(2, 5)]
    seen = spark.createDataFrame(pairs, "user_id long, item_id long")
    recs = blocks.sparse_top_k(users, items, seen, 4, 40, 200, 150, (users.count(), items.count()), item_block=50, long_entries=100)
    got = defaultdict(list)
    for r in recs.collect():
        got[r["user_id"]].append((r["rank"], r["item_id"], r["score"]))
    scores = a @ b.T
    for u in range(40):
        order = sorted((-float(scores[u, i]), i) for i in range(200) if (u, i) not in set(pairs) and scores[u, i] > 0)[:4]
        assert sorted(got[u]) == [(n + 1, i, -s) for n, (s, i) in enumerate(order)]


def test_lists_of_terms_are_read_from_files(spark, monkeypatch):
    """Nothing is sent per product: lists over several segments and parts of a term, equal to brute force."""
    monkeypatch.setattr(blocks, "needed_lists", None)
    for name, value in (("_SEGMENT_ENTRIES", 60), ("_LEAST_ENTRIES", 10), ("_CELL_PRODUCTS", 90)):
        monkeypatch.setattr(blocks, name, value)
    a, b, users, items = tables(spark)
    seen = {(u, i) for u in range(40) for i in range(200) if (u + i) % 5 == 0}
    table = spark.createDataFrame(sorted(seen), "user_id long, item_id long")
    lists = blocks.write_lists(items, items.count())
    assert len(lists.segments) > 2
    got = defaultdict(list)
    for r in blocks.sparse_top_k(users, items, table, 4, 40, 200, 30, (users.count(), items.count()), sparse_share=1.0).collect():
        got[r["user_id"]].append((r["rank"], r["item_id"], r["score"]))
    scores = a @ b.T
    for u in range(40):
        order = sorted((-float(scores[u, i]), i) for i in range(200) if (u, i) not in seen and scores[u, i] > 0)[:4]
        assert sorted(got[u]) == [(n + 1, i, -s) for n, (s, i) in enumerate(order)]
