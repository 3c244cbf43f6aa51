from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelorus.models.base import TrainSet
from pelorus.models.graph import PersonalizedPageRank
from pelorus.models.knn import ItemKNN
from pelorus.models.markov import Markov, successors
from pelorus.operators import blocks
from pelorus.operators.blocks import sparse_top_k
from pelorus.operators.pairs import shared_user_sums
from pelorus.operators.pruned import dense_top_k, onward


def counts_of(rows):
    m = defaultdict(int)
    for user, item, _ in rows:
        m[user, item] += 1
    return m


@pytest.mark.parametrize("options", [{}, {"long_history": 4, "item_block": 16, "chunk_rows": 40}])
def test_shared_user_sums(spark, skewed, options):
    """Self-join and block product agree with brute force, with one user holding a third of all rows."""
    rows, frame = skewed
    train = TrainSet(frame)
    pairs = train.pairs.select("user_id", "item_id", F.col("m").cast("double").alias("a"), F.col("m").cast("double").alias("b"))
    got = {(r[0], r[1]): r[2] for r in shared_user_sums(pairs, train.max_history, train.n_items, **options).collect()}
    want = defaultdict(float)
    m = counts_of(rows)
    by_user = defaultdict(list)
    for (user, item), n in m.items():
        by_user[user].append((item, n))
    for items in by_user.values():
        for i, a in items:
            for j, b in items:
                if i < j:
                    want[i, j] += a * b
    assert got == dict(want)


@pytest.mark.parametrize("long_history", [256, 5])
def test_knn(spark, skewed, long_history):
    rows, frame = skewed
    train = TrainSet(frame)
    model = ItemKNN(k_neighbors=6, shrinkage=3, long_history=long_history).fit(train)
    m = counts_of(rows)
    users, items = sorted({u for u, _ in m}), sorted({i for _, i in m})
    r = np.array([[m.get((u, i), 0) for i in items] for u in users], dtype=float)
    c = r.T @ r
    s = c / np.sqrt(np.outer(np.diag(c), np.diag(c)))
    np.fill_diagonal(s, 0)
    s = np.round(s * c / (c + 3), 10)
    for row in s:
        keep = np.lexsort((np.arange(len(items)), -row))[:6]
        mask = np.ones(len(items), bool)
        mask[keep] = False
        row[mask] = 0
    scores = np.round((r > 0) @ s, 10)
    got = defaultdict(list)
    for row in model.recommend_all(train.history.select("user_id").distinct(), 5).filter("score IS NOT NULL").collect():
        got[row["user_id"]].append((row["rank"], row["item_id"], row["score"]))
    for a, user in enumerate(users):
        unseen = [(-scores[a, b], item) for b, item in enumerate(items) if r[a, b] == 0 and scores[a, b] > 0]
        want = {(n + 1, item): -score for n, (score, item) in enumerate(sorted(unseen)[:5])}
        assert {(r, i): x for r, i, x in got[user]} == pytest.approx(want)
    explained = model.explain_all(spark.createDataFrame([(1,), (777,)], "user_id long"), 2).collect()
    texts = {row["user_id"]: row["explanation"] for row in explained}
    assert texts[1].startswith("Recommended because it is similar to a previously liked recipe (recipe_id=")
    assert texts[777] == "Recommended due to general popularity (Cold Start)."


@pytest.mark.parametrize(("steps", "long_history"), [(3, 256), (5, 5), (6, 256)])
def test_page_rank_is_the_expected_number_of_visits(spark, skewed, steps, long_history):
    """Against the chain itself: node probabilities stepped with restarts, visits to unseen items summed."""
    rows, frame = skewed
    train = TrainSet(frame)
    model = PersonalizedPageRank(alpha=0.2, max_steps=steps, n_walks=50, long_history=long_history).fit(train)
    m = counts_of(rows)
    users, items = sorted({u for u, _ in m}), sorted({i for _, i in m})
    b = np.array([[float((u, i) in m) for i in items] for u in users])
    to_item, to_user = b / b.sum(1, keepdims=True), (b / b.sum(0, keepdims=True)).T
    got = {}
    for row in model.recommend_all(train.history.select("user_id").distinct(), 60).filter("score IS NOT NULL").collect():
        got[row["user_id"], row["item_id"]] = row["score"]
    for a, user in enumerate(users):
        at_user, at_item, visits = np.eye(len(users))[a], np.zeros(len(items)), np.zeros(len(items))
        for _ in range(steps):
            nxt_item = 0.8 * at_user @ to_item
            nxt_user = 0.8 * at_item @ to_user
            nxt_user[a] += 0.2
            at_user, at_item = nxt_user, nxt_item
            visits += at_item
        want = {(user, i): 50 * visits[n] for n, i in enumerate(items) if b[a, n] == 0 and visits[n] > 1e-12}
        mine = {key: score for key, score in got.items() if key[0] == user}
        assert mine == pytest.approx(want, abs=1e-9)


def test_short_walks_reach_nothing_new(spark, skewed):
    train = TrainSet(skewed[1])
    recs = PersonalizedPageRank(max_steps=2).fit(train).recommend_all(train.history.select("user_id").distinct(), 3)
    assert recs.filter("score IS NOT NULL").count() == 0


@pytest.mark.parametrize("blocks", [(65536, 65536), (7, 5)])
def test_dense_top_k(spark, blocks):
    rng = np.random.default_rng(0)
    p, q = rng.integers(-3, 4, (40, 4)) / 4, rng.integers(-3, 4, (30, 4)) / 4
    users = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(p)], "user_id long, vec array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "item_id long, vec array<double>")
    seen = {(u, i) for u in range(40) for i in range(30) if u == 0 and i < 28 or (u * i) % 7 == 3}
    table = spark.createDataFrame(sorted(seen), "user_id long, item_id long")
    got = defaultdict(list)
    for row in dense_top_k(users, items, table, 5, 40, 30, *blocks).collect():
        got[row["user_id"]].append((row["rank"], row["item_id"], row["score"]))
    for u in range(40):
        order = sorted((-float(p[u] @ q[i]), i) for i in range(30) if (u, i) not in seen)[:5]
        want = {(n + 1, i): -s for n, (s, i) in enumerate(order)}
        assert {(r, i): x for r, i, x in got[u]} == pytest.approx(want)


@pytest.mark.parametrize("options", [{}, {"user_block": 6, "item_block": 9}, {"long_entries": 8}])
def test_sparse_top_k(spark, options):
    """Dense and sparse terms, small blocks, and users whose terms go through the join."""
    rng = np.random.default_rng(1)
    a = rng.integers(1, 5, (30, 50)) * (rng.random((30, 50)) < 0.15)
    b = rng.integers(1, 5, (40, 50)) * (rng.random((40, 50)) < 0.1)
    a[0, :], b[:, 0] = 1, 2
    users = [(u, t, float(a[u, t])) for u in range(30) for t in range(50) if a[u, t]]
    items = [(i, t, float(b[i, t])) for i in range(40) for t in range(50) if b[i, t]]
    seen = {(u, u) for u in range(30)} | {(0, i) for i in range(35)}
    got = defaultdict(list)
    recs = sparse_top_k(
        spark.createDataFrame(users, "user_id long, term_id long, w double"),
        spark.createDataFrame(items, "item_id long, term_id long, w double"),
        spark.createDataFrame(sorted(seen), "user_id long, item_id long"), 4, 30, 40, 50, (len(users), len(items)), **options,
    )
    for row in recs.collect():
        got[row["user_id"]].append((row["rank"], row["item_id"], row["score"]))
    scores = a @ b.T
    for u in range(30):
        order = sorted((-float(scores[u, i]), i) for i in range(40) if (u, i) not in seen and scores[u, i] > 0)[:4]
        assert sorted(got[u]) == [(n + 1, i, -s) for n, (s, i) in enumerate(order)]


@pytest.mark.parametrize("long_history", [100_000, 3])
def test_successors_across_time_slices(spark, skewed, long_history):
    rows, frame = skewed
    links = successors(frame, 83, long_history=long_history).collect()
    want = []
    by_user = defaultdict(list)
    for user, item, day in rows:
        by_user[user].append((day, item))
    for user, events in by_user.items():
        events.sort()
        want += [(user, x[1], y[1]) for x, y in zip(events, events[1:], strict=False)]
    assert sorted((r["user_id"], r["item_i"], r["item_j"]) for r in links) == sorted(want)


def test_markov_uses_the_last_item_and_fills(spark):
    rows = [(1, 10, 1), (1, 20, 2), (2, 10, 1), (2, 20, 2), (3, 10, 1), (3, 30, 2), (4, 40, 1), (4, 10, 2)]
    frame = spark.createDataFrame(rows, "user_id long, item_id long, day int")
    frame = frame.selectExpr("user_id", "item_id", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, day) AS date_time")
    users = spark.createDataFrame([(4,), (1,)], "user_id long")
    recs = Markov().fit(TrainSet(frame)).recommend_all(users, 2).orderBy("user_id", "rank").collect()
    assert [(r["user_id"], r["item_id"], r["score"]) for r in recs] == [(1, 30, None), (1, 40, None), (4, 20, 2.0), (4, 30, 1.0)]


def test_markov_lists_do_not_depend_on_the_rank_depth(spark, skewed):
    train = TrainSet(skewed[1])
    users = train.user_sizes.select("user_id")
    deep, shallow = (
        sorted((r["user_id"], r["rank"], r["item_id"]) for r in Markov(rank_depth=d).fit(train).recommend_all(users, 4).collect())
        for d in (1000, 2)
    )
    assert deep == shallow


@pytest.mark.parametrize("base", [0, 1 << 60])
def test_products_keep_64_bit_ids(spark, base):
    """Ids beyond 2^53 are not exact as doubles; lists must be the same as with small ids."""
    rng = np.random.default_rng(4)
    users, items = rng.normal(size=(9, 3)), rng.normal(size=(14, 3))
    left = spark.createDataFrame([(base + u, v.tolist()) for u, v in enumerate(users)], "user_id long, vec array<double>")
    right = spark.createDataFrame([(base + i, v.tolist()) for i, v in enumerate(items)], "item_id long, vec array<double>")
    pairs = {(u, i) for u in range(9) for i in range(14) if (u + i) % 3 == 0}
    seen = spark.createDataFrame([(base + u, base + i) for u, i in pairs], "user_id long, item_id long")

    def best(scores, positive):
        out = set()
        for u in range(9):
            free = sorted((-round(scores[u, i], 10), i) for i in range(14) if (u, i) not in pairs and (scores[u, i] > 0 or not positive))
            out |= {(base + u, base + i, r + 1) for r, (_, i) in enumerate(free[:3])}
        return out

    scores = users @ items.T
    got = dense_top_k(left, right, seen, 3, 9, 14, user_block=4, item_block=5)
    assert {(r.user_id, r.item_id, r["rank"]) for r in got.collect()} == best(scores, False)
    by_term = [spark.createDataFrame([(base + n, base + t, float(x)) for n, v in enumerate(m) for t, x in enumerate(v)], f"{c} long, term_id long, w double") for m, c in ((users, "user_id"), (items, "item_id"))]
    got = sparse_top_k(*by_term, seen, 3, 9, 14, 3, (27, 42), user_block=4, item_block=5)
    assert {(r.user_id, r.item_id, r["rank"]) for r in got.collect()} == best(scores, True)


def test_long_histories_in_one_instant(spark):
    """A user whose rows all fall in one moment is ordered by the tie column, over many partitions."""
    rows = [(1, i, 0) for i in range(40)] + [(2, i, i) for i in range(3)]
    frame = spark.createDataFrame(rows, "user_id long, item_id long, day int")
    frame = frame.selectExpr("user_id", "item_id", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, day) AS date_time")
    got = {tuple(r) for r in successors(frame, 40, long_history=10).collect()}
    assert got == {(1, i, i + 1) for i in range(39)} | {(2, 0, 1), (2, 1, 2)}


def test_blocks_out_of_reach_are_not_visited(spark):
    """Norms fall steeply: most users stop after the block of the largest norms, and lists equal brute force."""
    rng = np.random.default_rng(3)
    q = rng.normal(size=(60, 4))
    q *= (6.0 / np.arange(1, 61) ** 1.3 / np.linalg.norm(q, axis=1))[:, None]
    p = rng.normal(size=(40, 4))
    users = spark.createDataFrame([(u, [float(x) for x in v]) for u, v in enumerate(p)], "user_id long, vec array<double>")
    items = spark.createDataFrame([(100 + int(i), [float(x) for x in q[i]]) for i in rng.permutation(60)], "item_id long, vec array<double>")
    rows = [(u, 100 + int(i)) for u in range(40) for i in rng.choice(60, 5, replace=False)] + [(0, 100 + i) for i in range(58)]
    seen = spark.createDataFrame(sorted(set(rows)), "user_id long, item_id long")
    got = defaultdict(list)
    for r in dense_top_k(users, items, seen, 4, 40, 60, 16, 10).orderBy("user_id", "rank").collect():
        got[r["user_id"]].append((r["item_id"], r["score"]))
    for u in range(40):
        scores = np.round(q @ p[u], 10)
        free = [i for i in range(60) if (u, 100 + i) not in set(rows)]
        want = sorted(free, key=lambda i: (-scores[i], i))[:4]
        assert [i for i, _ in got[u]] == [100 + i for i in want] and [s for _, s in got[u]] == pytest.approx([scores[i] for i in want])
    norms = np.sort(np.linalg.norm(q, axis=1))[::-1]
    top = [float(norms[10 * b]) for b in range(6)]
    first = dense_top_k(users, items.filter(F.col("item_id").isin([100 + int(i) for i in np.argsort(-np.linalg.norm(q, axis=1))[:10]])), seen, 4, 40, 10)
    visits = onward(users, first, 4, top).count()
    assert visits < 0.6 * 40 * 5


def sparse_tables(spark, n_users=60, n_items=90, n_terms=70):
    rng = np.random.default_rng(8)
    a = rng.integers(1, 5, (n_users, n_terms)) * (rng.random((n_users, n_terms)) < 0.05)
    b = rng.integers(1, 5, (n_items, n_terms)) * (rng.random((n_items, n_terms)) < 0.05)
    a[:20, 0], b[:, 0] = 1, 2
    users = [(u, t, float(a[u, t])) for u, t in zip(*map(np.ndarray.tolist, np.nonzero(a)), strict=True)]
    items = [(i, t, float(b[i, t])) for i, t in zip(*map(np.ndarray.tolist, np.nonzero(b)), strict=True)]
    left = spark.createDataFrame(users, "user_id long, term_id long, w double")
    return a, b, left, spark.createDataFrame(items, "item_id long, term_id long, w double")


@pytest.mark.parametrize("cell_products", [40, 1 << 20])
@pytest.mark.parametrize("base", [0, 1 << 60])
def test_sparse_products_by_users(spark, monkeypatch, cell_products, base):
    """Lists formed from the existing products alone equal brute force, with a term that every item has, strips of some users and large ids."""
    a, b, users, items = sparse_tables(spark)
    shifted = [t.withColumn(c, F.col(c) + base) for t, c in ((users, "user_id"), (items, "item_id"))]
    seen = {(u, u) for u in range(60)} | {(0, i) for i in range(88)}
    table = spark.createDataFrame([(base + u, base + i) for u, i in sorted(seen)], "user_id long, item_id long")
    monkeypatch.setattr("pelorus.operators.blocks._grid", None)
    monkeypatch.setattr("pelorus.operators.blocks._CELL_PRODUCTS", 40)
    got = defaultdict(list)
    recs = sparse_top_k(*shifted, table, 4, 60, 90, 70, (users.count(), items.count()), sparse_share=1.0, cell_products=cell_products)
    for row in recs.collect():
        got[row["user_id"] - base].append((row["rank"], row["item_id"] - base, row["score"]))
    scores = a @ b.T
    for u in range(60):
        order = sorted((-float(scores[u, i]), i) for i in range(90) if (u, i) not in seen and scores[u, i] > 0)[:4]
        assert sorted(got[u]) == [(n + 1, i, -s) for n, (s, i) in enumerate(order)]


def test_item_entries_travel_only_where_they_are_needed(spark):
    """What is sent does not exceed the products that exist, where blocks would send every entry to every block of users."""
    a, b, users, items = sparse_tables(spark)
    sent = blocks.needed_lists(users, items, 30).agg(F.sum(F.size("ids"))).first()[0]
    exist = int(((a > 0).sum(axis=0) * (b > 0).sum(axis=0)).sum())
    assert blocks.products(users, items) == exist
    assert 0 < sent <= exist < 30 * items.count()


def test_cells_of_the_grid_hold_a_bounded_number_of_rows(spark):
    """Item entries grow with the length of the lists and not only with the items."""
    user_blocks, item_blocks = blocks._grid(spark.range(1), 90_000, 120_000, 5_000_000, 60_000_000, 8192, 32768)
    assert 5_000_000 / user_blocks <= blocks._CELL_ROWS and 60_000_000 / item_blocks <= blocks._CELL_ROWS
