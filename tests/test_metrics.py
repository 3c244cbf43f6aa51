import math

import numpy as np
import pytest

from pelorus.metrics import accuracy, candidates, fairness

RECS = [
    ("m", 1, 10, 1), ("m", 1, 20, 2), ("m", 1, 30, 3),
    ("m", 2, 10, 1), ("m", 2, 10, 2), ("m", 2, 40, 3),
    ("n", 3, 99, 1),
]
TRUTH = [(1, 20), (2, 50), (3, 30), (4, 10)]
COUNTS = [(10, 100), (20, 1), (30, 9)]


@pytest.fixture
def recs(spark):
    return spark.createDataFrame(RECS, "model string, user_id long, item_id long, rank int")


@pytest.fixture
def truth(spark):
    return spark.createDataFrame(TRUTH, "user_id long, item_id long")


@pytest.fixture
def counts(spark):
    return spark.createDataFrame(COUNTS, "item_id long, n_rows long")


def test_accuracy_counts_users_without_a_list(recs, truth):
    got = {r["model"]: (r["users"], r["recall"], r["ndcg"]) for r in accuracy.accuracy(recs, truth, ["m", "n"], 3).collect()}
    assert got["m"] == pytest.approx((4, 0.25, (1 / math.log2(3)) / 4))
    assert got["n"] == (4, 0.0, 0.0)
    cut = {r["model"]: r["recall"] for r in accuracy.accuracy(recs, truth, ["m", "n"], 1).collect()}
    assert cut["m"] == 0.0


def test_novelty(recs, truth, counts):
    got = {r["model"]: r["novelty"] for r in accuracy.novelty(recs, truth, counts, 3).collect()}
    bits = {i: -math.log2(n / 110) for i, n in COUNTS}
    unseen = -math.log2(1e-9 / 110)
    one = (bits[10] + bits[20] + bits[30]) / 3
    two = (2 * bits[10] + unseen) / 3
    assert got["m"] == pytest.approx((one + two) / 4)
    assert got["n"] == pytest.approx(unseen / 4)


def test_coverage_of_an_empty_catalog_is_zero(spark, recs, counts):
    got = {r["model"]: r["coverage"] for r in accuracy.coverage(recs, counts).collect()}
    assert got == pytest.approx({"m": 4 / 3, "n": 1 / 3})
    assert {r["coverage"] for r in accuracy.coverage(recs, counts.limit(0)).collect()} == {0.0}


def test_snips_pooled_differs_from_snips_by_user(recs, truth, counts):
    weights = {20: 1 / max(0.05, math.sqrt(1 / 100)), 50: 1 / 0.05, 30: 1 / math.sqrt(9 / 100), 10: 1.0}
    pooled = {r["model"]: r["snips"] for r in accuracy.snips_pooled(recs, truth, ["m"], counts, 3).collect()}
    assert pooled["m"] == pytest.approx(weights[20] / sum(weights.values()))
    by_user = {r["user_id"]: r["snips"] for r in accuracy.snips_by_user(recs, truth, ["m"], counts, 3).collect()}
    assert by_user == {1: 1.0, 2: 0.0, 3: 0.0, 4: 0.0}


def test_macro_table_and_slices(spark, recs, truth, counts):
    rows = {r["model"]: r for r in accuracy.macro_table(recs, truth, ["m", "n", "silent"], counts, 3, "m").collect()}
    assert rows["m"]["suspicious"] and not rows["n"]["suspicious"]
    assert rows["silent"]["novelty"] == 0.0 and rows["silent"]["users"] == 4
    sizes = spark.createDataFrame([(1, 3), (2, 4), (3, 11)], "user_id long, n_rows long")
    slices = {(r["model"], r["slice"]): (r["users"], r["recall"]) for r in accuracy.activity_slices(recs, truth, ["m"], sizes, 3).collect()}
    assert slices["m", "Sparse users (<=3)"] == (2, 0.5)
    assert slices["m", "Medium users (4-10)"] == (1, 0.0) and slices["m", "Heavy users (>10)"] == (1, 0.0)
    cold = accuracy.cold_item_slice(recs, truth, ["m"], counts, 3).collect()
    assert [(r["users"], r["recall"]) for r in cold] == [(1, 0.0)]


def test_candidate_metrics(recs, truth, counts):
    rows = {(r["model"], r["candidate_budget"]): r for r in candidates.budget_sweep(recs, truth, ["m"], counts, (2, 3)).collect()}
    assert rows["m", 3]["avg_candidate_set_size"] == pytest.approx(6 / 4)
    assert rows["m", 3]["mean_duplicate_rate"] == pytest.approx((1 / 3) / 4)
    assert rows["m", 2]["mean_duplicate_rate"] == pytest.approx((1 / 2) / 4)
    assert rows["m", 2]["candidate_coverage"] == pytest.approx(2 / 3)
    assert rows["m", 2]["candidate_recall"] == 0.25
    empty = candidates.budget_sweep(recs, truth, ["m"], counts.limit(0), (2,)).first()
    assert empty["candidate_coverage"] == 0.0
    assert {r["user_id"]: r["hit"] for r in candidates.candidate_hits(recs, truth, ["m"], 3).collect()} == {1: 1, 2: 0, 3: 0, 4: 0}
    assert candidates.summarize(recs, truth, ["m"], counts, 3).columns[1] == "candidate_recall_at_3"


def test_sweep_deals_lists_once(spark, recs, truth, counts):
    """Lists are neither joined nor shuffled again for truths too many to broadcast; a true item named twice does not lengthen a list."""
    twice = truth.unionByName(truth)
    rows = {(r["model"], r["candidate_budget"]): r for r in candidates.budget_sweep(recs, twice, ["m"], counts, (2, 3)).collect()}
    assert rows["m", 3]["avg_candidate_set_size"] == pytest.approx(6 / 4)
    assert rows["m", 2]["candidate_recall"] == 0.25 and rows["m", 3]["candidate_recall"] == 0.25
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        plan = candidates.budget_sweep(recs, truth, ["m"], counts, (2, 3))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert not [line for line in plan.splitlines() if "Join" in line and "user_id" in line]


@pytest.mark.parametrize(("exposure", "want"), [([0, 0, 0, 0, 1], 0.8), ([2, 2, 2], 0.0), ([0, 1, 1, 3, 7, 7], None)])
def test_gini(spark, exposure, want):
    shown = [("m", 100 * i + c, i, 1) for i, n in enumerate(exposure) for c in range(n)]
    recs = spark.createDataFrame(shown, "model string, user_id long, item_id long, rank int")
    catalog = spark.range(len(exposure)).selectExpr("id AS item_id")
    x = np.sort(np.array(exposure, float))
    n = len(x)
    direct = float(np.sum((2 * np.arange(1, n + 1) - n - 1) * x) / (n * x.sum()))
    got = fairness.gini(recs, catalog).first()["gini"]
    assert got == pytest.approx(direct)
    assert want is None or got == pytest.approx(want)


def test_diversity(spark):
    rng = np.random.default_rng(3)
    v = rng.random((6, 4)) * (rng.random((6, 4)) < 0.7)
    v[5] = 0
    v[:5] /= np.linalg.norm(v[:5], axis=1, keepdims=True)
    postings = spark.createDataFrame(
        [(i, str(t), float(v[i, t])) for i in range(6) for t in range(4) if v[i, t]], "item_id long, term string, w double"
    )
    lists = {1: [0, 1, 2], 2: [3, 4, 5, 88], 3: [1], 4: [77, 2]}
    recs = spark.createDataFrame(
        [("m", u, i, r + 1) for u, items in lists.items() for r, i in enumerate(items)], "model string, user_id long, item_id long, rank int"
    )
    row = fairness.intra_list_diversity(recs, postings, spark.range(6).selectExpr("id AS item_id")).first()

    def direct(items):
        pairs = [(a, b) for n, a in enumerate(items) for b in items[n + 1 :]]
        return np.mean([1 - v[a] @ v[b] for a, b in pairs])

    # An item's entries are not shuffled one by one: a list row travels whole.
    plan = fairness.intra_list_diversity(recs, postings, spark.range(6).selectExpr("id AS item_id"))._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "term" in line]
    assert row["lists"] == 2
    assert row["ild"] == pytest.approx(np.mean([direct([0, 1, 2]), direct([3, 4, 5])]))
