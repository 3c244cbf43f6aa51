import numpy as np
import pytest
from pyspark.sql import functions as F

from pelorus.models.ann import ApproximateRetriever, list_recall
from pelorus.models.base import TrainSet
from pelorus.models.factors import FactorModel, initial_factors
from pelorus.models.vectors import VectorRetriever
from pelorus.operators.cells import CellPlan, cell_candidates, fit_centroids, nearest, probed_top_k


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(0)
    rows = [(u, int(i)) for u in range(80) for i in rng.choice(600, 12, replace=False)] + [(0, i) for i in range(200)]
    return TrainSet(spark.createDataFrame(rows + [(100, i) for i in range(600)], "user_id long, item_id long"))


def clustered(spark, n, seed, groups=12, width=6):
    """Vectors around a few directions; a third of them are equal."""
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(groups, width)) * 2
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in (centers[0] if i % 3 == 0 else centers[i % groups] + rng.normal(size=width) / 3)], float(rng.normal() / 4)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, factors array<double>, bias double")


@pytest.mark.parametrize("normalize", [False, True])
def test_recall_against_the_exact_lists(spark, train, normalize):
    model = FactorModel().with_factors(train, clustered(spark, 120, 1), clustered(spark, 600, 2))
    users = train.user_sizes.select("user_id")
    exact = VectorRetriever(normalize=normalize, fallback_to_popularity=False).fit(model).recommend_all(users, 300)
    index = ApproximateRetriever(normalize=normalize, fallback_to_popularity=False, sample_items=200).fit(model)
    assert index.indexed.count() == 600 and index.counts.sum() == 600
    found = index.recommend_all(users, 300)
    both = list_recall(found, exact).agg(F.sum("hits"), F.sum("n")).first()
    assert both[0] / both[1] >= 0.9
    seen = train.history.join(found, ["user_id", "item_id"], "left_semi")
    assert seen.count() == 0
    assert index.n_probe(10) < len(index.centers)


def test_all_cells_give_the_exact_lists(spark, train):
    model = FactorModel().with_factors(train, clustered(spark, 120, 1), clustered(spark, 600, 2))
    users = train.user_sizes.select("user_id")
    exact = VectorRetriever().fit(model)
    index = ApproximateRetriever().fit(model)
    want = sorted(tuple(r) for r in exact.recommend_all(users, 25).collect())
    for blocks in ({}, {"block_rows": 50, "user_block": 16}):
        got = probed_top_k(index.user_vectors, index.indexed, train.history, 25, train.n_users, index.centers, index.counts, len(index.centers), **blocks)
        assert sorted(tuple(r) for r in train.fill_with_popularity(got, users, 25).collect()) == want


def test_untrained_factors_reach_the_target(spark, train):
    ids = train.user_sizes.select(F.col("user_id").alias("id")), train.item_counts.select(F.col("item_id").alias("id"))
    model = FactorModel().with_factors(train, *(initial_factors(t, 8, s) for s, t in enumerate(ids)))
    users = train.user_sizes.select("user_id")
    exact = VectorRetriever(normalize=True, fallback_to_popularity=False).fit(model).recommend_all(users, 50)
    found = ApproximateRetriever(normalize=True, fallback_to_popularity=False).fit(model).recommend_all(users, 50)
    both = list_recall(found, exact).agg(F.sum("hits"), F.sum("n")).first()
    assert both[0] / both[1] >= 0.9


def test_blocks_are_bounded_and_hold_every_cell():
    counts = np.array([10, 0, 35, 5, 5, 5, 120, 1])
    plan = CellPlan(counts, 40)
    load = np.zeros(plan.blocks)
    for cell, n in enumerate(counts):
        for part in range(plan.parts[cell]):
            load[plan.first[cell] + part] += n / plan.parts[cell]
    assert load.max() <= 40 and load.sum() == counts.sum() and plan.parts[6] == 3


def test_candidates_with_ties_and_seen_items():
    items = np.array([[1.0, 0], [1, 0], [0, 1], [0, 1], [0, 2]])
    cell, ids = np.array([0, 0, 3, 3, 3]), np.array([9, 4, 7, 2, 5])
    u, i, s = cell_candidates(np.array([[1.0, 1], [0, 1]]), [np.array([0, 3]), np.array([3])], items, cell, np.array([0]), np.array([4]), ids, 2)
    assert sorted(zip(u.tolist(), ids[i].tolist(), s.tolist())) == [(0, 2, 1.0), (0, 4, 1.0), (1, 2, 1.0), (1, 5, 2.0)]
    assert len(fit_centroids(np.ones((5, 2)), 3)) == 1 and nearest(np.array([[0.0, 9]]), np.eye(2))[0] == 1


def test_empty_catalog_and_unknown_users(spark, train):
    none = spark.createDataFrame([], "id long, factors array<double>, bias double")
    empty = ApproximateRetriever(fallback_to_popularity=False).with_vectors(TrainSet(train.train.limit(0)), none, none)
    assert empty.recommend_all(spark.createDataFrame([(1,)], "user_id long"), 5).count() == 0
    model = FactorModel().with_factors(train, clustered(spark, 120, 1), clustered(spark, 600, 2))
    cold = ApproximateRetriever().fit(model).recommend_all(spark.createDataFrame([(999,)], "user_id long"), 5)
    assert [r["score"] for r in cold.collect()] == [None] * 5
