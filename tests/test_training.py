import numpy as np
import pytest
from pyspark.sql import functions as F

from pelorus.models.base import TrainSet
from pelorus.models.factors import BPR, BiasedMF, FactorModel, _bpr_sums, _squared_sums
from pelorus.models.vectors import VectorRetriever
from pelorus.operators.negatives import chosen_unseen, negatives, sampled_negatives
from pelorus.ranker import features, rankers


@pytest.fixture(scope="module")
def tastes(spark):
    """Two groups of users, each with its own half of the items."""
    rng = np.random.default_rng(0)
    rows = [(u, int(i)) for u in range(60) for i in rng.choice(20, 9, replace=False) + 20 * (u % 2)]
    return TrainSet(spark.createDataFrame(rows, "user_id long, item_id long"))


def test_negatives_are_unseen_even_for_a_user_who_saw_nearly_all(spark, skewed):
    train = TrainSet(skewed[1])
    few = sampled_negatives(train.pairs, train.history, train.item_index, train.n_items, 0, attempts=1)
    assert few.count() < train.pairs.count()
    drawn = negatives(train, train.item_index, 0, attempts=1)
    assert drawn.count() == train.pairs.count()
    seen = train.history.withColumnRenamed("item_id", "negative")
    assert drawn.join(seen, ["user_id", "negative"], "left_semi").count() == 0
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, negatives(train, train.item_index, 0, attempts=1).collect()))


def auc(train, model):
    triples = negatives(train, train.item_index, 99)
    up = model.score_pairs(triples.select("user_id", "item_id", "negative")).withColumnRenamed("score", "up")
    both = model.score_pairs(up.select("user_id", F.col("negative").alias("item_id"), "up"))
    return both.agg(F.avg((F.col("up") > F.col("score")).cast("double"))).first()[0]


@pytest.mark.parametrize("kind", [BPR, BiasedMF])
def test_training_separates_tastes_and_repeats(tastes, kind):
    model = kind(k_factors=4, epochs=6, learning_rate=0.2).fit(tastes)
    assert auc(tastes, model) > 0.75
    if kind is BPR:
        again = BPR(k_factors=4, epochs=6, learning_rate=0.2).fit(tastes)
        a, b = ({r["id"]: r["factors"] for r in m.items.collect()} for m in (model, again))
        assert all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_training_with_a_user_larger_than_a_block(spark, skewed):
    model = BPR(k_factors=4, epochs=2, rows_per_block=40).fit(TrainSet(skewed[1]))
    values = np.array([r["factors"] for r in model.items.collect()])
    assert np.isfinite(values).all()
    assert model.users.count() == 25


def test_sums_of_one_row_are_the_serial_updates():
    rng = np.random.default_rng(1)
    P, Q, bu, bi = rng.normal(size=(2, 3)), rng.normal(size=(3, 3)), rng.normal(size=2), rng.normal(size=3)
    reg, one = 0.01, np.ones(1)
    p, qi, qj = P[1], Q[0], Q[2]
    g = 1 - 1 / (1 + np.exp(-(bi[0] - bi[2] + p @ (qi - qj))))
    users, items = _bpr_sums((np.array([1]), np.array([0]), np.array([2]), one), P, Q, bu, bi, reg)
    assert users[0][1] == pytest.approx(g * (qi - qj) - reg * p) and users[1][1] == 0
    assert items[0][0] == pytest.approx(g * p - reg * qi) and items[0][2] == pytest.approx(-g * p - reg * qj)
    assert items[1][0] == pytest.approx(g - reg * bi[0]) and items[1][2] == pytest.approx(-g - reg * bi[2])
    users, items = _squared_sums((np.array([1]), np.array([0]), one, one), P, Q, bu, bi, reg)
    e = 1 - (bu[1] + bi[0] + p @ qi)
    assert users[0][1] == pytest.approx(e * qi - reg * p) and users[1][1] == pytest.approx(e - reg * bu[1])
    assert items[0][0] == pytest.approx(e * p - reg * qi) and items[1][0] == pytest.approx(e - reg * bi[0])


@pytest.mark.parametrize("kind", [BPR, BiasedMF])
def test_factors_do_not_depend_on_blocks(spark, skewed, kind):
    got = []
    for rows in (250_000, 60, 10):
        model = kind(k_factors=4, epochs=1, rows_per_block=rows).fit(TrainSet(skewed[1]))
        got.append({r["id"]: [*r["factors"], r["bias"]] for r in model.items.collect()})
    for other in got[1:]:
        assert all(other[i] == pytest.approx(got[0][i], abs=1e-9) for i in got[0])


def test_many_repeats_do_not_overshoot(spark):
    rows = [(u, i) for u in range(20) for i in (u % 2, 2 + u % 3)] * 400
    model = BPR(k_factors=4, epochs=3).fit(TrainSet(spark.createDataFrame(rows, "user_id long, item_id long")))
    values = np.array([[*r["factors"], r["bias"]] for r in model.items.collect()])
    assert np.isfinite(values).all() and np.abs(values).max() < 20


def test_every_unseen_item_can_be_a_negative(spark):
    index = spark.createDataFrame([(i, 1000 + i) for i in range(200)], "idx long, item_id long")
    history = spark.createDataFrame([(1, 1000 + i) for i in range(0, 200, 2)], "user_id long, item_id long")
    pairs = spark.createDataFrame([(1, 5000 + i, 1) for i in range(3000)], "user_id long, item_id long, m long")
    drawn = [r.negative for r in chosen_unseen(pairs, history, index, 200, 3).collect()]
    assert len(drawn) == 3000 and set(drawn) == {1000 + i for i in range(1, 200, 2)}


def test_retrieval_equals_factor_lists_without_normalisation(spark, tastes):
    model = BPR(k_factors=4, epochs=1).fit(tastes)
    users = tastes.user_sizes.select("user_id")
    a = {(r["user_id"], r["rank"]): r["item_id"] for r in model.recommend_all(users, 5).collect()}
    b = {(r["user_id"], r["rank"]): r["item_id"] for r in VectorRetriever().fit(model).recommend_all(users, 5).collect()}
    assert a == b
    with pytest.raises(ValueError, match="not fitted"):
        VectorRetriever().fit(FactorModel())
    unknown = spark.createDataFrame([(1, 1), (1, 999), (999, 1)], "user_id long, item_id long")
    scores = {(r["user_id"], r["item_id"]): r["score"] for r in model.score_pairs(unknown).collect()}
    assert scores[1, 999] == scores[999, 1] == 0.0 != scores[1, 1]
    cold = model.recommend_all(spark.createDataFrame([(999,)], "user_id long"), 3).collect()
    assert len(cold) == 3 and all(r["score"] is None for r in cold)


@pytest.fixture(scope="module")
def table(spark):
    """Twelve candidates per user; the true one tends to have the largest first feature."""
    rng = np.random.default_rng(4)
    rows = []
    for user in range(40):
        true = int(rng.integers(12))
        rows += [(user, i, int(i == true), float(rng.normal() + 2.5 * (i == true)), float(rng.normal())) for i in range(12)]
    return spark.createDataFrame(rows, "user_id long, item_id long, label int, good double, noise double")


@pytest.mark.parametrize("make", [rankers.PointwiseRanker, lambda: rankers.PairwiseRanker(n_estimators=4, max_depth=3)])
def test_rankers_learn_the_useful_feature(table, make):
    fit_rows, rank_rows = features.split_users(table)
    assert fit_rows.join(rank_rows, "user_id", "left_semi").count() == 0
    lists = make().fit(fit_rows, ["good", "noise"]).rerank(rank_rows, 3)
    hits = lists.join(rank_rows.filter("label = 1"), ["user_id", "item_id"]).count()
    assert hits / rank_rows.select("user_id").distinct().count() > 0.6


def test_pointwise_matches_the_penalised_optimum(table):
    """The gradient of sum(w · loss) + |coef|²/2 vanishes at the fitted coefficients."""
    model = rankers.PointwiseRanker().fit(table, ["good", "noise"]).model
    data = np.array(table.select("good", "noise", "label").collect(), float)
    x, y = data[:, :2], data[:, 2]
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    gradient = x.T @ (w * (p - y)) + model.coefficients.toArray()
    assert gradient == pytest.approx(np.zeros(2), abs=1e-2) and (w * (p - y)).sum() == pytest.approx(0, abs=1e-2)


def test_lambda_gradients(spark):
    rows = [(1, 1, 1, 0.0), (1, 2, 0, 1.0), (1, 3, 0, -1.0), (2, 1, 0, 0.5)]
    scored = rankers.ideal_gain(spark.createDataFrame(rows, "user_id long, item_id long, label int, margin double"))
    got = {(r["user_id"], r["item_id"]): (r["grad"], r["hess"]) for r in rankers.lambda_gradients(scored).collect()}
    discount = {1: 1 / np.log2(3), 2: 1.0, 3: 0.5}
    margin = {1: 0.0, 2: 1.0, 3: -1.0}
    parts = {}
    for other in (2, 3):
        rho = 1 / (1 + np.exp(margin[1] - margin[other]))
        parts[other] = (rho * abs(discount[1] - discount[other]), rho * (1 - rho) * abs(discount[1] - discount[other]))
    assert got[1, 2] == pytest.approx((-parts[2][0], parts[2][1])) and got[1, 3] == pytest.approx((-parts[3][0], parts[3][1]))
    assert got[1, 1] == pytest.approx((parts[2][0] + parts[3][0], parts[2][1] + parts[3][1]))
    assert got[2, 1] == (0.0, 0.0)


def test_pairwise_grows_every_tree_and_predicts_their_sum(spark, table):
    ranker = rankers.PairwiseRanker(n_estimators=5, max_depth=3).fit(table, ["good", "noise"])
    assert len(ranker.trees) == 5

    def walk(node, leaves, x, at=1):
        if node is None:
            return leaves.get(at, 0.0)
        right = x[node[0]] > node[1]
        return walk(node[3 if right else 2], leaves, x, 2 * at + right)

    for row in ranker.predict(table).collect():
        want = sum(walk(root, leaves, (row["good"], row["noise"])) for root, leaves in ranker.trees)
        assert row["ltr_score"] == pytest.approx(want, abs=1e-12)
    # Each round starts from the margins of the trees before it: the second tree's leaves are Newton steps from there.
    first, second = ranker.trees[:2]
    rows = rankers.ideal_gain(table).toPandas()
    rows["margin"] = [walk(*first, (g, n)) for g, n in zip(rows.good, rows.noise, strict=True)]
    grads = rankers.lambda_gradients(spark.createDataFrame(rows)).toPandas()
    leaf = [walk(second[0], {n: n for n in range(16)}, (g, n)) for g, n in zip(grads.good, grads.noise, strict=True)]
    sums = grads.groupby(leaf)[["grad", "hess"]].sum()
    assert {n: pytest.approx(0.1 * s.grad / (s.hess + 1)) for n, s in sums.iterrows()} == second[1]


def test_registered_pairwise_ranker_has_the_operators_hundred_trees(monkeypatch):
    from pelorus.plans import catalog

    monkeypatch.setattr(catalog, "_ranked_by", lambda w, ranker: ranker)
    monkeypatch.setattr(catalog, "workbench", lambda spark, sf_dir: None)
    assert catalog.all_queries()["ltr_pairwise"](None, "").n_estimators == 100
