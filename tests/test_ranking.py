from collections import Counter

import pytest
from pyspark.sql import functions as F

from pelorus.models.base import TrainSet
from pelorus.models.hybrid import merge_pools
from pelorus.models.popularity import Popularity, Random, Trending
from pelorus.operators.order import exact_quantiles, global_index
from pelorus.operators.ranking import free_positions
from pelorus.ranker.features import inject_truth


def lists(df):
    out = {}
    for row in df.orderBy("user_id", "rank").collect():
        out.setdefault(row["user_id"], []).append((row["rank"], row["item_id"]))
    for ranked in out.values():
        assert [r for r, _ in ranked] == list(range(1, len(ranked) + 1))
    return {u: [i for _, i in ranked] for u, ranked in out.items()}


def brute_popularity(rows, users, k):
    counts = Counter(item for _, item, _ in rows)
    order = sorted(counts, key=lambda i: (-counts[i], i))
    seen = {}
    for user, item, _ in rows:
        seen.setdefault(user, set()).add(item)
    return {u: [i for i in order if i not in seen.get(u, set())][:k] for u in users}


@pytest.mark.parametrize("limit", [50_000, 3])
def test_popularity_with_array_and_distributed_path(spark, skewed, limit):
    """A small limit sends every history beyond three items through the distributed path; lists must not change."""
    rows, frame = skewed
    users = spark.range(0, 27).select(F.col("id").alias("user_id"))
    got = lists(Popularity().fit(TrainSet(frame, seen_limit=limit)).recommend_all(users, 7))
    want = {u: r for u, r in brute_popularity(rows, range(27), 7).items() if r}
    assert got == want


@pytest.mark.parametrize("limit", [50_000, 2])
def test_free_positions(spark, limit):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    taken = {1: {1, 2, 3, 5}, 2: set(range(1, 9000)), 3: set()}
    seen = spark.createDataFrame([(u, p) for u, ps in taken.items() for p in ps], "user_id long, pos long")
    got = free_positions(users, seen, 3, 9001, 8999, seen, limit).orderBy("user_id", "rank").collect()
    assert [(r["user_id"], r["rank"], r["pos"]) for r in got] == [
        (1, 1, 4), (1, 2, 6), (1, 3, 7), (2, 1, 9000), (2, 2, 9001), (3, 1, 1), (3, 2, 2), (3, 3, 3),
    ]


def test_random_is_unseen_distinct_and_seeded(spark, skewed):
    rows, frame = skewed
    train = TrainSet(frame)
    users = frame.select("user_id").distinct()
    seen = {}
    for user, item, _ in rows:
        seen.setdefault(user, set()).add(item)
    first = lists(Random(1).fit(train).recommend_all(users, 6))
    for user, items in first.items():
        assert len(set(items)) == len(items) == min(6, train.n_items - len(seen[user]))
        assert not set(items) & seen[user]
    assert first == lists(Random(1).fit(train).recommend_all(users, 6))
    assert first == lists(Random(1).fit(TrainSet(frame, seen_limit=2)).recommend_all(users, 6))
    assert first != lists(Random(2).fit(train).recommend_all(users, 6))


def test_trending_window_is_inclusive_and_filled(spark):
    rows = [(1, 1, 0), (2, 1, 0), (3, 2, 10), (4, 3, 20), (5, 3, 20), (6, 4, 9)]
    frame = spark.createDataFrame(rows, "user_id long, item_id long, day int")
    frame = frame.selectExpr("user_id", "item_id", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, day) AS date_time")
    users = spark.createDataFrame([(9,)], "user_id long")
    assert lists(Trending(10).fit(TrainSet(frame)).recommend_all(users, 4)) == {9: [3, 2, 1, 4]}


def test_fill_keeps_lists_and_adds_popular(spark, skewed):
    rows, frame = skewed
    train = TrainSet(frame)
    users = spark.createDataFrame([(1,), (2,), (99,)], "user_id long")
    given = spark.createDataFrame([(1, 58, 1, 2.0), (1, 59, 2, 1.0)], "user_id long, item_id long, rank int, score double")
    got = lists(train.fill_with_popularity(given, users, 5))
    popular = brute_popularity(rows, [1, 2, 99], 10)
    assert got[1] == [58, 59, *[i for i in popular[1] if i not in (58, 59)][:3]]
    assert got[2] == popular[2][:5]
    assert got[99] == popular[99][:5]


def test_global_index_and_quantiles(spark):
    values = [3.0] * 300 + [float(x % 97) for x in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    indexed = global_index(df, F.asc("v"), F.asc("id")).orderBy("idx").collect()
    assert [r["idx"] for r in indexed] == list(range(800))
    assert [(r["v"], r["id"]) for r in indexed] == sorted((v, i) for i, v in enumerate(values))
    import numpy as np

    probs = [0.0, 0.25, 0.5, 0.951, 1.0]
    got = {r["p"]: r["value"] for r in exact_quantiles(df, "v", probs).collect()}
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in probs})


def test_large_pools_are_merged_in_more_tasks(spark):
    """The memory of a task does not grow with users times list length; the merged rows are the same."""
    first = spark.createDataFrame([(u, i, i + 1) for u in range(40) for i in range(5)], "user_id long, item_id long, rank int")
    second = first.withColumn("item_id", F.col("item_id") + 2)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = merge_pools(first, second, rows=(usual + 3) << 19)
    assert many.rdd.getNumPartitions() == usual + 3
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, merge_pools(first, second).collect()))


def test_injected_truth_does_not_broadcast_candidates(spark):
    """Only the candidates that are true, at most as many as truths, are met by the truths."""
    pool = spark.createDataFrame([(u, i) for u in range(30) for i in range(20)], "user_id long, item_id long")
    truth = spark.createDataFrame([(0, 3), (1, 77), (1, 77), (40, 1), (2, None)], "user_id long, item_id long")
    rows = inject_truth(pool, truth)
    want = [(u, i) for u in range(30) for i in range(20)] + [(1, 77), (1, 77), (40, 1), (2, None)]
    assert Counter(map(tuple, rows.collect())) == Counter(want)
    anti = rows._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti", 1)[1]
    assert "LeftSemi" in anti
