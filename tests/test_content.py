import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pelorus.functions import text
from pelorus.functions.numeric import portable_hash
from pelorus.models.base import TrainSet
from pelorus.models.content import ContentBased
from pelorus.models.hybrid import FixedLists, Hybrid


def test_one_decimal_is_correctly_rounded(spark):
    """Python rounds the exact binary value; the column expression must agree on every double."""
    rng = random.Random(0)
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 0.95, 1.95, 2.25, 2.75, -0.25, -1.95, 55.0, 899.95, 1e6 + 0.05]
    values += [round(rng.uniform(-1000, 1000), rng.choice([1, 2, 3, 9])) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", text.one_decimal(F.col("v")).alias("t"))
    for row in df.collect():
        assert float(row["t"]) == round(row["v"], 1), row


def test_documents(spark):
    items = spark.createDataFrame(
        [(1, "Don't  STOP!", 2.25, True), (2, None, None, None), (3, " --- ", 55.0, False), (4, "a", float("nan"), None)],
        "item_id long, name string, size double, ok boolean",
    )
    model = ContentBased()
    assert model.resolve_columns(items.schema) == (["name"], ["size", "ok"])
    docs = {r["item_id"]: r["document"] for r in model.documents(items).collect()}
    assert docs == {
        1: "name_don name_t name_stop size_2.2 ok_true", 2: "item_id_2", 3: "size_55.0 ok_false", 4: "name_a",
    }
    rates = {r["column"]: r["rate"] for r in model.missing_rates(items).collect()}
    assert rates == {"name": 0.25, "size": 0.25, "ok": 0.5}
    assert ContentBased(feature_cols=["size", "none"]).resolve_columns(items.schema) == (["size"], [])
    with pytest.raises(ValueError, match="feature columns"):
        ContentBased(text_cols=["absent"]).documents(items)


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    got = [r[0] for r in df.select(text.ngrams(F.col("w"), (1, 3))).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]
    assert [r[0] for r in df.select(text.ngrams(F.col("w"), (2, 2))).collect()] == [["a b", "b c"], [], []]


ITEMS = [(1, "red apple pie", 10), (2, "red apple cake", 20), (3, "green soup", 10), (4, "green apple soup", 30), (5, "odd", 99)]
LOG = [(1, 1), (1, 1), (1, 3), (2, 2), (3, 4), (4, 3)]


@pytest.fixture(scope="module")
def fitted(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, name string, size int")
    train = spark.createDataFrame(LOG, "user_id long, item_id long")
    return ContentBased(text_cols=["name"], metadata_cols=["size"], ngram_range=(1, 1)).fit(TrainSet(train), items)


def brute():
    docs = {i: [f"name_{w}" for w in name.split()] + [f"size_{size}"] for i, name, size in ITEMS}
    docs = {i: re.findall(r"\b\w\w+\b", " ".join(d)) for i, d in docs.items()}
    train_items = {i for _, i in LOG}
    df = Counter(t for i in train_items for t in set(docs[i]))
    idf = {t: math.log((1 + len(train_items)) / (1 + n)) + 1 for t, n in df.items()}
    vectors = {}
    for i, d in docs.items():
        x = {t: n * idf[t] for t, n in Counter(d).items() if t in idf}
        norm = math.sqrt(sum(v * v for v in x.values()))
        vectors[i] = {t: v / norm for t, v in x.items()} if norm else {}
    profiles = {}
    for user in {u for u, _ in LOG}:
        mine = [i for u, i in LOG if u == user]
        total = defaultdict(float)
        for i in mine:
            for t, v in vectors[i].items():
                total[t] += v / len(mine)
        profiles[user] = dict(total)
    return vectors, profiles


def test_vectors_profiles_and_lists(spark, fitted):
    vectors, profiles = brute()
    got = {(r["item_id"], r["term"]): r["w"] for r in fitted.postings.collect()}
    assert got == pytest.approx({(i, t): w for i, v in vectors.items() for t, w in v.items()})
    got = {(r["user_id"], r["term"]): r["w"] for r in fitted.profile_terms().collect()}
    assert got == pytest.approx({(u, t): w for u, v in profiles.items() for t, w in v.items()})
    users = spark.createDataFrame([(1,), (2,), (9,)], "user_id long")
    recs = defaultdict(list)
    for r in fitted.recommend_all(users, 3).orderBy("rank").collect():
        recs[r["user_id"]].append((r["item_id"], r["score"]))

    def dot(u, i):
        return sum(w * vectors[i].get(t, 0) for t, w in profiles[u].items())

    norm = math.sqrt(sum(w * w for w in profiles[1].values()))
    want = sorted(((-dot(1, i) / norm, i) for i in (2, 4, 5) if dot(1, i) > 0))
    assert [i for i, s in recs[1] if s is not None] == [i for _, i in want]
    assert [s for _, s in recs[1] if s is not None] == pytest.approx([-s for s, _ in want])
    assert [i for i, _ in recs[9]] == [1, 3, 2] and all(s is None for _, s in recs[9])
    pairs = spark.createDataFrame([(1, 4), (1, 5), (9, 1)], "user_id long, item_id long")
    scores = {(r["user_id"], r["item_id"]): r["score"] for r in fitted.score_pairs(pairs).collect()}
    assert scores == pytest.approx({(1, 4): dot(1, 4), (1, 5): 0.0, (9, 1): 0.0})
    reasons = {(r["user_id"], r["item_id"]): r["explanation"] for r in fitted.explain_pairs(pairs).collect()}
    assert reasons[1, 4].startswith("Recommended because it overlaps on: name: ")
    assert reasons[1, 5] == "Recommended due to overall profile match."
    assert reasons[9, 1] == "Recommended due to popularity fallback (cold user)."


def test_zero_weights_give_no_profile(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, name string, size int")
    train = spark.createDataFrame([(1, 1, "error"), (2, 2, "view"), (2, 77, "view")], "user_id long, item_id long, kind string")
    model = ContentBased(text_cols=["name"], event_col="kind", event_weight_map={"error": 0.0}).fit(TrainSet(train), items)
    assert [r[0] for r in model.profiles.select("user_id").distinct().collect()] == [2]


def test_hybrid_blends_reciprocal_ranks(spark):
    train = TrainSet(spark.createDataFrame([(1, 9)] * 6 + [(2, 9)], "user_id long, item_id long"))
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    a = spark.createDataFrame([(u, i, r) for u in (1, 2) for r, i in enumerate([11, 12, 9], 1)], "user_id long, item_id long, rank int")
    b = spark.createDataFrame([(u, i, r) for u in (1, 2) for r, i in enumerate([13, 12], 1)], "user_id long, item_id long, rank int")
    model = Hybrid(FixedLists(a), FixedLists(b), alpha=0.9, adaptive=True).fit(train)
    got = {(r["user_id"], r["item_id"]): (r["rank"], round(r["score"], 6)) for r in model.recommend_all(users, 3).collect()}
    assert got[1, 11] == (1, 0.9) and got[1, 12] == (2, 0.5) and got[1, 13] == (3, 0.1)
    assert got[2, 13] == (1, 0.7) and got[2, 12] == (2, 0.5) and got[2, 11] == (3, 0.3)
    assert (1, 9) not in got
    plain = Hybrid(FixedLists(a), FixedLists(b), alpha=1.0).fit(train).recommend_all(users, 2)
    assert [r["item_id"] for r in plain.filter("user_id = 1").orderBy("rank").collect()] == [11, 12]
    sweep = model.sweep(users, 1, (0.3, 0.9)).filter("user_id = 1").collect()
    assert {(r["alpha"], r["item_id"]) for r in sweep} == {(0.3, 13), (0.9, 11)}


def test_portable_hash_is_in_range(spark):
    ids = spark.createDataFrame([(x,) for x in (-7, 0, 17, 2**62, -(2**62))], "id long")
    assert all(0 <= r[0] < 2**31 for r in ids.select(portable_hash(F.col("id"), 42)).collect())
