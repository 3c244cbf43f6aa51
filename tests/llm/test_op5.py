import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelorus.llm import op5_toxicity as op
from pelorus.llm.registry import op5_toxicity_scores


def test_held_out_by_crc32(spark):
    ids = spark.range(50).withColumn("h", op.held_out(F.col("id")))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in ids.collect())


def test_learns_words_and_edge_cases(spark):
    rng = random.Random(1)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        toxic = i % 6 == 0
        if toxic:
            text += rng.sample(["Vile", "nasty", "foul"], 2)
        rng.shuffle(text)
        rows.append((i, " ".join(text), 7))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (3, None), (12, 0)]
    docs = spark.createDataFrame(rows + [(900, None, 1), (901, "", 1), (None, "vile foul", 1), (902, "plain " * 50000, 1)], "doc_id long, text string, score int")
    model = op.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = op.judge(docs, model).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 404 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [i for i in range(400) if by_id[i].held_out]
    assert sum(by_id[i].predicted == int(i % 6 == 0) for i in held) / len(held) > 0.95
    assert by_id[None].predicted == 1 and by_id[900].score == by_id[901].score < 0.3
    clean = op.keep_clean(docs, model)
    assert clean.columns == docs.columns and clean.count() == sum(1 - r.predicted for r in got)


def test_without_positives_or_rows(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in op.judge(docs, op.train(docs, none)).collect()] == [0.0]
    some = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert op.judge(docs.limit(0), op.train(docs.limit(0), some)).count() == 0


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = op5_toxicity_scores(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    recall = n.get((1, 1), 0) / (n.get((1, 1), 0) + n.get((1, 0), 0))
    false = n.get((0, 1), 0) / (n.get((0, 1), 0) + n.get((0, 0), 0))
    assert recall > 0.85 and false < 0.03


def test_a_hot_id_takes_one_place_of_the_unlabelled_sample(spark, monkeypatch):
    ids = spark.range(400).filter(~op.held_out(F.col("id")))
    hot = ids.orderBy(F.xxhash64("id"), "id").first().id
    docs = ids.union(spark.createDataFrame([(hot,)] * 60, "id long")).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id").alias("text"))
    fitted, fit = [], op.nn_pu
    monkeypatch.setattr(op, "nn_pu", lambda positive, unlabelled, *rest: fitted.append(len(unlabelled)) or fit(positive, unlabelled, *rest))
    op.train(docs, ids.limit(5).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic")), max_unlabelled=50)
    assert fitted == [50]


@pytest.mark.parametrize("sf, least", [("0.01", 0.9), ("0.1", 0.96)])
def test_scores_rank_held_out_labels(spark, sf, least):
    folder = f"/root/testdata/sf{sf}"
    rows = op5_toxicity_scores(spark, folder).filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("score", "toxic").collect()
    toxic, clean = (np.array([r.score for r in rows if r.toxic == t]) for t in (1, 0))
    auc = ((toxic[:, None] > clean).sum() + (toxic[:, None] == clean).sum() / 2) / (len(toxic) * len(clean))
    assert auc >= least


def test_few_positives_give_more_than_one_score(spark):
    assert op5_toxicity_scores(spark, "/root/testdata/sf0.001").select("score").distinct().count() > 10


def test_the_fit_follows_the_risk():
    # The gradient that training descends is the slope of the non-negative risk: one small step along it lowers the risk.
    rng = np.random.default_rng(0)
    word = [np.unique(rng.integers(0, 40, 12)).astype("u4") for _ in range(300)]
    positive = [np.unique(np.append(w, [50, 51][: 1 + i % 2])).astype("u4") for i, w in enumerate(word[:60])]
    unlabelled = word[60:] + positive[:40]

    def risk(weights, bias, prior=0.15):
        z_p, z_u = (np.array([bias + weights[d].sum() for d in docs]) for docs in (positive, unlabelled))
        loss = lambda z: np.logaddexp(0, -z).mean()
        return prior * loss(z_p) + max(0.0, loss(-z_u) - prior * loss(-z_p))

    start = risk(np.zeros(64), math.log(0.15 / 0.85))
    fits = [op.nn_pu(positive, unlabelled, 0.15, 6, n, 0.0) for n in (1, 20, 300)]
    assert start > risk(*fits[1]) and fits[2][0][50] > 0 and risk(*fits[2]) < risk(*fits[0])
