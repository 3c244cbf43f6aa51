"""The registered queries: one per operator, each over the whole tables of a test-data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..metrics import accuracy, candidates, fairness
from ..models.ann import ApproximateRetriever, list_recall
from ..models.base import TrainSet
from ..models.content import ContentBased
from ..models.factors import BPR, BiasedMF, sgd_round
from ..models.graph import PersonalizedPageRank
from ..models.hybrid import Hybrid
from ..models.knn import ItemKNN
from ..models.markov import Markov
from ..models.popularity import Popularity, Random, Trending
from ..models.vectors import VectorRetriever, nearest_items
from ..operators import explore, negatives, prepare, split
from ..ranker import features, rankers
from ..session import durable, shared_folder
from ..sources import append_runs, read_interactions_csv, read_items_csv, read_parquet, views
from .runs import run_rows
from .workbench import DIMENSIONS, EVENT_WEIGHTS, K, POOL, Workbench, workbench

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Callable[[Workbench], DataFrame]] = {}


def _query(build: Callable[[Workbench], DataFrame]) -> Callable[[Workbench], DataFrame]:
    _registry[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    def bound(build) -> Query:
        return lambda spark, sf_dir: build(workbench(spark, sf_dir))

    return {name: bound(build) for name, build in _registry.items()}


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(F.col(c), digits))
    return df


def _list(df: DataFrame) -> DataFrame:
    return df.select("user_id", "item_id", F.col("rank").cast("int").alias("rank"), F.round("score", 6).alias("score"))


def _plain(df: DataFrame) -> DataFrame:
    return df.select("user_id", "item_id", F.col("rank").cast("int").alias("rank"))


# --- data -----------------------------------------------------------------------------------------------------------


@_query
def interactions_view(w: Workbench) -> DataFrame:
    return w.interactions


@_query
def csv_interactions(w: Workbench) -> DataFrame:
    """The log written as CSV and read back with the reader, dates parsed from text."""
    path = f"{shared_folder(w.spark)}/interactions-{uuid.uuid4().hex}"
    w.interactions.select(
        "user_id",
        F.col("item_id").alias("recipe_id"),
        F.date_format("date_time", "yyyy-MM-dd").alias("date"),
        "rating",
    ).write.option("header", True).csv(path)
    read = read_interactions_csv(w.spark, path)
    return read.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


@_query
def csv_items(w: Workbench) -> DataFrame:
    """Documents as item metadata with free text, through CSV with quotes and line breaks."""
    path = f"{shared_folder(w.spark)}/items-{uuid.uuid4().hex}"
    docs = read_parquet(w.spark, w.sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("name"), F.col("n_chars").cast("double").alias("minutes"),
        F.concat(F.lit('"'), F.col("lang"), F.lit('",\n'), F.col("text")).alias("description"),
    )
    writer = docs.write.option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_items_csv(w.spark, path).select("item_id", "name", "minutes", "description")


@_query
def positive_filter(w: Workbench) -> DataFrame:
    return prepare.positives(w.interactions)


@_query
def min2_users(w: Workbench) -> DataFrame:
    return prepare.active_users(prepare.positives(w.interactions))


@_query
def join_items(w: Workbench) -> DataFrame:
    return prepare.modelling_frame(w.interactions, w.items)


@_query
def loo_train(w: Workbench) -> DataFrame:
    return split.leave_last_out(w.frame)[0]


@_query
def loo_test(w: Workbench) -> DataFrame:
    return split.leave_last_out(w.frame)[1]


@_query
def loo_tied_users(w: Workbench) -> DataFrame:
    return split.tied_last_users(w.frame)


@_query
def loo_untied_train(w: Workbench) -> DataFrame:
    return split.leave_last_out(w.frame, drop_tied_last=False)[0]


@_query
def loo_untied_test(w: Workbench) -> DataFrame:
    return split.leave_last_out(w.frame, drop_tied_last=False)[1]


@_query
def topn_items(w: Workbench) -> DataFrame:
    return prepare.top_items(w.train, 1000)


@_query
def top_item_rows(w: Workbench) -> DataFrame:
    return prepare.restrict_to_top_items(w.train, 1000).select("user_id", "item_id", "date_time", "rating")


@_query
def coerce_dates(w: Workbench) -> DataFrame:
    """Order dates as text, unreadable for pending orders, parsed with null for the unreadable ones."""
    orders = read_parquet(w.spark, w.sf_dir, "orders")
    as_text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("pending "), F.col("o_orderkey").cast("string")))
    as_text = as_text.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    parsed = prepare.coerce_timestamp(orders.select("o_orderkey", as_text.alias("date_time")), "date_time")
    return parsed.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


@_query
def item_names(w: Workbench) -> DataFrame:
    """One name per item, the names of economy parts taken as missing."""
    named = w.items.withColumn("name", F.when(F.col("ingredients") != "ECONOMY", F.col("name")))
    return prepare.with_item_names(named)


@_query
def first_row_per_item(w: Workbench) -> DataFrame:
    return prepare.first_per_key(w.interactions, "item_id", ["date_time", "user_id"])


@_query
def leakage_check(w: Workbench) -> DataFrame:
    return split.leakage_violations(w.train, w.test)


# --- exploration ----------------------------------------------------------------------------------------------------


@_query
def basic_stats(w: Workbench) -> DataFrame:
    return _rounded(explore.basic_stats(w.interactions), "sparsity")


@_query
def rating_dist(w: Workbench) -> DataFrame:
    return explore.value_counts(w.interactions, "rating").orderBy("rating")


@_query
def popularity_counts(w: Workbench) -> DataFrame:
    return explore.value_counts(w.train, "item_id").orderBy(F.desc("n"), "item_id")


@_query
def cold_counts(w: Workbench) -> DataFrame:
    return _rounded(explore.activity_counts(w.interactions), "single_share", "several_share")


@_query
def user_quantiles(w: Workbench) -> DataFrame:
    return _rounded(explore.activity_quantiles(w.interactions, "user_id"), "value")


@_query
def item_quantiles(w: Workbench) -> DataFrame:
    return _rounded(explore.activity_quantiles(w.interactions, "item_id"), "value")


@_query
def missing_counts(w: Workbench) -> DataFrame:
    """Missing values of documents with their labels attached where there are any."""
    docs = read_parquet(w.spark, w.sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read_parquet(w.spark, w.sf_dir, "labels")
    return _rounded(explore.missing_counts(docs.join(labels, "doc_id", "left")), "rate")


@_query
def missing_rates(w: Workbench) -> DataFrame:
    """Missing rate of each feature column over unique items, large sizes taken as missing."""
    items = w.items.withColumn("size", F.when(F.col("size") <= 40, F.col("size")))
    return _rounded(w.content().missing_rates(items), "rate").select("column", "rate")


@_query
def describe_items(w: Workbench) -> DataFrame:
    return _rounded(explore.describe(w.items, ["size", "price"]), "mean", "std", "q25", "q50", "q75")


@_query
def latency_summary(w: Workbench) -> DataFrame:
    """Mean, median and 95th percentile of a measured column."""
    return _rounded(explore.distribution_summary(read_parquet(w.spark, w.sf_dir, "events"), "value"), "mean", "median", "p95")


@_query
def hist_clip(w: Workbench) -> DataFrame:
    return explore.histogram(w.items, "size", 50, upper=30)


@_query
def hist_activity(w: Workbench) -> DataFrame:
    return explore.histogram(explore.value_counts(w.interactions, "user_id"), "n", 40)


@_query
def rule_summary(w: Workbench) -> DataFrame:
    return explore.rule_summary(w.interactions)


@_query
def join_coverage(w: Workbench) -> DataFrame:
    """All order lines against the whole item table."""
    lines = read_parquet(w.spark, w.sf_dir, "lineitem")
    return explore.join_coverage(lines.select(F.col("l_partkey").alias("item_id")), w.items)


@_query
def dup_counts(w: Workbench) -> DataFrame:
    return explore.duplicate_counts(w.interactions)


@_query
def dup_rows(w: Workbench) -> DataFrame:
    return explore.duplicate_rows(w.interactions).select("user_id", "item_id", "date_time", "rating")


@_query
def user_history(w: Workbench) -> DataFrame:
    return w.train_set.history


@_query
def cold_items(w: Workbench) -> DataFrame:
    return explore.cold_items(w.cold_train, w.test)


@_query
def warm_cold_users(w: Workbench) -> DataFrame:
    return explore.test_user_warmth(w.cold_set.item_counts, w.test)


@_query
def sparse_users(w: Workbench) -> DataFrame:
    return explore.sparse_users(w.train)


@_query
def activity_bucket(w: Workbench) -> DataFrame:
    sized = w.users.join(w.train_set.user_sizes, "user_id", "left")
    return sized.select("user_id", accuracy.activity_bucket(F.col("n_rows")).alias("slice"))


@_query
def user_sample(w: Workbench) -> DataFrame:
    return explore.sample_rows(w.users, 500, "user_id")


@_query
def first_users(w: Workbench) -> DataFrame:
    return explore.first_rows(w.users, 500, "user_id")


@_query
def heavy_user_sample(w: Workbench) -> DataFrame:
    heavy = w.train_set.user_sizes.filter(F.col("n_rows") > 5).select("user_id", "n_rows")
    return explore.sample_rows(heavy, 1, "user_id")


@_query
def last_by_user(w: Workbench) -> DataFrame:
    """Last time per user, the rows at it, and the user's share of them joined back to every row."""
    last = w.frame.groupBy("user_id", "date_time").agg(F.count(F.lit(1)).alias("n"))
    last = last.groupBy("user_id").agg(F.max(F.struct("date_time", "n")).alias("l"))
    joined = w.frame.join(last, "user_id")
    return joined.select(
        "user_id", "item_id", "date_time", F.col("l.date_time").alias("last_time"), F.col("l.n").alias("n_at_last")
    )


# --- recommenders ---------------------------------------------------------------------------------------------------


@_query
def popularity_topk(w: Workbench) -> DataFrame:
    return _list(Popularity().fit(w.train_set).recommend_all(w.users, K))


@_query
def random_topk(w: Workbench) -> DataFrame:
    return _plain(Random(42).fit(w.train_set).recommend_all(w.users, K))


@_query
def trending_topk(w: Workbench) -> DataFrame:
    return _list(Trending(180).fit(w.train_set).recommend_all(w.users, K))


@_query
def trending_events(w: Workbench) -> DataFrame:
    users = w.events.select("user_id").distinct()
    return _list(Trending(7).fit(w.event_set).recommend_all(users, K))


@_query
def popularity_fill(w: Workbench) -> DataFrame:
    """Short lists (the user's first unseen same-day trend) completed with popular items."""
    short = Trending(30).fit(w.train_set).recommend_all(w.users, 5)
    return _plain(w.train_set.fill_with_popularity(short, w.users, K))


@_query
def cold_user_fallback(w: Workbench) -> DataFrame:
    """Every customer, most of whom no model knows here, ranked by a Markov model fitted on one brand's rows."""
    held = w.items.filter(F.col("tags") == "Brand#7").select("item_id")
    train = TrainSet(w.train.join(held, "item_id", "left_semi"))
    users = read_parquet(w.spark, w.sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return _plain(Markov().fit(train).recommend_all(users, 5))


@_query
def markov_transitions(w: Workbench) -> DataFrame:
    ranked = Markov().fit(w.train_set).transitions(K)
    return ranked.select("item_i", "item_j", "n", F.col("rank").cast("int").alias("rank"))


@_query
def markov_topk(w: Workbench) -> DataFrame:
    return _list(Markov().fit(w.train_set).recommend_all(w.users, K))


@_query
def knn_sim(w: Workbench) -> DataFrame:
    sim = ItemKNN().similarities(w.train_set)
    return _rounded(sim.select("item_i", "item_j", "sim", F.col("rank").cast("int").alias("rank")), "sim")


@_query
def knn_topk(w: Workbench) -> DataFrame:
    return _list(ItemKNN().fit(w.train_set).recommend_all(w.users, K))


@_query
def knn_explain(w: Workbench) -> DataFrame:
    explained = ItemKNN().fit(w.train_set).explain_all(w.users, K)
    return explained.withColumn("rank", F.col("rank").cast("int"))


@_query
def ppr_topk(w: Workbench) -> DataFrame:
    return _list(PersonalizedPageRank(n_walks=100).fit(w.train_set).recommend_all(w.users, K))


@_query
def tfidf_docs(w: Workbench) -> DataFrame:
    return w.content().documents(w.items)


@_query
def tfidf_vocabulary(w: Workbench) -> DataFrame:
    return _rounded(w.content_model.terms.select("term", "df", "idf"), "idf")


@_query
def tfidf_weights(w: Workbench) -> DataFrame:
    return _rounded(w.content_model.postings.select("item_id", "term", "w"), "w")


@_query
def doc_ngrams(w: Workbench) -> DataFrame:
    """Vocabulary of words and word pairs over whole documents, terms of at least two documents."""
    docs = views.documents(w.spark, w.sf_dir)
    model = ContentBased(text_cols=["text"], min_df=2, ngram_range=(1, 2))
    counts = model.term_counts(docs)
    return _rounded(model.vocabulary(counts, docs, docs.select("item_id")), "idf")


@_query
def user_profile(w: Workbench) -> DataFrame:
    return _rounded(w.content_model.profile_terms(), "w")


@_query
def user_profile_weighted(w: Workbench) -> DataFrame:
    """Profiles from click-stream events, weighted by event type and recency."""
    model = ContentBased(
        text_cols=["name", "tags", "ingredients"], metadata_cols=["size"], ngram_range=(1, 1), recency_decay=0.05,
        event_col="event_type", time_col="date_time", event_weight_map=EVENT_WEIGHTS,
    ).fit(w.event_set, w.items)
    return _rounded(model.profile_terms(), "w")


@_query
def content_topk(w: Workbench) -> DataFrame:
    return _list(w.content_model.recommend_all(w.users, K))


@_query
def content_pair_score(w: Workbench) -> DataFrame:
    """Every test pair scored against the profile."""
    return _rounded(w.content_model.score_pairs(w.truth), "score")


@_query
def content_explain(w: Workbench) -> DataFrame:
    explained = w.content_model.explain_all(w.users, K)
    return explained.withColumn("rank", F.col("rank").cast("int"))


@_query
def factor_topk(w: Workbench) -> DataFrame:
    return _list(w.factor_model.recommend_all(w.users, K))


@_query
def mf_topk(w: Workbench) -> DataFrame:
    return _list(w.biased_model.recommend_all(w.users, K))


@_query
def factor_debiased(w: Workbench) -> DataFrame:
    return _list(w.factor_model.debiased(0.15).recommend_all(w.users, K))


@_query
def factor_pair_score(w: Workbench) -> DataFrame:
    return _rounded(w.factor_model.score_pairs(w.truth), "score")


@_query
def vector_topk(w: Workbench) -> DataFrame:
    """Nearest vectors of every embedding by inner product, itself left out."""
    vectors = read_parquet(w.spark, w.sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("factors"))
    own = vectors.select(F.col("id").alias("user_id"), F.col("id").alias("item_id"))
    model = VectorRetriever(include_item_bias=False, fallback_to_popularity=False)
    return _list(model.with_vectors(TrainSet(own), vectors, vectors).recommend_all(own.select("user_id"), 10))


@_query
def vector_normalized(w: Workbench) -> DataFrame:
    return _list(VectorRetriever(normalize=True).fit(w.factor_model).recommend_all(w.users, K))


def _embeddings(w: Workbench) -> tuple[DataFrame, TrainSet]:
    vectors = read_parquet(w.spark, w.sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("factors"))
    return vectors, TrainSet(vectors.select(F.col("id").alias("user_id"), F.col("id").alias("item_id")))


@_query
def vector_ann(w: Workbench) -> DataFrame:
    """Per user the share of the exact 300 nearest items that the approximate index finds."""
    exact = VectorRetriever(normalize=True, fallback_to_popularity=False).fit(w.factor_model).recommend_all(w.users, 300)
    found = ApproximateRetriever(normalize=True, fallback_to_popularity=False).fit(w.factor_model).recommend_all(w.users, 300)
    return list_recall(found, exact).withColumn("recall", F.round(F.col("hits") / F.col("n"), 6))


@_query
def vector_ann_recall(w: Workbench) -> DataFrame:
    """Approximate lists of 300 against exact ones, over the factors and over the embeddings: rows in the exact lists, indexed items,
    and whether the recall is 0.9 or more."""
    vectors, own = _embeddings(w)
    plain = {"include_item_bias": False, "fallback_to_popularity": False}
    unit = {"normalize": True, "fallback_to_popularity": False}
    out = []
    for name, users, exact, near in (
        ("factors", w.users, VectorRetriever(**unit).fit(w.factor_model), ApproximateRetriever(**unit).fit(w.factor_model)),
        ("embeddings", own.user_sizes.select("user_id"), VectorRetriever(**plain).with_vectors(own, vectors, vectors), ApproximateRetriever(**plain).with_vectors(own, vectors, vectors)),
    ):
        hits = list_recall(near.recommend_all(users, 300), exact.recommend_all(users, 300))
        enough = (F.sum("hits") / F.sum("n") >= 0.9).alias("reached")
        out.append(hits.agg(F.sum("n").alias("listed"), enough).select(F.lit(name).alias("source"), "listed", F.lit(int(near.counts.sum())).cast("long").alias("indexed"), "reached"))
    return out[0].unionByName(out[1])


@_query
def vector_pair_score(w: Workbench) -> DataFrame:
    return _rounded(VectorRetriever(normalize=True).fit(w.factor_model).score_pairs(w.truth), "score")


@_query
def vector_neighbors(w: Workbench) -> DataFrame:
    anchor = prepare.top_items(w.train, 1).select(F.col("item_id").alias("id"))
    return _rounded(nearest_items(w.factors[1], anchor), "similarity")


@_query
def top_bias(w: Workbench) -> DataFrame:
    return w.factor_model.top_bias(prepare.with_item_names(w.items)).select("item_id", "name", F.round("bias", 6).alias("bias"))


@_query
def neg_samples(w: Workbench) -> DataFrame:
    t = w.train_set
    return negatives.sampled_negatives(t.pairs, t.history, t.item_index, t.n_items, epoch=1, attempts=8).drop("m")


def _one_step(w: Workbench, objective: str) -> DataFrame:
    t = w.train_set
    triples = negatives.negatives(t, t.item_index, epoch=1, attempts=8)
    users, items = sgd_round(triples, t, *w.factors, objective, DIMENSIONS, lr=0.05, reg=0.01)
    both = users.withColumn("kind", F.lit("user")).unionByName(items.withColumn("kind", F.lit("item")))
    # The given factors are short decimals, so results can lie half-way between two roundings; the offset keeps them off.
    dims = [F.round(F.col("factors")[d] + 3.14159265e-7, 6).alias(f"f{d}") for d in range(DIMENSIONS)]
    return both.select("kind", "id", F.round(F.col("bias") + 3.14159265e-7, 6).alias("bias"), *dims)


@_query
def bpr_one_step(w: Workbench) -> DataFrame:
    return _one_step(w, "bpr")


@_query
def mf_one_step(w: Workbench) -> DataFrame:
    return _one_step(w, "squared")


def _training_checks(w: Workbench, model) -> DataFrame:
    """One row: items with factors, whether all numbers are finite, and whether held-out pairs rank clearly better than by popularity.

    The log is the whole order log with a planted taste: every bought item is moved to its user's quarter of the catalog. Each user's last
    purchase is held out and compared with a drawn item the user has not bought.
    """
    train, test = w.tasted
    fitted = model.fit(train)
    numbers = F.array_union("factors", F.array("bias"))
    finite = F.every(F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e6)))
    pairs = test.select("user_id", "item_id", F.lit(1).cast("long").alias("m"))
    history = train.history.unionByName(test.select("user_id", "item_id"))
    triples = negatives.sampled_negatives(pairs, history, train.item_index, train.n_items, epoch=99, attempts=8)
    up = fitted.score_pairs(triples.select("user_id", "item_id", "negative")).withColumnRenamed("score", "up")
    both = fitted.score_pairs(up.select("user_id", F.col("item_id").alias("positive"), F.col("negative").alias("item_id"), "up"))
    counts = train.item_counts
    known = both.join(counts.select("item_id", F.col("n_rows").alias("n_down")), "item_id")
    known = known.join(counts.select(F.col("item_id").alias("positive"), F.col("n_rows").alias("n_up")), "positive")

    def won(a: str, b: str):
        return F.avg((F.col(a) > F.col(b)).cast("double") + (F.col(a) == F.col(b)).cast("double") / 2)

    better = known.agg((won("up", "score") >= won("n_up", "n_down") + 0.1).alias("better"))
    return fitted.items.agg(F.count(F.lit(1)).alias("items"), finite.alias("finite")).select("*", better.scalar().alias("better"))


@_query
def bpr_train(w: Workbench) -> DataFrame:
    return _training_checks(w, BPR(16, learning_rate=0.2, epochs=5, strata=4))


@_query
def mf_train(w: Workbench) -> DataFrame:
    return _training_checks(w, BiasedMF(16, learning_rate=0.2, epochs=5, strata=4))


@_query
def hybrid_topk(w: Workbench) -> DataFrame:
    return _list(Hybrid(w.factor_model, w.content_model, alpha=0.5).fit(w.train_set).recommend_all(w.users, K))


@_query
def hybrid_adaptive(w: Workbench) -> DataFrame:
    return _list(w.hybrid.recommend_all(w.users, K))


@_query
def alpha_sweep(w: Workbench) -> DataFrame:
    """Recall, NDCG and coverage of the hybrid for four weights."""
    lists = durable(w.hybrid.sweep(w.users, K).withColumn("model", F.col("alpha").cast("string")))
    names = ["0.3", "0.5", "0.7", "0.9"]
    out = accuracy.accuracy(lists, w.truth, names, K).join(accuracy.coverage(lists, w.train_set.item_counts), "model")
    return _rounded(out.select(F.col("model").cast("double").alias("alpha"), "recall", "ndcg", "coverage"), "recall", "ndcg", "coverage")


# --- metrics --------------------------------------------------------------------------------------------------------

LISTED = [
    "popularity", "trending", "random", "markov", "knn", "page_rank", "content", "bpr", "mf", "bpr_debiased", "vectors", "hybrid",
]
POOLED = ["popularity", "markov"]
ALL_POOLED = [name for name in LISTED if name != "knn"]


@_query
def recall_ndcg(w: Workbench) -> DataFrame:
    return _rounded(accuracy.user_accuracy(w.lists, w.truth, LISTED, K), "recall", "ndcg")


@_query
def novelty(w: Workbench) -> DataFrame:
    return _rounded(accuracy.novelty(w.lists, w.truth, w.train_set.item_counts, K), "novelty")


@_query
def coverage(w: Workbench) -> DataFrame:
    return _rounded(accuracy.coverage(w.lists, w.train_set.item_counts), "coverage")


@_query
def snips_user(w: Workbench) -> DataFrame:
    return _rounded(accuracy.snips_by_user(w.lists, w.truth, LISTED, w.train_set.item_counts, K), "snips")


@_query
def several_truths(w: Workbench) -> DataFrame:
    """Recall, gain and weighted hit ratio with several true items per user, where the three differ."""
    listed = [w.lists.filter((F.col("model") == model) & (F.col("rank") <= n)) for model, n in (("random", 2), ("knn", 1))]
    truth = w.truth.unionByName(listed[0].select("user_id", "item_id")).unionByName(listed[1].select("user_id", "item_id")).distinct()
    both = accuracy.user_accuracy(w.lists, truth, LISTED, K)
    weighed = accuracy.snips_by_user(w.lists, truth, LISTED, w.train_set.item_counts, K)
    return _rounded(both.join(weighed, ["model", "user_id"]), "recall", "ndcg", "snips")


@_query
def snips_pooled(w: Workbench) -> DataFrame:
    return _rounded(accuracy.snips_pooled(w.lists, w.truth, LISTED, w.train_set.item_counts, K), "snips")


@_query
def macro_table(w: Workbench) -> DataFrame:
    table = accuracy.macro_table(w.lists, w.truth, LISTED, w.train_set.item_counts, K)
    return _rounded(table, "recall", "ndcg", "coverage", "novelty", "snips")


@_query
def slice_activity(w: Workbench) -> DataFrame:
    return _rounded(accuracy.activity_slices(w.lists, w.truth, LISTED, w.train_set.user_sizes, K), "recall", "ndcg")


@_query
def slice_cold(w: Workbench) -> DataFrame:
    """Users whose true item is cold, under lists of models fitted without one brand."""
    lists = accuracy.stack(
        {
            "popularity": Popularity().fit(w.cold_set).recommend_all(w.users, K),
            "content": w.cold_content.recommend_all(w.users, K),
        }
    )
    sliced = accuracy.cold_item_slice(lists, w.truth, ["popularity", "content"], w.cold_set.item_counts, K)
    return _rounded(sliced, "recall", "ndcg")


@_query
def slice_cold_all(w: Workbench) -> DataFrame:
    """The same users under all four models, the factor model and the hybrid fitted without the brand as well."""
    hybrid = Hybrid(w.cold_factors, w.cold_content, alpha=0.9, adaptive=True).fit(w.cold_set)
    models = {"popularity": Popularity().fit(w.cold_set), "content": w.cold_content, "bpr": w.cold_factors, "hybrid": hybrid}
    lists = accuracy.stack({name: model.recommend_all(w.users, K) for name, model in models.items()})
    return _rounded(accuracy.cold_item_slice(lists, w.truth, list(models), w.cold_set.item_counts, K), "recall", "ndcg")


@_query
def gini(w: Workbench) -> DataFrame:
    return _rounded(fairness.gini(w.lists, w.items.select("item_id")), "gini")


@_query
def ild(w: Workbench) -> DataFrame:
    diversity = fairness.intra_list_diversity(w.lists, w.content_model.postings, w.content_model.items)
    return _rounded(diversity, "ild")


@_query
def cand_recall(w: Workbench) -> DataFrame:
    return _rounded(accuracy.user_accuracy(w.pools, w.truth, POOLED, 300).select("model", "user_id", "recall"), "recall")


@_query
def cand_hit(w: Workbench) -> DataFrame:
    return candidates.candidate_hits(w.pools, w.truth, POOLED, 300)


@_query
def cand_coverage(w: Workbench) -> DataFrame:
    return _rounded(accuracy.coverage(w.pools, w.train_set.item_counts, 300), "coverage")


@_query
def cand_size(w: Workbench) -> DataFrame:
    """Mean list size at budgets the fetched pools can and cannot fill."""
    sweep = candidates.budget_sweep(w.pools, w.truth, POOLED, w.train_set.item_counts, (300, 500, 1000))
    return _rounded(sweep.select("model", "candidate_budget", "avg_candidate_set_size"), "avg_candidate_set_size")


def merged_lists(lists: DataFrame) -> DataFrame:
    """Popularity and trending lists interleaved into one without removing repeats."""
    place = F.when(F.col("model") == "popularity", F.col("rank") * 2 - 1).otherwise(F.col("rank") * 2)
    both = lists.filter(F.col("model").isin("popularity", "trending"))
    return both.select(F.lit("merged").alias("model"), "user_id", "item_id", place.alias("rank"))


@_query
def dup_rate(w: Workbench) -> DataFrame:
    return _rounded(candidates.duplicate_rates(merged_lists(w.lists), 30), "duplicate_rate")


@_query
def cand_summary(w: Workbench) -> DataFrame:
    out = candidates.summarize(merged_lists(w.lists), w.truth, ["merged"], w.train_set.item_counts, 30)
    return _rounded(out, *[c for c in out.columns if c != "model"])


@_query
def cand_sweep(w: Workbench) -> DataFrame:
    out = candidates.budget_sweep(w.pools, w.truth, POOLED, w.train_set.item_counts)
    return _rounded(out, "candidate_recall", "candidate_coverage", "avg_candidate_set_size", "mean_duplicate_rate")


@_query
def cand_recall_all(w: Workbench) -> DataFrame:
    return _rounded(accuracy.user_accuracy(w.all_pools, w.truth, ALL_POOLED, 300).select("model", "user_id", "recall"), "recall")


@_query
def cand_hit_all(w: Workbench) -> DataFrame:
    return candidates.candidate_hits(w.all_pools, w.truth, ALL_POOLED, 300)


@_query
def cand_coverage_all(w: Workbench) -> DataFrame:
    return _rounded(accuracy.coverage(w.all_pools, w.train_set.item_counts, 300), "coverage")


@_query
def cand_size_all(w: Workbench) -> DataFrame:
    sweep = candidates.budget_sweep(w.all_pools, w.truth, ALL_POOLED, w.train_set.item_counts, (300, 500, 1000))
    return _rounded(sweep.select("model", "candidate_budget", "avg_candidate_set_size"), "avg_candidate_set_size")


@_query
def cand_sweep_all(w: Workbench) -> DataFrame:
    out = candidates.budget_sweep(w.all_pools, w.truth, ALL_POOLED, w.train_set.item_counts)
    return _rounded(out, "candidate_recall", "candidate_coverage", "avg_candidate_set_size", "mean_duplicate_rate")


# --- re-ranking -----------------------------------------------------------------------------------------------------


def _features(w: Workbench, inject: bool) -> DataFrame:
    return features.feature_table(w.candidates, w.truth, w.train_set, w.factor_model, w.content_model, inject)


@_query
def ltr_features(w: Workbench) -> DataFrame:
    return _rounded(_features(w, inject=True), "bpr_score", "content_score")


@_query
def ltr_scoring_table(w: Workbench) -> DataFrame:
    return _rounded(_features(w, inject=False), "bpr_score", "content_score")


def _fixed_scores(table: DataFrame) -> DataFrame:
    """A fixed linear score, so that the lists do not depend on a fit."""
    score = F.col("bpr_score") * 0.5 + F.col("content_score") * 2.0
    score = score + F.col("popularity_score") * 0.01 - F.col("user_activity") * 0.001
    return table.withColumn("ltr_score", score)


@_query
def ltr_rerank(w: Workbench) -> DataFrame:
    return _list(rankers.rerank(_fixed_scores(_features(w, inject=False)), K))


@_query
def ltr_eval(w: Workbench) -> DataFrame:
    lists = accuracy.stack({"ltr": rankers.rerank(_fixed_scores(_features(w, inject=False)), K)})
    return _rounded(accuracy.accuracy(lists, w.truth, ["ltr"], K), "recall", "ndcg")


def _ranked_by(w: Workbench, ranker) -> DataFrame:
    """Fit on one half of the users with injected truth, rank the other half's candidates."""
    fit_rows, _ = features.split_users(durable(_features(w, inject=True)))
    _, rank_rows = features.split_users(_features(w, inject=False))
    return _list(ranker.fit(fit_rows, features.FEATURES).rerank(rank_rows, K))


@_query
def ltr_lambda_first(w: Workbench) -> DataFrame:
    """Gradient and curvature that the pairwise ranker's first tree is grown on."""
    return _rounded(rankers.first_gradients(_features(w, inject=True)), "grad", "hess", digits=9)


@_query
def ltr_pointwise_optimum(w: Workbench) -> DataFrame:
    """The slope of the penalised, class-balanced loss at the fitted coefficients, per row of the table: 0 at the optimum."""
    table = durable(_features(w, inject=True))
    slopes = rankers.PointwiseRanker().fit(table, features.FEATURES).slopes(table)
    return slopes.select("feature", "n", F.round(F.abs("slope"), 3).alias("slope"))


@_query
def ltr_pointwise(w: Workbench) -> DataFrame:
    return _ranked_by(w, rankers.PointwiseRanker())


@_query
def ltr_pairwise(w: Workbench) -> DataFrame:
    return _ranked_by(w, rankers.PairwiseRanker())


@_query
def ltr_end_to_end(w: Workbench) -> DataFrame:
    """The whole two-stage run on trained factors: retrieval by the hybrid, features, the pairwise ranker, re-ranked lists, metrics.

    The ranker is fitted on one half of the users; both stages are judged on the other half.
    """
    return two_stage(w.trained["bpr"], w.content_model, w.trained["hybrid"], w.train_set, w.users, w.truth)


def two_stage(factor_model, content_model, hybrid, train: TrainSet, users: DataFrame, truth: DataFrame, ranker=None, pool: int = 100, k: int = K) -> DataFrame:
    """``model, users, recall, ndcg`` of the first stage's lists (``hybrid``) and the re-ranked ones (``ltr``)."""
    candidates = durable(hybrid.recommend_all(users, pool))
    table = durable(features.feature_table(candidates, truth, train, factor_model, content_model, inject=True))
    fit_rows, _ = features.split_users(table)
    fitted = (ranker or rankers.PairwiseRanker()).fit(fit_rows, features.FEATURES)
    scoring = features.feature_table(candidates, truth, train, factor_model, content_model, inject=False)
    _, judged = features.split_users(scoring)
    _, left = features.split_users(truth)
    lists = {"hybrid": features.split_users(candidates)[1].filter(F.col("rank") <= k), "ltr": fitted.rerank(judged, k)}
    return _rounded(accuracy.accuracy(durable(accuracy.stack(lists)), left, list(lists), k), "recall", "ndcg")


@_query
def trained_macro(w: Workbench) -> DataFrame:
    """The metric table of the learned models, with factors from training."""
    lists = durable(accuracy.stack({name: m.recommend_all(w.users, K) for name, m in w.trained.items()}))
    table = accuracy.macro_table(lists, w.truth, list(w.trained), w.train_set.item_counts, K)
    return _rounded(table, "recall", "ndcg", "coverage", "novelty", "snips")


# --- run log --------------------------------------------------------------------------------------------------------


def _runs(w: Workbench, stamp: bool) -> DataFrame:
    table = accuracy.macro_table(w.lists, w.truth, LISTED, w.train_set.item_counts, K)
    return run_rows(table, "order_lines_rating_ge_4", K, {"trending": "days_window=180"}, stamp)


@_query
def run_table(w: Workbench) -> DataFrame:
    return _runs(w, stamp=False)


@_query
def run_log(w: Workbench) -> DataFrame:
    """Two appends to a CSV run log, read back; the time of a run is checked for its form."""
    path = f"{shared_folder(w.spark)}/runs-{uuid.uuid4().hex}"
    for _ in range(2):
        append_runs(_runs(w, stamp=True), path)
    log = w.spark.read.option("header", True).csv(path)
    stamped = F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$").alias("stamped")
    numbers = [F.col(c).cast("double").alias(c) for c in ("recall", "ndcg", "coverage")]
    return log.select("dataset", "model", F.col("k_evaluated").cast("int").alias("k_evaluated"), F.coalesce("hyperparams", F.lit("")).alias("hyperparams"), *numbers, stamped)
