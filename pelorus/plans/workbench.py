"""Prepared tables and fitted models over one test-data folder, shared by the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..metrics.accuracy import stack
from ..models.base import TrainSet
from ..models.content import ContentBased
from ..models.factors import BPR, BiasedMF, FactorModel
from ..models.graph import PersonalizedPageRank
from ..models.hybrid import Hybrid
from ..models.knn import ItemKNN
from ..models.markov import Markov
from ..models.popularity import Popularity, Random, Trending
from ..models.vectors import VectorRetriever
from ..operators.prepare import modelling_frame
from ..operators.split import leave_last_out
from ..session import configure, durable, small_tasks
from ..sources import views

K = 20
POOL = 500
DIMENSIONS = 8

# All rows of this brand are taken out of train where cold items are needed.
COLD_BRAND = "Brand#13"

# Kinds of taste planted in the log for training checks.
TASTES = 4

EVENT_WEIGHTS = {"view": 1.0, "click": 2.0, "signup": 3.0, "purchase": 5.0, "error": 0.0}


def arithmetic_factors(ids: DataFrame, step: int, modulus: int, half: int) -> DataFrame:
    """Factor rows that any engine can rebuild from the id: multiples of 1/16, biases of 1/64."""
    factors = [
        (F.pmod(F.col("id") * (step * d + half - step) + d, F.lit(modulus)) - half) / F.lit(16.0) for d in range(DIMENSIONS)
    ]
    bias = (F.pmod(F.col("id") * step, F.lit(modulus)) - half) / F.lit(64.0)
    return ids.select("id", F.array(*factors).alias("factors"), bias.alias("bias"))


class Workbench:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = small_tasks(configure(spark))
        self.sf_dir = sf_dir

    @cached_property
    def interactions(self) -> DataFrame:
        return views.interactions(self.spark, self.sf_dir)

    @cached_property
    def items(self) -> DataFrame:
        return views.items(self.spark, self.sf_dir)

    @cached_property
    def frame(self) -> DataFrame:
        """Positives of users with at least two, joined to the items."""
        return modelling_frame(self.interactions, self.items).select("user_id", "item_id", "date_time", "rating")

    @cached_property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        return leave_last_out(durable(self.frame), written=True)

    @property
    def train(self) -> DataFrame:
        return self._split[0]

    @property
    def test(self) -> DataFrame:
        return self._split[1]

    @cached_property
    def train_set(self) -> TrainSet:
        return TrainSet(self.train)

    @cached_property
    def users(self) -> DataFrame:
        return self.test.select("user_id")

    @cached_property
    def truth(self) -> DataFrame:
        return self.test.select("user_id", "item_id")

    @cached_property
    def tasted(self) -> tuple[TrainSet, DataFrame]:
        """The log with a planted taste, split: every row's item is moved to the user's quarter of its group of four ids."""
        quarter = F.col("item_id") - F.pmod("item_id", F.lit(TASTES)) + F.pmod("user_id", F.lit(TASTES))
        train, test = leave_last_out(durable(self.frame.withColumn("item_id", quarter)), written=True)
        return TrainSet(train), test

    @cached_property
    def cold_train(self) -> DataFrame:
        held_out = self.items.filter(F.col("tags") == COLD_BRAND).select("item_id")
        return durable(self.train.join(held_out, "item_id", "left_anti"))

    @cached_property
    def cold_set(self) -> TrainSet:
        return TrainSet(self.cold_train)

    def content(self) -> ContentBased:
        return ContentBased(
            text_cols=["name", "tags", "ingredients"], metadata_cols=["size", "price"], min_df=2, ngram_range=(1, 1),
            time_col="date_time",
        )

    @cached_property
    def content_model(self) -> ContentBased:
        return self.content().fit(self.train_set, self.items)

    @cached_property
    def cold_content(self) -> ContentBased:
        return self.content().fit(self.cold_set, self.items)

    @cached_property
    def cold_factors(self) -> FactorModel:
        ids = self.cold_set.user_sizes.select(F.col("user_id").alias("id"))
        item_ids = self.cold_set.item_counts.select(F.col("item_id").alias("id"))
        return FactorModel().with_factors(self.cold_set, arithmetic_factors(ids, 5, 13, 6), arithmetic_factors(item_ids, 7, 17, 8))

    @cached_property
    def factors(self) -> tuple[DataFrame, DataFrame]:
        ids = self.train_set.user_sizes.select(F.col("user_id").alias("id"))
        item_ids = self.train_set.item_counts.select(F.col("item_id").alias("id"))
        return arithmetic_factors(ids, 5, 13, 6), arithmetic_factors(item_ids, 7, 17, 8)

    @cached_property
    def factor_model(self) -> FactorModel:
        return FactorModel().with_factors(self.train_set, *self.factors)

    @cached_property
    def biased_model(self) -> FactorModel:
        model = FactorModel()
        model.user_bias = True
        return model.with_factors(self.train_set, *self.factors)

    @cached_property
    def trained(self) -> dict:
        """The learned models of the full run, trained on the train set; the hybrid and the vectors use the trained factors."""
        bpr = BPR(16, learning_rate=0.2, epochs=5, strata=4).fit(self.train_set)
        return {
            "bpr": bpr,
            "mf": BiasedMF(16, learning_rate=0.2, epochs=5, strata=4).fit(self.train_set),
            "bpr_debiased": bpr.debiased(0.15),
            "vectors": VectorRetriever(normalize=True).fit(bpr),
            "hybrid": Hybrid(bpr, self.content_model, alpha=0.9, adaptive=True).fit(self.train_set),
        }

    @cached_property
    def hybrid(self) -> Hybrid:
        return Hybrid(self.factor_model, self.content_model, alpha=0.9, adaptive=True).fit(self.train_set)

    @cached_property
    def events(self) -> DataFrame:
        return views.event_interactions(self.spark, self.sf_dir)

    @cached_property
    def event_set(self) -> TrainSet:
        return TrainSet(self.events)

    @cached_property
    def models(self) -> dict:
        return {
            "popularity": Popularity().fit(self.train_set),
            "trending": Trending(180).fit(self.train_set),
            "random": Random(42).fit(self.train_set),
            "markov": Markov().fit(self.train_set),
            "knn": ItemKNN().fit(self.train_set),
            "page_rank": PersonalizedPageRank(n_walks=100).fit(self.train_set),
            "content": self.content_model,
            "bpr": self.factor_model,
            "mf": self.biased_model,
            "bpr_debiased": self.factor_model.debiased(0.15),
            "vectors": VectorRetriever(normalize=True).fit(self.factor_model),
            "hybrid": self.hybrid,
        }

    @cached_property
    def lists(self) -> DataFrame:
        """Stacked top-20 lists of the models above, written once and reused by every metric."""
        return durable(stack({name: m.recommend_all(self.users, K) for name, m in self.models.items()}))

    @cached_property
    def pools(self) -> DataFrame:
        """Stacked candidate pools at the largest budget."""
        names = ("popularity", "markov")
        return durable(stack({name: self.models[name].recommend_all(self.users, POOL) for name in names}))

    @cached_property
    def all_pools(self) -> DataFrame:
        """Candidate pools of every model but the neighbours, at the largest budget."""
        return durable(stack({name: m.recommend_all(self.users, POOL) for name, m in self.models.items() if name != "knn"}))

    @cached_property
    def candidates(self) -> DataFrame:
        """The hybrid's first 100 per user."""
        return durable(self.hybrid.recommend_all(self.users, 100))


_benches: dict[tuple[str, str], Workbench] = {}


def workbench(spark: SparkSession, sf_dir: str) -> Workbench:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _benches:
        _benches[key] = Workbench(spark, sf_dir)
    return _benches[key]
