"""TF-IDF content model: item vectors, user profiles, cosine lists, pair scores, explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..functions.numeric import days_between, recency_weight, value_weight
from ..operators.blocks import sparse_top_k
from ..operators.order import global_index
from ..operators.prepare import first_per_key, require_columns
from ..session import durable
from .base import TrainSet

# Explanation texts: fixed formats.
OVERLAP_TEXT = "Recommended because it overlaps on: %s."
PROFILE_TEXT = "Recommended due to overall profile match."
COLD_USER_TEXT = "Recommended due to popularity fallback (cold user)."
FALLBACK_TEXT = "Recommended due to popularity fallback."


class ContentBased:
    """TF-IDF over item documents; a user's profile is the weighted mean of the vectors of their items."""

    lists_unseen = True

    def __init__(
        self,
        feature_cols: list[str] | None = None,
        text_cols: list[str] | None = None,
        metadata_cols: list[str] | None = None,
        min_df: int = 1,
        ngram_range: tuple[int, int] = (1, 2),
        recency_decay: float = 0.0,
        event_col: str | None = None,
        time_col: str | None = None,
        event_weight_map: dict[str, float] | None = None,
    ):
        self.feature_cols = feature_cols
        self.text_cols = text_cols
        self.metadata_cols = metadata_cols
        self.min_df = min_df
        self.ngram_range = ngram_range
        self.recency_decay = recency_decay
        self.event_col = event_col
        self.time_col = time_col
        self.event_weight_map = event_weight_map

    def resolve_columns(self, schema: T.StructType, item_col: str = "item_id") -> tuple[list[str], list[str]]:
        """Text and metadata columns: explicit lists, the older single list, or by data type."""
        names = [f.name for f in schema.fields if f.name != item_col]
        if self.feature_cols is not None:
            return [c for c in self.feature_cols if c in names], []
        texts = [c for c in self.text_cols or [] if c in names]
        metadata = [c for c in self.metadata_cols or [] if c in names]
        if self.text_cols is None and self.metadata_cols is None:
            texts = [c for c in names if isinstance(schema[c].dataType, T.StringType)]
            metadata = [c for c in names if isinstance(schema[c].dataType, T.NumericType | T.BooleanType)]
        return [c for c in texts if c not in metadata], metadata

    def documents(self, items: DataFrame) -> DataFrame:
        """``(item_id, document)``, one per item."""
        texts, metadata = self.resolve_columns(items.schema)
        if not texts and not metadata:
            raise ValueError("No feature columns found for the content model.")
        unique = first_per_key(items.select("item_id", *texts, *metadata), "item_id")
        tokens = text.item_tokens(unique.schema, "item_id", texts, metadata)
        return unique.select("item_id", F.array_join(tokens, " ").alias("document"))

    def missing_rates(self, items: DataFrame) -> DataFrame:
        """Share of nulls per feature column over unique items."""
        from ..operators.explore import missing_counts

        texts, metadata = self.resolve_columns(items.schema)
        unique = first_per_key(items.select("item_id", *texts, *metadata), "item_id")
        return missing_counts(unique).filter(F.col("column") != "item_id")

    def term_counts(self, items: DataFrame) -> DataFrame:
        """``(item_id, term, tf)``."""
        listed = self.documents(items).select("item_id", text.words(F.col("document")).alias("words"))
        exploded = listed.select("item_id", F.explode(text.ngrams(F.col("words"), self.ngram_range)).alias("term"))
        return exploded.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("tf"))

    def vocabulary(self, counts: DataFrame, items: DataFrame, item_counts: DataFrame) -> DataFrame:
        """``(term, df, idf)`` over train items only."""
        known = item_counts.select("item_id")
        n = items.select("item_id").distinct().join(known, "item_id", "left_semi").agg(F.count(F.lit(1)))
        df = counts.join(known, "item_id", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        idf = F.log((1.0 + n.scalar()) / (1.0 + F.col("df"))) + 1.0
        return df.filter(F.col("df") >= self.min_df).select("term", "df", idf.alias("idf"))

    def fit(self, train: TrainSet, items: DataFrame) -> ContentBased:
        require_columns(items, ["item_id"], "item table")
        self.train = train
        counts = durable(self.term_counts(items))
        vocabulary = self.vocabulary(counts, items, train.item_counts)
        # Blocks carry numbers instead of strings.
        self.terms = global_index(vocabulary, F.asc("term"), name="term_id")
        weight = F.col("tf") * F.col("idf")
        norm = F.sqrt(F.sum(weight * weight).over(Window.partitionBy("item_id")))  # one document per window
        self.postings = durable(
            counts.join(self.terms, "term").select("item_id", "term_id", "term", (weight / norm).alias("w"))
        )
        self.items = items.select("item_id").distinct()
        self.profiles = durable(self._profiles())
        return self

    def interaction_weights(self) -> DataFrame:
        """Summed weight per (user, item): event weight times recency, over all rows of the pair."""
        rows = self.train.train
        weight = F.lit(1.0)
        if self.event_col in rows.columns:
            weight = value_weight(F.col(self.event_col), self.event_weight_map)
        if self.recency_decay > 0 and self.time_col in rows.columns:
            newest = rows.agg(F.max(self.time_col)).scalar()
            weight = weight * recency_weight(days_between(newest, F.col(self.time_col)), self.recency_decay)
        return rows.groupBy("user_id", "item_id").agg(F.sum(weight).alias("weight"))

    def _profiles(self) -> DataFrame:
        """``(user_id, term_id, w)``; users whose weights sum to 0 or less have none."""
        weights = self.interaction_weights().join(self.items, "item_id", "left_semi")
        totals = weights.groupBy("user_id").agg(F.sum("weight").alias("total")).filter("total > 0")
        sums = weights.join(self.postings, "item_id").groupBy("user_id", "term_id")
        sums = sums.agg(F.sum(F.col("weight") * F.col("w")).alias("s"))
        return sums.join(totals, "user_id").select("user_id", "term_id", (F.col("s") / F.col("total")).alias("w"))

    def profile_terms(self) -> DataFrame:
        return self.profiles.join(self.terms.select("term_id", "term"), "term_id").select("user_id", "term", "w")

    def recommend_scored(self, users: DataFrame, k: int) -> DataFrame:
        """The content lists alone, items with a positive cosine only."""
        norms = self.profiles.groupBy("user_id").agg(
            F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.count(F.lit(1)).alias("n")
        )
        norms = norms.join(users, "user_id", "left_semi").filter("norm > 0")
        unit = self.profiles.join(norms, "user_id").select("user_id", "term_id", (F.col("w") / F.col("norm")).alias("w"))
        seen = self.train.history.join(users, "user_id", "left_semi")
        n_items = self.items.agg(F.count(F.lit(1))).scalar()
        size = norms.agg(F.count(F.lit(1)).alias("users"), F.max("n").alias("terms"), F.sum("n").alias("rows")).withColumn("items", n_items).first()
        vectors = self.postings.select("item_id", "term_id", "w")
        entries = (size["rows"] or 0, self.postings.count())
        longest = max(size["terms"] or 0, self.train.max_history)
        return sparse_top_k(unit, vectors, seen, k, size["users"], size["items"], longest, entries)

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        return self.train.fill_with_popularity(self.recommend_scored(users, k), users, k)

    def _overlap(self, pairs: DataFrame) -> DataFrame:
        """``(user_id, item_id, term, part)``: products of shared terms. The item's terms are fetched first, then the
        profile weight by (user, term), so neither a user's whole profile nor a hot term is expanded."""
        wanted = pairs.select("user_id", "item_id").join(
            self.postings.select("item_id", "term_id", "term", F.col("w").alias("wi")), "item_id"
        )
        return wanted.join(self.profiles, ["user_id", "term_id"]).select(
            "user_id", "item_id", "term", (F.col("wi") * F.col("w")).alias("part")
        )

    def score_pairs(self, pairs: DataFrame) -> DataFrame:
        """Profile-item product per pair, 0 for unknown users or items."""
        sums = self._overlap(pairs).groupBy("user_id", "item_id").agg(F.sum("part").alias("score"))
        joined = pairs.join(sums, ["user_id", "item_id"], "left")
        return joined.withColumn("score", F.coalesce("score", F.lit(0.0)))

    def explain_pairs(self, pairs: DataFrame, top_n: int = 3) -> DataFrame:
        """Each pair with its strongest shared terms as text; ``pairs`` needs a distinct (user_id, item_id)."""
        parts = self._overlap(pairs).withColumn("part", F.round("part", 10))
        best = Window.partitionBy("user_id", "item_id").orderBy(F.desc("part"), F.asc("term"))
        parts = parts.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top_n)
        listed = F.array_sort(F.collect_list(F.struct("place", text.display_name(F.col("term")).alias("name"))))
        names = parts.groupBy("user_id", "item_id").agg(F.array_join(listed.getField("name"), ", ").alias("names"))
        known_user = self.profiles.select("user_id").distinct().withColumn("known_user", F.lit(True))
        known_item = self.items.withColumn("known_item", F.lit(True))
        joined = (
            pairs.join(names, ["user_id", "item_id"], "left")
            .join(known_user, "user_id", "left")
            .join(known_item, "item_id", "left")
        )
        reason = (
            F.when(F.col("known_user").isNull(), F.lit(COLD_USER_TEXT))
            .when(F.col("names").isNotNull(), F.format_string(OVERLAP_TEXT, F.col("names")))
            .when(F.col("known_item"), F.lit(PROFILE_TEXT))
            .otherwise(F.lit(FALLBACK_TEXT))
        )
        return joined.select(*pairs.columns, reason.alias("explanation"))

    def explain_all(self, users: DataFrame, k: int = 10, top_n: int = 3) -> DataFrame:
        lists = self.recommend_all(users, k).select("user_id", "item_id", "rank")
        return self.explain_pairs(lists, top_n)
