"""Ranking metrics over stacked lists ``(model, user_id, item_id, rank)``.

Every metric starts from the truth, so users without a list count as 0. Item attributes are joined only after lists
are combined to one row per item (and list length), because a popular item sits in almost every list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Count given to items that never occur in train, and the floor of the propensities: fixed values.
UNSEEN_COUNT = 1e-9
PROPENSITY_FLOOR = 0.05

POPULARITY_ALARM = 0.15


def stack(lists: dict[str, DataFrame]) -> DataFrame:
    """One long table from lists of several models."""
    out = None
    for name, recs in lists.items():
        part = recs.select(F.lit(name).alias("model"), "user_id", "item_id", F.col("rank").cast("int").alias("rank"))
        out = part if out is None else out.unionByName(part)
    return out


def truth_by_model(truth: DataFrame, models: list[str]) -> DataFrame:
    names = F.explode(F.array(*[F.lit(m) for m in models]))
    return truth.select("user_id", "item_id", names.alias("model"))


def true_rows(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Rows among the first k that name a true item of their user: one pass over the lists, of which few rows are left to group."""
    pairs = truth.select("user_id", "item_id").distinct()
    return recs.filter(F.col("rank") <= k).join(pairs, ["user_id", "item_id"], "left_semi")


def hits(recs: DataFrame, truth: DataFrame, models: list[str], k: int) -> DataFrame:
    """``(model, user_id, item_id, hit, gain)`` for every true item; gain sums ``1 / log2(rank + 1)``."""
    gains = (
        true_rows(recs, truth, k)
        .groupBy("model", "user_id", "item_id")
        .agg(F.sum(1 / F.log2(F.col("rank") + 1.0)).alias("gain"))
    )
    keys = ["model", "user_id", "item_id"]
    joined = truth_by_model(truth, models).join(gains, keys, "left")
    return joined.select(*keys, F.col("gain").isNotNull().cast("int").alias("hit"), F.coalesce("gain", F.lit(0.0)).alias("gain"))


def user_accuracy(recs: DataFrame, truth: DataFrame, models: list[str], k: int) -> DataFrame:
    """Recall@k and NDCG@k (ideal gain 1) per (model, user)."""
    per_item = hits(recs, truth, models, k)
    return per_item.groupBy("model", "user_id").agg(F.avg("hit").alias("recall"), F.sum("gain").alias("ndcg"))


def accuracy(recs: DataFrame, truth: DataFrame, models: list[str], k: int) -> DataFrame:
    per_user = user_accuracy(recs, truth, models, k)
    return per_user.groupBy("model").agg(
        F.count(F.lit(1)).alias("users"), F.avg("recall").alias("recall"), F.avg("ndcg").alias("ndcg")
    )


def novelty(recs: DataFrame, truth: DataFrame, item_counts: DataFrame, k: int) -> DataFrame:
    """Mean over users of the list's mean ``-log2(count / total)``.

    Lists are first combined to (model, item, list length) with a count, so the item join sees one row for an item
    however many lists hold it.
    """
    cut = recs.filter(F.col("rank") <= k)
    length = F.count(F.lit(1)).over(Window.partitionBy("model", "user_id"))
    combined = (
        cut.withColumn("length", length)
        .groupBy("model", "item_id", "length")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = item_counts.agg(F.sum("n_rows").cast("double")).scalar()
    share = F.coalesce(F.col("n_rows").cast("double"), F.lit(UNSEEN_COUNT)) / total
    summed = combined.join(item_counts, "item_id", "left").withColumn("bits", -F.log2(share) * F.col("n") / F.col("length"))
    users = truth.agg(F.countDistinct("user_id")).scalar()
    return summed.groupBy("model").agg((F.sum("bits") / F.first(users)).alias("novelty"))


def coverage(recs: DataFrame, catalog: DataFrame, k: int | None = None) -> DataFrame:
    """Distinct recommended items over the catalog size; 0 for an empty catalog."""
    cut = recs if k is None else recs.filter(F.col("rank") <= k)
    size = catalog.agg(F.count(F.lit(1))).scalar()
    listed = cut.select("model", "item_id").distinct().groupBy("model").agg(F.count(F.lit(1)).alias("n_listed"))
    return listed.select("model", F.coalesce(F.try_divide("n_listed", size), F.lit(0.0)).alias("coverage"))


def inverse_propensity(count: Column, max_count: Column, floor: float = PROPENSITY_FLOOR) -> Column:
    return 1 / F.greatest(F.lit(floor), F.sqrt(F.coalesce(count, F.lit(0)) / max_count))


def _weighted_hits(recs, truth, models, item_counts, k) -> DataFrame:
    """Hits and truths per (model, item), with the item's inverse propensity."""
    per_item = hits(recs, truth, models, k).groupBy("model", "item_id")
    per_item = per_item.agg(F.sum("hit").alias("hits"), F.count(F.lit(1)).alias("truths"))
    highest = item_counts.agg(F.max("n_rows").cast("double")).scalar()
    weight = inverse_propensity(F.col("n_rows"), F.coalesce(highest, F.lit(1.0)))
    return per_item.join(item_counts, "item_id", "left").withColumn("weight", weight)


def snips_pooled(recs: DataFrame, truth: DataFrame, models: list[str], item_counts: DataFrame, k: int) -> DataFrame:
    """Self-normalised inverse-propensity recall, one ratio over all users."""
    rows = _weighted_hits(recs, truth, models, item_counts, k)
    top, bottom = F.sum(F.col("hits") * F.col("weight")), F.sum(F.col("truths") * F.col("weight"))
    return rows.groupBy("model").agg(F.coalesce(F.try_divide(top, bottom), F.lit(0.0)).alias("snips"))


def snips_by_user(recs: DataFrame, truth: DataFrame, models: list[str], item_counts: DataFrame, k: int) -> DataFrame:
    """The same ratio per user. With one true item per user it equals recall."""
    highest = item_counts.agg(F.max("n_rows").cast("double")).scalar()
    weighed = truth.join(item_counts, "item_id", "left").select(
        "user_id", "item_id", inverse_propensity(F.col("n_rows"), F.coalesce(highest, F.lit(1.0))).alias("weight")
    )
    rows = hits(recs, truth, models, k).join(weighed, ["user_id", "item_id"])
    top, bottom = F.sum(F.col("hit") * F.col("weight")), F.sum("weight")
    return rows.groupBy("model", "user_id").agg(F.coalesce(F.try_divide(top, bottom), F.lit(0.0)).alias("snips"))


def macro_table(
    recs: DataFrame, truth: DataFrame, models: list[str], item_counts: DataFrame, k: int, alarm_model: str = "popularity"
) -> DataFrame:
    """All metrics by model. ``suspicious`` marks a popularity recall above the alarm level."""
    out = accuracy(recs, truth, models, k)
    for part in (
        coverage(recs, item_counts, k),
        novelty(recs, truth, item_counts, k),
        snips_pooled(recs, truth, models, item_counts, k),
    ):
        out = out.join(part, "model", "left")
    filled = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("recall", "ndcg", "coverage", "novelty", "snips")]
    suspicious = (F.col("model") == alarm_model) & (F.col("recall") > POPULARITY_ALARM)
    return out.select("model", "users", *filled, suspicious.alias("suspicious"))


def activity_bucket(n_rows: Column) -> Column:
    n = F.coalesce(n_rows, F.lit(0))
    return (
        F.when(n <= 3, "Sparse users (<=3)").when(n <= 10, "Medium users (4-10)").otherwise("Heavy users (>10)")
    )


def activity_slices(recs: DataFrame, truth: DataFrame, models: list[str], user_sizes: DataFrame, k: int) -> DataFrame:
    """Recall and NDCG by model and user-activity bucket."""
    per_user = user_accuracy(recs, truth, models, k).join(user_sizes, "user_id", "left")
    return _slice(per_user.withColumn("slice", activity_bucket(F.col("n_rows"))), ["model", "slice"])


def cold_item_slice(recs: DataFrame, truth: DataFrame, models: list[str], item_counts: DataFrame, k: int) -> DataFrame:
    """Recall and NDCG by model over users whose true item is not in train."""
    cold = truth.join(item_counts.select("item_id"), "item_id", "left_anti")
    return _slice(user_accuracy(recs, cold, models, k), ["model"])


def _slice(per_user: DataFrame, keys: list[str]) -> DataFrame:
    return per_user.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("users"), F.avg("recall").alias("recall"), F.avg("ndcg").alias("ndcg")
    )
