"""Descriptive statistics of the interaction log and the item table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import column_quantiles, exact_quantiles

QUANTILES = (0.5, 0.75, 0.9, 0.95, 0.99)


def basic_stats(interactions: DataFrame) -> DataFrame:
    """Rows, users, items, sparsity and the time range.

    Users and items are counted over their own grouped tables rather than by two distinct counts in one aggregate,
    which would copy every row once per distinct count.
    """
    users = interactions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("date_time").alias("lo"), F.max("date_time").alias("hi")
    )
    n_items = interactions.select("item_id").distinct().agg(F.count("item_id")).scalar()
    out = users.agg(
        F.sum("n").alias("interactions"),
        F.count("user_id").alias("users"),
        F.min("lo").alias("min_date"),
        F.max("hi").alias("max_date"),
    ).withColumn("items", n_items)
    sparsity = 1 - F.col("interactions") / (F.col("users").cast("double") * F.col("items"))
    return out.select("interactions", "users", "items", sparsity.alias("sparsity"), "min_date", "max_date")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(column, n)``; order by n descending and by the value for a ranking, by the value for a distribution."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def activity_counts(interactions: DataFrame) -> DataFrame:
    """Users and items with exactly one row, users with at least two, with their shares."""

    def side(key: str, name: str) -> DataFrame:
        n = value_counts(interactions, key)
        return n.agg(
            F.count(F.lit(1)).alias("total"),
            F.sum((F.col("n") == 1).cast("long")).alias("single"),
            F.sum((F.col("n") >= 2).cast("long")).alias("several"),
        ).select(
            F.lit(name).alias("side"),
            "total",
            "single",
            (F.col("single") / F.col("total")).alias("single_share"),
            "several",
            (F.col("several") / F.col("total")).alias("several_share"),
        )

    return side("user_id", "users").unionByName(side("item_id", "items"))


def activity_quantiles(interactions: DataFrame, key: str, probs: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Exact quantiles of the rows per key, as ``(p, value)``.

    ``percentile`` runs over the histogram of counts: distinct counts number at most sqrt(2 · rows).
    """
    hist = value_counts(interactions, key).groupBy("n").agg(F.count(F.lit(1)).alias("freq"))
    grid = F.array(*[F.lit(float(p)) for p in probs])
    values = hist.agg(F.percentile("n", grid, F.col("freq")).alias("v"))
    return values.select(F.explode(F.arrays_zip(grid.alias("p"), F.col("v").alias("value"))).alias("z")).select(
        F.col("z.p").alias("p"), F.col("z.value").alias("value")
    )


def missing_counts(df: DataFrame) -> DataFrame:
    """Nulls and their share per column, as ``(column, missing, rate)``, in one pass."""
    sums = [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *sums)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns])
    return one.select("_rows", F.explode(rows).alias("r")).select(
        "r.column", "r.missing", (F.col("r.missing") / F.col("_rows")).alias("rate")
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, min, exact quartiles, max, one row per column: one aggregate, and one range sort for the
    quartiles, whatever the number of columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    values = df.select(F.explode(pairs).alias("x")).select("x.column", "x.v")
    base = values.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    named = ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    q = column_quantiles(df, columns, [p for p, _ in named])
    q = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in named])
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    # One row per column.
    joined = names.join(F.broadcast(base), "column", "left").join(F.broadcast(q), "column", "left")
    return joined.select("column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def distribution_summary(df: DataFrame, column: str) -> DataFrame:
    """Mean, median and 95th percentile of one measurement column."""
    q = exact_quantiles(df, column, [0.5, 0.95])
    q = q.agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in ((0.5, "median"), (0.95, "p95"))])
    mean = df.agg(F.avg(F.col(column).cast("double")).alias("mean"))
    return mean.select("mean", q.select("median").scalar().alias("median"), q.select("p95").scalar().alias("p95"))


def histogram(df: DataFrame, column: str, bins: int, upper: float | None = None) -> DataFrame:
    """Equal-width bins 0..bins-1 with counts, the last one closed on the right; empty bins are left out.

    ``upper`` clips values first.
    """
    v = F.col(column).cast("double")
    if upper is not None:
        v = F.least(v, F.lit(float(upper)))
    values = df.filter(F.col(column).isNotNull()).select(v.alias("v"))
    low, high = values.agg(F.min("v")).scalar(), values.agg(F.max("v")).scalar()
    at = F.floor((F.col("v") - low) * bins / (high - low))
    # Equal bounds: a width of one around the value puts everything in the middle bin.
    bin_ = F.when(high == low, F.lit(bins // 2).cast("long")).otherwise(F.least(at, F.lit(bins - 1).cast("long")))
    return values.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def rule_summary(interactions: DataFrame, thresholds: tuple[float, ...] = (4.0, 5.0)) -> DataFrame:
    """Rows, users, items, users with two or more rows and single-row items, per rating threshold."""
    rows = interactions.filter(F.col("rating") >= min(thresholds))
    rule = F.explode(F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: F.col("rating") >= t))

    def side(key: str) -> DataFrame:
        return rows.select(key, rule.alias("threshold")).groupBy("threshold", key).agg(F.count(F.lit(1)).alias("n"))

    users = side("user_id").groupBy("threshold").agg(
        F.sum("n").alias("interactions"),
        F.count(F.lit(1)).alias("users"),
        F.sum((F.col("n") >= 2).cast("long")).alias("users_with_2plus"),
    )
    items = side("item_id").groupBy("threshold").agg(
        F.count(F.lit(1)).alias("items"), F.sum((F.col("n") == 1).cast("long")).alias("cold_items")
    )
    return users.join(items, "threshold").select(
        "threshold", "interactions", "users", "items", "users_with_2plus", "cold_items"
    )


def join_coverage(interactions: DataFrame, items: DataFrame, key: str = "item_id") -> DataFrame:
    """Ids on both sides, ids only in the log, ids only in the item table."""
    left = interactions.select(key).distinct().withColumn("in_log", F.lit(1))
    right = items.select(key).distinct().withColumn("in_items", F.lit(1))
    both = left.join(right, key, "full_outer")
    log, meta = F.col("in_log").isNotNull(), F.col("in_items").isNotNull()
    return both.agg(
        F.coalesce(F.sum((log & meta).cast("long")), F.lit(0)).alias("matched"),
        F.coalesce(F.sum((log & ~meta).cast("long")), F.lit(0)).alias("missing_in_items"),
        F.coalesce(F.sum((~log & meta).cast("long")), F.lit(0)).alias("never_used"),
    )


def duplicate_counts(df: DataFrame, keys: tuple[str, ...] = ("user_id", "item_id")) -> DataFrame:
    """Rows beyond the first per key, and beyond the first per full row.

    Full rows are counted first; keys are counted over that smaller table.
    """
    full = df.groupBy(df.columns).agg(F.count(F.lit(1)).alias("_n"))
    by_key = full.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_distinct"))
    return by_key.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_pairs"),
        F.coalesce(F.sum(F.col("_n") - F.col("_distinct")), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_rows(df: DataFrame, keys: tuple[str, ...] = ("user_id", "item_id")) -> DataFrame:
    """All rows whose key occurs more than once."""
    several = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return df.join(several, list(keys), "left_semi")


def cold_items(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test items that never occur in train."""
    return test.select("item_id").distinct().join(train.select("item_id"), "item_id", "left_anti")


def test_user_warmth(item_counts: DataFrame, test: DataFrame) -> DataFrame:
    """Each test user with whether the true item is known from train."""
    known = item_counts.select("item_id", F.lit(True).alias("warm"))
    return test.select("user_id", "item_id").join(known, "item_id", "left").select(
        "user_id", "item_id", F.coalesce("warm", F.lit(False)).alias("warm")
    )


def sparse_users(train: DataFrame, max_interactions: int = 5) -> DataFrame:
    return value_counts(train, "user_id").filter(F.col("n") <= max_interactions)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same ones on every run: smallest portable hashes first."""
    from ..functions.numeric import portable_hash

    return df.orderBy(portable_hash(F.col(key), seed), F.col(key)).limit(n)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)
