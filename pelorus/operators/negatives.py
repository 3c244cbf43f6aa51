"""Negative sampling: for each positive pair, one item the user has not seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import portable_hash
from ..models.base import TrainSet
from ..session import durable

# Hash multipliers: fixed values, all prime.
_USER, _ITEM, _EPOCH, _ATTEMPT = 7919, 104729, 15485863, 179424673
_MODULUS = 1 << 31


def draws(pairs: DataFrame, n: int, epoch: int, first: int, attempts: int) -> DataFrame:
    """``pairs`` with ``(attempt, idx)``: hash draws from 0..n-1 per pair, for the attempts ``first .. attempts - 1``."""
    part = F.pmod("user_id", F.lit(_MODULUS)) * _USER + F.pmod("item_id", F.lit(_MODULUS)) * _ITEM
    key = F.pmod(part, F.lit(_MODULUS)) + F.lit(epoch * _EPOCH % _MODULUS) + F.col("attempt") * F.lit(_ATTEMPT)
    tried = pairs.select("*", F.explode(F.sequence(F.lit(first), F.lit(attempts - 1))).alias("attempt"))
    return tried.withColumn("idx", F.pmod(portable_hash(key.cast("long")), F.lit(n)))


def _unseen_draws(pairs: DataFrame, history: DataFrame, index: DataFrame, n: int, epoch: int, first: int, attempts: int) -> DataFrame:
    tried = draws(pairs, n, epoch, first, attempts).join(index.select("idx", F.col("item_id").alias("negative")), "idx")
    seen = history.select("user_id", F.col("item_id").alias("negative"))
    unseen = tried.join(seen, ["user_id", "negative"], "left_anti")
    best = unseen.groupBy("user_id", "item_id").agg(F.first("m").alias("m"), F.min_by("negative", "attempt").alias("negative"))
    return best.select("user_id", "item_id", "negative", "m")


def sampled_negatives(pairs: DataFrame, history: DataFrame, index: DataFrame, n: int, epoch: int, attempts: int) -> DataFrame:
    """``(user_id, item_id, negative, m)``: the first draw outside the history; pairs without one are left out.

    All pairs draw once; only those that hit the history draw on. The history is anti-joined on (user, drawn item), which
    spreads hot users.
    """
    once = durable(_unseen_draws(pairs, history, index, n, epoch, 0, 1))
    if attempts == 1:
        return once
    missed = pairs.join(once, ["user_id", "item_id"], "left_anti")
    return once.unionByName(_unseen_draws(missed, history, index, n, epoch, 1, attempts))


def chosen_unseen(pairs: DataFrame, history: DataFrame, index: DataFrame, n: int, epoch: int) -> DataFrame:
    """``(user_id, item_id, negative, m)``: for every pair one of **all** items its user has not seen, by rank.

    With a user's seen places in order, the place minus the number of seen ones before it counts the unseen items before; the
    r-th unseen item follows from a running count over seen places and asked ranks together.
    """
    places = history.join(index, "item_id").select("user_id", "idx")
    free = places.groupBy("user_id").agg((F.lit(n) - F.count(F.lit(1))).alias("free"))
    asked = pairs.join(free.filter("free > 0"), "user_id").withColumn(
        "at", F.pmod(F.xxhash64("user_id", "item_id", F.lit(epoch)), F.col("free"))
    )
    before = F.col("idx") - (F.row_number().over(Window.partitionBy("user_id").orderBy("idx")) - 1)
    seen = places.select("user_id", before.alias("at"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("item_id"), F.lit(0).cast("long").alias("m"))
    both = seen.unionByName(asked.select("user_id", "at", F.lit(1).alias("kind"), "item_id", F.col("m").cast("long").alias("m")))
    running = Window.partitionBy("user_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = both.withColumn("idx", F.col("at") + F.sum(F.lit(1) - F.col("kind")).over(running)).filter("kind = 1")
    named = ranked.join(index.select("idx", F.col("item_id").alias("negative")), "idx")
    return named.select("user_id", "item_id", "negative", "m")


def negatives(train: TrainSet, index: DataFrame, epoch: int, attempts: int = 4) -> DataFrame:
    """One negative for every positive pair whose user has any unseen item.

    Pairs whose draws all hit the history (users who know most of the catalog) choose among all of their user's unseen items.
    """
    pairs = train.pairs
    first = durable(sampled_negatives(pairs, train.history, index, train.n_items, epoch, attempts))
    missed = pairs.join(first, ["user_id", "item_id"], "left_anti")
    if missed.isEmpty():
        return first
    users = missed.select("user_id").distinct()
    rest = chosen_unseen(missed, train.history.join(users, "user_id", "left_semi"), index, train.n_items, epoch)
    return first.unionByName(rest.select(first.columns))
