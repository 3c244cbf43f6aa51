"""Ranked lists for all users at once: top-k, seen-item removal, first unseen positions, popularity fill.

A ranked list is a long table ``(user_id, item_id, rank, score)``; rank starts at 1 and follows score descending, then
item id ascending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .order import global_index

# Up to this many seen positions per user are held in one array (400 KB); users beyond take the distributed path.
SEEN_LIMIT = 50_000

_BLOCK = 4096


def top_k(df: DataFrame, k: int, order: list[Column], group: list[str] | None = None, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group. Spark cuts every map task to k rows per group before the shuffle."""
    window = Window.partitionBy(*(group or ["user_id"])).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def rank_by_score(scored: DataFrame, k: int) -> DataFrame:
    """Scores rounded to 10 decimals, then the k best per user, ties by item id."""
    rounded = scored.withColumn("score", F.round(F.col("score").cast("double"), 10))
    return top_k(rounded, k, [F.desc("score"), F.asc("item_id")]).select("user_id", "item_id", "rank", "score")


def drop_seen(df: DataFrame, history: DataFrame) -> DataFrame:
    """Remove (user, item) pairs in the history; the composite key spreads hot users and hot items."""
    return df.join(history.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def free_positions(
    users: DataFrame,
    seen: DataFrame,
    k: int,
    n: int,
    max_seen: int,
    all_seen: DataFrame | None = None,
    limit: int = SEEN_LIMIT,
) -> DataFrame:
    """The first ``k`` positions of 1..n not taken, per user: ``(user_id, rank, pos)``.

    ``seen (user_id, pos)`` must hold at least all taken positions up to ``k + min(max_seen, limit)``. A user with s
    taken positions among them finds k free ones within the first k + s, so one array per user is enough while s is
    bounded. Users with more than ``limit`` taken positions are finished by :func:`_free_positions_spread`, for which
    ``all_seen`` gives every taken position.
    """
    depth = min(n, k + min(max_seen, limit))
    # Each user row becomes k rows below, so partitions are not merged by the bytes of their users.
    context = users.sparkSession.sparkContext
    parts = max(int(users.sparkSession.conf.get("spark.sql.shuffle.partitions")), context.defaultParallelism)
    users = users.select("user_id").repartition(parts, "user_id")
    none = F.array().cast("array<bigint>")
    near = seen.filter(F.col("pos") <= depth).groupBy("user_id").agg(F.collect_set("pos").alias("taken"))
    state = users.join(near, "user_id", "left").withColumn("taken", F.coalesce("taken", none))
    reach = F.least(F.lit(depth).cast("long"), F.size("taken") + F.lit(k))
    reachable = F.when(reach > 0, F.sequence(F.lit(1).cast("long"), reach)).otherwise(none)
    state = state.select("user_id", F.slice(F.array_except(reachable, F.col("taken")), 1, k).alias("free"))
    done = state if max_seen <= limit else state.filter(F.size("free") >= min(k, n))
    out = done.select("user_id", F.posexplode("free").alias("p", "pos")).select(
        "user_id", (F.col("p") + 1).alias("rank"), "pos"
    )
    if max_seen <= limit:
        return out
    heavy = state.filter(F.size("free") < min(k, n)).select("user_id")
    return out.unionByName(_free_positions_spread(heavy, all_seen, k, n))


def _free_positions_spread(heavy: DataFrame, seen: DataFrame, k: int, n: int) -> DataFrame:
    """``free_positions`` for users whose taken positions fit no array.

    Taken positions are counted per (user, block of 4096 positions); only the blocks in which the first k free
    positions lie (at most k, each with a free one) are expanded and anti-joined on (user, position).
    """
    heavy = durable(heavy)
    taken = seen.join(heavy, "user_id", "left_semi").distinct()
    taken = durable(taken.withColumn("block", F.floor((F.col("pos") - 1) / _BLOCK)))
    full = taken.groupBy("user_id", "block").agg(F.count(F.lit(1)).alias("n_taken"))
    last = (n - 1) // _BLOCK
    grid = heavy.select("user_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("block"))
    start = F.col("block") * _BLOCK + 1
    end = F.least((F.col("block") + 1) * _BLOCK, F.lit(n))
    grid = grid.join(full, ["user_id", "block"], "left").withColumn(
        "n_free", end - start + 1 - F.coalesce("n_taken", F.lit(0))
    )
    before = F.sum("n_free").over(
        Window.partitionBy("user_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    needed = grid.filter("n_free > 0").withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < k)
    open_ = needed.select("user_id", F.explode(F.sequence(start, end)).alias("pos")).join(
        taken.select("user_id", "pos"), ["user_id", "pos"], "left_anti"
    )
    return top_k(open_, k, [F.asc("pos")]).select("user_id", "rank", "pos")


def unseen_in_order(
    order: DataFrame,
    order_by: list[Column],
    n: int,
    users: DataFrame,
    history: DataFrame,
    k: int,
    max_history: int,
    limit: int = SEEN_LIMIT,
) -> DataFrame:
    """The first ``k`` unseen items of one global order, per user: ``(user_id, rank, *order)``.

    ``order`` has one row per item. Only its first ``k + min(max_history, limit)`` rows matter, except to users who
    have seen more than ``limit`` of them; that bound is also the size bound of the broadcast.
    """
    columns = ["user_id", "rank", *order.columns]
    depth = min(n, k + min(max_history, limit))
    first = order.orderBy(*order_by).limit(depth)
    head = first.withColumn("pos", F.row_number().over(Window.orderBy(*order_by)).cast("long"))
    near = history.join(F.broadcast(head.select("item_id", "pos")), "item_id").select("user_id", "pos")
    if max_history <= limit:
        free = free_positions(users, near, k, n, max_history, limit=limit)
        return free.join(F.broadcast(head), "pos").select(columns)
    full = global_index(order, *order_by).withColumn("pos", F.col("idx") + 1).drop("idx")
    all_seen = history.join(full.select("item_id", "pos"), "item_id").select("user_id", "pos")
    free = free_positions(users, near, k, n, max_history, all_seen, limit)
    # A user on the distributed path may end beyond the head.
    in_head = free.filter(F.col("pos") <= depth).join(F.broadcast(head), "pos")
    beyond = free.filter(F.col("pos") > depth).join(full, "pos")
    return in_head.select(columns).unionByName(beyond.select(columns))


def fill_lists(recs: DataFrame, users: DataFrame, filler: DataFrame, k: int) -> DataFrame:
    """Append ``filler (user_id, item_id, rank)`` to lists shorter than k.

    The filler must not contain items of the list or of the history. A score of null marks filled rows.
    """
    sizes = recs.groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("have"))
    extra = filler.join(sizes, "user_id", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    extra = extra.filter(F.col("have") + F.col("rank") <= k).select(
        "user_id", "item_id", (F.col("have") + F.col("rank")).alias("rank"), F.lit(None).cast("double").alias("score")
    )
    known = recs.join(users, "user_id", "left_semi")
    return known.select("user_id", "item_id", "rank", "score").unionByName(extra)
