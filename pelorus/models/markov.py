"""First-order sequential model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import global_index
from ..operators.prepare import require_columns
from ..operators.ranking import drop_seen, top_k
from ..session import durable
from .base import TrainSet

# A user with more rows is not windowed but ordered over many partitions.
LONG_HISTORY = 100_000

# Successors ranked per item for users with at most this many seen items, so that each task keeps a bounded prefix.
RANK_DEPTH = 1000


def successors(
    train: DataFrame, max_rows: int, time_col: str = "date_time", tie_cols: tuple[str, ...] = ("item_id",),
    long_history: int = LONG_HISTORY,
) -> DataFrame:
    """``(user_id, item_i, item_j)``: each row's item and the item of the user's next row in time.

    Ordinary users are one window each. The rows of users with more than ``long_history`` of them are numbered in
    global order (range partitions of equal size, however the rows lie in time), and each row is joined with its number's
    successor.
    """
    order = [F.col(time_col), *[F.col(c) for c in tie_cols]]
    rows = train.select("user_id", *dict.fromkeys(["item_id", time_col, *tie_cols])).filter(F.col(time_col).isNotNull())
    following = F.lead("item_id").over(Window.partitionBy("user_id").orderBy(*order))
    linked = rows
    if max_rows > long_history:
        long_users = rows.groupBy("user_id").count().filter(F.col("count") > long_history).select("user_id")
        linked = rows.join(long_users, "user_id", "left_anti")
    linked = linked.withColumn("item_j", following).filter("item_j IS NOT NULL")
    linked = linked.select("user_id", F.col("item_id").alias("item_i"), "item_j")
    if max_rows <= long_history:
        return linked
    placed = durable(global_index(rows.join(long_users, "user_id", "left_semi"), F.col("user_id"), *order, name="_at"))
    after = placed.select(F.col("user_id").alias("_user"), F.col("item_id").alias("item_j"), (F.col("_at") - 1).alias("_at"))
    far = placed.join(after, "_at").filter(F.col("user_id") == F.col("_user"))
    return linked.unionByName(far.select("user_id", F.col("item_id").alias("item_i"), "item_j"))


class Markov:
    """Most frequent successors of the user's last item, then unseen popular items."""

    def __init__(
        self, time_col: str = "date_time", tie_cols: tuple[str, ...] = ("item_id",), long_history: int = LONG_HISTORY,
        rank_depth: int = RANK_DEPTH,
    ):
        self.time_col = time_col
        self.tie_cols = tie_cols
        self.long_history = long_history
        self.rank_depth = rank_depth

    def fit(self, train: TrainSet) -> Markov:
        require_columns(train.train, [self.time_col, *self.tie_cols], "Markov")
        self.train = train
        links = successors(train.train, train.max_rows, self.time_col, self.tie_cols, self.long_history)
        self.counts = durable(links.groupBy("item_i", "item_j").agg(F.count(F.lit(1)).alias("n")))
        return self

    def transitions(self, depth: int) -> DataFrame:
        """``(item_i, item_j, n, rank)``: the ``depth`` most frequent successors of every item."""
        return top_k(self.counts, depth, [F.desc("n"), F.asc("item_j")], ["item_i"])

    def recommend_all(self, users: DataFrame, k: int = 10) -> DataFrame:
        order = F.struct(self.time_col, *self.tie_cols)
        rows = self.train.train.filter(F.col(self.time_col).isNotNull()).join(users, "user_id", "left_semi")
        last = rows.groupBy("user_id").agg(F.max_by("item_id", order).alias("last"))
        last = last.join(self.train.user_sizes.select("user_id", F.col("n_seen").alias("seen")), "user_id")
        # k unseen successors lie within the first k + |history| of the source item.
        depth = min(self.train.max_history, self.rank_depth)
        ranked = self.transitions(k + depth).withColumnRenamed("rank", "place")
        near = last.filter(F.col("seen") <= depth).join(
            ranked, (F.col("last") == F.col("item_i")) & (F.col("place") <= F.col("seen") + k)
        )
        near = near.select("user_id", F.col("item_j").alias("item_id"), "n")
        if self.train.max_history > depth:
            # Users with longer histories (at most rows / rank_depth) read all successors of their one last item.
            far = last.filter(F.col("seen") > depth).join(self.counts, F.col("last") == F.col("item_i"))
            near = near.unionByName(far.select("user_id", F.col("item_j").alias("item_id"), "n"))
        near = near.withColumn("score", F.col("n").cast("double")).drop("n")
        recs = top_k(drop_seen(near, self.train.history), k, [F.desc("score"), F.asc("item_id")])
        recs = recs.select("user_id", "item_id", "rank", "score")
        return self.train.fill_with_popularity(recs, users, k)
