from pyspark.sql import functions as F

from pelorus.operators import blocks, boxes, reach


def tasks(lists):
    return {r[0] for r in lists.select(F.spark_partition_id()).distinct().collect()}


def cells(spark, users):
    n = 2 * spark.sparkContext.defaultParallelism
    return users.select(F.pmod(F.xxhash64("user_id"), F.lit(n))).distinct().count()


def test_every_cell_of_users_is_a_task_of_its_own(spark):
    """Dealt by the hash of their number, several cells met in one task while other tasks had none."""
    users = spark.range(400).select(F.col("id").alias("user_id"), (F.col("id") % 3).alias("term_id"), F.lit(1.0).alias("w"))
    items = spark.range(60).select(F.col("id").alias("item_id"), (F.col("id") % 3).alias("term_id"), F.lit(2.0).alias("w"))
    seen = users.select("user_id", F.lit(1).cast("long").alias("item_id"))
    asked = cells(spark, users)
    assert len(tasks(reach.top_k_in_reach(users, items, seen, 2, (400, 60)))) == asked
    assert len(tasks(blocks.sparse_top_k(users, items, seen, 2, 400, 60, 3, (400, 60), sparse_share=1.0))) == asked
    vec = F.array(F.col("w"), F.col("term_id").cast("double")).alias("vec")
    dense = boxes.top_k_in_boxes(users.select("user_id", vec), items.select("item_id", vec), seen, 2, 400, 60, 20)
    assert len(tasks(dense)) == asked
