import inspect
from types import SimpleNamespace

from pelorus.metrics.accuracy import true_rows
from pelorus.metrics.candidates import candidate_hits
from pelorus.models.factors import _with_block, sgd_round
from pelorus.plans.workbench import Workbench


def test_merged_partitions_and_scans_stay_small(spark, tmp_path):
    """A task's rows do not grow with the tables: neither merged shuffle partitions nor scans exceed a few MB."""
    session = spark.newSession()
    Workbench(session, str(tmp_path))
    for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        assert session.conf.get(key) == "4m"


def test_blocks_of_a_training_step_are_small(spark):
    """A task of a step holds the factor rows of one block as Python objects."""
    rows = spark.range(10).selectExpr("id AS user_id", "id AS item_id")
    train = SimpleNamespace(spark=spark, n_rows=6_000_000, max_rows=50)
    _, blocks = _with_block(rows, train, inspect.signature(sgd_round).parameters["rows_per_block"].default)
    assert 6_000_000 / blocks <= 65_536


def test_only_true_rows_of_the_lists_are_grouped(spark):
    recs = spark.createDataFrame([("a", 1, 10, 1), ("a", 1, 11, 2), ("b", 1, 11, 5), ("b", 2, 10, 1), ("b", 2, 10, 2)], "model string, user_id long, item_id long, rank int")
    truth = spark.createDataFrame([(1, 11), (1, 11), (2, 10), (3, 10)], "user_id long, item_id long")
    kept = sorted(tuple(r) for r in true_rows(recs, truth, 4).select("model", "user_id", "item_id", "rank").collect())
    assert kept == [("a", 1, 11, 2), ("b", 2, 10, 1), ("b", 2, 10, 2)]
    hits = candidate_hits(recs, truth, ["a", "b"], 4).collect()
    assert sorted(tuple(r) for r in hits) == [("a", 1, 1), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0), ("b", 2, 1), ("b", 3, 0)]
