import pytest
from pyspark.sql import functions as F

from pelorus.models.base import TrainSet
from pelorus.operators import prepare, split


def frame(spark, rows):
    df = spark.createDataFrame(rows, "user_id long, item_id long, day string")
    return df.select("user_id", "item_id", F.to_timestamp_ntz(F.col("day"), F.lit("yyyy-MM-dd")).alias("date_time"))


BASIC = [(u, 10 * u + i, f"2020-01-0{i}") for u in (1, 2, 3) for i in (1, 2, 3)]


def test_last_row_is_test(spark, rows_of):
    train, test = split.leave_last_out(frame(spark, BASIC))
    assert rows_of(test, "user_id", "item_id") == [(1, 13), (2, 23), (3, 33)]
    assert train.count() == 6
    assert split.leakage_violations(train, test).first().asDict() == {"test_users": 3, "violations": 0}


def test_tied_users_are_dropped_or_ordered(spark, rows_of):
    tied = frame(spark, [*BASIC, (4, 1, "2020-01-01"), (4, 2, "2020-01-02"), (4, 3, "2020-01-02")])
    train, test = split.leave_last_out(tied)
    assert 4 not in {r[0] for r in rows_of(train, "user_id")} | {r[0] for r in rows_of(test, "user_id")}
    assert rows_of(split.tied_last_users(tied), "user_id", "n_tied") == [(4, 2)]
    train, test = split.leave_last_out(tied, drop_tied_last=False)
    assert (4, 3) in rows_of(test, "user_id", "item_id")
    assert [r for r in rows_of(train, "user_id", "item_id") if r[0] == 4] == [(4, 1), (4, 2)]


def test_identical_last_rows_keep_all_copies(spark, rows_of):
    same = frame(spark, [(1, 1, "2020-01-01"), (1, 2, "2020-01-02"), (1, 2, "2020-01-02"), (1, 2, "2020-01-02")])
    train, test = split.leave_last_out(same, drop_tied_last=False)
    assert rows_of(test, "item_id") == [(2,)]
    assert rows_of(train, "item_id") == [(1,), (2,), (2,)]


def test_one_row_user_and_null_time(spark, rows_of):
    train, test = split.leave_last_out(frame(spark, [(1, 5, "2020-01-01"), (2, 6, None), (2, 7, "2020-01-01")]))
    assert train.count() == 0
    assert rows_of(test, "user_id", "item_id") == [(1, 5), (2, 7)]


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="item_id"):
        split.leave_last_out(spark.range(1).selectExpr("id AS user_id", "current_timestamp() AS date_time"))
    with pytest.raises(ValueError, match="user_id"):
        TrainSet(spark.range(1).selectExpr("id AS item_id"))


def test_prepare(spark, rows_of):
    log = spark.createDataFrame([(1, 1, 4.0), (1, 2, 5.0), (2, 1, 5.0), (3, 1, 3.0), (3, 9, None)], "user_id long, item_id long, rating double")
    assert rows_of(prepare.active_users(prepare.positives(log)), "user_id", "item_id") == [(1, 1), (1, 2)]
    items = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "item_id long, name string")
    assert rows_of(prepare.with_item_names(items), "item_id", "name") == [(1, "a"), (2, "Unknown Recipe")]
    assert rows_of(prepare.top_items(log, 1), "item_id", "n_rows") == [(1, 3)]
    bad = spark.createDataFrame([("2020-01-01",), ("soon",)], "date string")
    assert [r[0] is None for r in prepare.coerce_timestamp(bad, "date").orderBy("date").collect()] == [True, False]


def test_a_written_split_joins_the_last_times_once(spark, monkeypatch):
    """Both parts read one table: their plans hold no join, and the rows are those of the plain split."""
    rows = [(1, 10, "2020-01-01"), (1, 11, "2020-01-02"), (2, 10, "2020-01-01"), (2, 12, "2020-01-01"), (3, 13, "2020-01-05")]
    rows += [(None, 1, "2020-01-01"), (4, 1, None), (1, 10, "2020-01-01")]
    log = frame(spark, rows)
    for drop in (True, False):
        plain = split.leave_last_out(log, drop_tied_last=drop)
        kept = split.leave_last_out(log, drop_tied_last=drop, written=True)
        for a, b in zip(plain, kept, strict=True):
            assert b.columns == a.columns and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
            assert "Join" not in b._jdf.queryExecution().executedPlan().toString()
