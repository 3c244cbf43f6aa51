import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest
from pyspark.sql import SparkSession

from pelorus.session import configure


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def skewed(spark):
    """(user, item, day) rows: user 0 holds about a third of them and has seen almost everything; item 0 is in most histories."""
    import random

    rng = random.Random(5)
    rows = [(0, item, 2 * item) for item in range(55)] + [(0, item, 2 * item + 1) for item in range(0, 55, 2)]
    for user in range(1, 25):
        days = rng.sample(range(400), 8)
        mine = [0] + [rng.randrange(60) for _ in range(7)]
        rows += [(user, item, day) for item, day in zip(mine, days, strict=True)]
    frame = spark.createDataFrame(rows, "user_id long, item_id long, day int")
    frame = frame.selectExpr("user_id", "item_id", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, day) AS date_time")
    return rows, frame


@pytest.fixture
def rows_of():
    def collect(df, *columns):
        return sorted(tuple(r) for r in df.select(*columns).collect())

    return collect
