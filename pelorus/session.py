"""Session settings and durable intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits a join partition that one hot key has filled; the group-limit threshold lets top-k
# windows cut each map task to k rows per group before the shuffle.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Sets and lists per key stay hash-aggregated on the map side instead of sorting every row.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Adaptive execution merges small shuffle partitions up to 64 MB, and scans take up to 128 MB of files: rows that, once joined,
# grouped or cut into terms, fill several GB of a task's memory. Both stop at this size, so that it does not grow with the tables.
_SMALL_TASKS = "4m"

# Rows that one task sums, on average, and partitions of one shuffle.
_TASK_ROWS = 1 << 19
_MOST_PARTITIONS = 20_000

_own_folders: dict[str, str] = {}


def small_tasks(spark: SparkSession) -> SparkSession:
    """Keep merged shuffle partitions and scans small, for plans that make many rows of one."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", _SMALL_TASKS)
    spark.conf.set("spark.sql.files.maxPartitionBytes", _SMALL_TASKS)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the plans rely on."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def in_tasks(df: DataFrame, rows: int, *keys: str, task_rows: int = _TASK_ROWS) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys``; beyond the usual number of partitions, there are so many that a task gets
    ``task_rows``, and its memory does not grow with the table."""
    parts = min(ceil(rows / task_rows), _MOST_PARTITIONS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys) if parts > usual else df.repartition(*keys)


def in_cells(df: DataFrame, cell: str, cells: int) -> DataFrame:
    """``df`` dealt by its integer column ``cell`` (0 to ``cells - 1``), one cell to a task: hashed, some tasks would get several and others none.

    Beyond the most partitions of a shuffle, tasks get several anyway.
    """
    return df.repartitionById(cells, cell) if cells <= _MOST_PARTITIONS else df.repartition(_MOST_PARTITIONS, cell)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    A temporary folder stands in only on a ``local`` master, where one machine does everything; on a cluster a missing
    setting is an error, since executors would write to their own disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="pelorus-")
    return _own_folders[app]


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage, survives executor loss, and keeps column pruning and filter pushdown for later readers.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that ``durable`` wrote and nothing will read again, such as the last round's in a loop."""
    path = getattr(table, "_written_to", None)
    if path:
        spark = table.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
