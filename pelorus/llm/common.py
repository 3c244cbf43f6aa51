"""Helpers shared by the operators: reading a table, per-document map jobs, and word caches inside tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder, whole; only Spark's reader touches the path.

    Texts are long: small Arrow batches keep both ends of the Python workers' pipes within their memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str):
    """The text column with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def release() -> None:
    """Collect reference cycles and hand freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(state: dict = {}) -> None:  # noqa: B006  the default lives as long as the task's copy of this function
    """``release`` once per task: a Python worker keeps what earlier tasks left in cycles and in its allocators."""
    if not state:
        state["done"] = True
        release()


def slices(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the text in ``column`` stays near ``max_bytes`` per piece (one row at least)."""
    for batch in batches:
        data = batch.column(column)
        rows = max(1, batch.num_rows)
        step = max(1, int(rows * max_bytes / max(data.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def map_documents(
    docs: DataFrame, id_col: str, text_col: str, make: Callable[[], Callable[[list, list[str]], dict]], ddl: str,
    max_bytes: int = 4 << 20,
) -> DataFrame:
    """Apply a task function to (ids, texts) slices; narrow, so no shuffle and one slice in memory at a time.

    ``make`` runs once per task and returns the function; its result holds the columns of ``ddl`` by name.
    """
    schema = arrow_schema(ddl)

    def run(batches):
        tidy()
        apply = make()
        for part in slices(batches, 1, max_bytes):
            out = apply(part.column(0).to_pylist(), part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return docs.select(F.col(id_col), text_of(text_col)).mapInArrow(run, ddl)
