"""Run log rows from a metric table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_rows(macro: DataFrame, dataset: str, k: int, hyperparams: dict[str, str] | None = None, stamp: bool = True) -> DataFrame:
    """One row per model with metrics rounded to 4 decimals; ``stamp`` adds the current time."""
    text = F.lit("")
    for model, value in (hyperparams or {}).items():
        text = F.when(F.col("model") == model, F.lit(value)).otherwise(text)
    columns = [
        F.lit(dataset).alias("dataset"), "model", F.lit(k).alias("k_evaluated"), text.alias("hyperparams"),
        *[F.round(c, 4).alias(c) for c in ("recall", "ndcg", "coverage")],
    ]
    if stamp:
        columns.insert(0, F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    return macro.select(*columns)
