"""Global order without a single-task sort: dense indexes and exact quantiles."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable


def _in_order(df: DataFrame, *order: Column) -> DataFrame:
    """Rows range-partitioned and sorted in ``order`` (which must be total), with their place as ``(_part, _place)``.

    The table is written out, so the places are fixed for every later reader.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The generated id is the partition number in the upper 31 bits and the row's position in the lower 33.
    number = F.monotonically_increasing_id()
    fixed = durable(spread.withColumn("_number", number))
    return fixed.select(
        *df.columns, F.shiftright("_number", 33).alias("_part"), F.col("_number").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")
    )


def global_index(df: DataFrame, *order: Column, name: str = "idx") -> DataFrame:
    """Number the rows 0..n-1 in ``order``, which must be total: position in the partition plus the partition's offset."""
    placed = _in_order(df, *order)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    # At most one offset per shuffle partition.
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_offset") + F.col("_place")).alias(name))


def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles of one numeric column as rows ``(p, value)``."""
    return column_quantiles(df, [column], probs).select("p", "value")


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles of numeric columns as rows ``(column, p, value)``, with one range sort for all columns.

    Works on the value histograms (map-side combined, so a value with a third of all rows is one row) in global order.
    The driver sees one row count per partition and column and picks the partitions the quantiles fall in; only those are read.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    values = df.select(F.explode(pairs).alias("x")).select("x.column", "x.v").filter(F.col("v").isNotNull())
    placed = _in_order(values.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n")), F.asc("column"), F.asc("v"))
    sizes = sorted(tuple(r) for r in placed.groupBy("column", "_part").agg(F.sum("n")).collect())
    asked = []
    for column in dict.fromkeys(columns):
        mine = [(part, n) for c, part, n in sizes if c == column]
        total = sum(n for _, n in mine)
        for p in probs if total else []:
            at = (total - 1) * float(p)
            for position in {floor(at), ceil(at)}:
                before = 0
                for part, n in mine:
                    if position < before + n:
                        asked.append((column, float(p), at - floor(at), position, part, position - before))
                        break
                    before += n
    names = ("column", "p", "frac", "position", "part", "local")
    rows = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(row, names, strict=True)]) for row in asked])
    if not asked:
        return values.select("column", F.lit(0.0).alias("p"), F.col("v").alias("value")).limit(0)
    upto = F.sum("n").over(Window.partitionBy("column", "_part").orderBy("_place"))
    near = placed.filter(F.col("_part").isin(sorted({row[4] for row in asked}))).withColumn("end", upto)
    hit = near.withColumn("a", F.explode(rows)).filter(
        (F.col("a.column") == F.col("column")) & (F.col("a.part") == F.col("_part"))
        & (F.col("end") > F.col("a.local")) & (F.col("end") - F.col("n") <= F.col("a.local"))
    )
    low, high = F.min_by("v", "a.position"), F.max_by("v", "a.position")
    return hit.groupBy("a.column", "a.p").agg((low + (high - low) * F.first("a.frac")).alias("value"))
