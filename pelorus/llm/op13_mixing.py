"""Mixing sources to target weights: hash-random order within each source, cut at the source's exact budget.

1. Sizes (words) are counted per document and added up per source.
2. Targets share ``share`` of all words by weight. A target stops at ``limit`` times its source's size; the excess is reshared
   by weight among the others until none is above. Each round is one aggregation over the table of sources, and sources
   only ever become full, so rounds end.
3. Documents get a hash-random key, are range-sorted by (source, key), and their sizes are added up: within a partition as the rows
   stream by, across partitions by offsets per (partition, source). A source's budget of whole words is ``floor(target)``:
   every document is taken ``budget // source size`` times, and the remaining words are the first ones in key order, the
   document at the cut giving just its part. Hence the words taken of a source equal its budget.

Ranges are as even as Spark's sample makes them whatever a source's share of the rows, and no task holds more than a batch of
its range. Keys depend on the seed and the id only, so reruns agree.

Edge cases: null texts have size 0 and are taken 0 times; a null source is a source of its own, last in order; an empty table returns
no rows; sources without words have target 0. Rows that repeat an id tie in key and follow each other by size, so equal
rows are interchangeable. Null ids are treated as one more value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import global_index
from ..session import durable
from .common import arrow_schema, tidy

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; null has none."""
    blanks = " \t\n\x0b\x0c\r"
    even = F.translate(F.coalesce(text.cast("string"), F.lit("")), blanks, " " * len(blanks))
    return F.size(F.filter(F.split(even, " "), lambda w: w != "")).cast("long")


def targets(sources: DataFrame, weight: Column, share: float = 1.5, limit: int = 2) -> DataFrame:
    """``sources (source, source_size, ...)`` with ``target``: ``share`` of all words by weight, at most ``limit`` times the size."""
    weighed = durable(sources.withColumn("weight", weight))
    cap = F.col("source_size") * limit
    words = weighed.agg(F.sum("source_size")).first()[0] or 0
    each, state = 0.0, None
    while True:
        # A full source stays full: the share of the others only grows.
        full = cap <= F.col("weight") * F.lit(each)
        taken, left = weighed.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if (taken, left) == state or not left:
            break
        state = taken, left
        each = max(each, (share * words - taken) / left)
    rest, weights = (share * words - state[0], state[1]) if state else (0.0, 1)
    open_target = F.col("weight") * F.lit(float(rest)) / F.lit(float(weights))
    return weighed.withColumn("target", F.when(full, cap.cast("double")).otherwise(open_target))


def _running(ddl: str):
    """Per row the words of its source before it within the partition; rows arrive in order of their sources."""
    schema = arrow_schema(ddl)

    def run(batches):
        tidy()
        part, source, before = TaskContext.get().partitionId(), object(), 0
        for b in batches:
            if not b.num_rows:
                continue
            names, size = b.column(1).to_pylist(), b.column(2).to_numpy()
            ahead = np.cumsum(size) - size
            cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]]]
            if names[0] != source:
                before = 0
            base = np.empty(len(names), "int64")
            for a, z in zip(cuts, [*cuts[1:], len(names)], strict=True):
                base[a:z] = before - ahead[a]
                before = 0
            source, before = names[-1], int(base[-1] + ahead[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(names), part)), pa.array(base + ahead)], schema=schema)

    return run


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: int = 2, seed: str = "0",
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per document; sources weigh ``weights`` in turn, in code point order."""
    kind = dict(docs.dtypes)[id_col]
    # A prefix puts null last and keeps the bytewise order of the others.
    source = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    key = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 16)
    sized = durable(docs.select(F.col(id_col).alias("id"), source.alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = global_index(totals, F.asc("source"), name="place")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    aims = durable(targets(numbered, turn, share, limit).select("source", "source_size", "target"))

    order = ("source", "key", "id", "size")
    ddl = f"id {kind}, source string, size bigint, part bigint, before bigint"
    lined = sized.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "source", "size")
    placed = durable(lined.mapInArrow(_running(ddl), ddl))
    # One row per partition and source in it.
    parts = placed.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = F.sum("words").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("source", "part", F.coalesce(earlier, F.lit(0)).alias("offset")).join(aims, "source")
    joined = placed.join(offsets, ["source", "part"]).withColumn("budget", F.floor("target"))
    whole = F.when(F.col("source_size") > 0, F.expr("budget div greatest(source_size, 1)")).otherwise(0)
    left = F.col("budget") - whole * F.col("source_size") - F.col("offset") - F.col("before")
    taken = whole * F.col("size") + F.least(F.greatest(left, F.lit(0)), F.col("size"))
    return joined.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.cast("long").alias("taken"))


SQL = """
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source)) - 1) % 3 + 1] AS weight FROM sized GROUP BY source
), steps AS (
  -- Full sources come first in order of size by weight; the first step at which no open one is above its limit holds.
  SELECT *, 2 * source_size / weight AS ratio,
    sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source) AS taken, sum(weight) OVER (ORDER BY 2 * source_size / weight, source) AS gone,
    (SELECT sum(weight) FROM sources) AS weights, (SELECT 1.5::DOUBLE * sum(source_size) FROM sources) AS total
  FROM sources
), candidates AS (
  SELECT taken, weights - gone AS open, (total - taken) / (weights - gone) AS each, ratio AS reached, total FROM steps WHERE weights > gone
  UNION ALL SELECT 0, max(weights), max(total) / max(weights), -1, max(total) FROM steps
), chosen AS (
  SELECT taken, open, total, each FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM steps s WHERE s.ratio > c.reached AND s.ratio <= c.each) AND reached <= each ORDER BY taken LIMIT 1
), aims AS (
  SELECT s.source, s.source_size, CASE WHEN s.ratio <= c.each THEN (2 * s.source_size)::DOUBLE
    ELSE s.weight * (c.total - c.taken)::DOUBLE / c.open::DOUBLE END AS target
  FROM steps s, chosen c
), lined AS (
  SELECT d.*, a.source_size, a.target, floor(a.target)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized d JOIN aims a USING (source)
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + least(greatest(budget % source_size - before, 0), size) END)::BIGINT AS taken
FROM lined
"""
