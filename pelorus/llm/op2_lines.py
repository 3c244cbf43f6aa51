"""Line dedup by distinct-site spread.

Every non-blank line is keyed by 128 bits of hash. HyperLogLog sketches of the sites are built per key on the map side and merged
by the aggregation, so a line that is in a third of all documents arrives as one sketch per task. A line is cross-site
boilerplate from ``min_sites`` distinct sites on: estimates clearly beyond decide, estimates within the sketch's error
margin of the threshold are settled by exact distinct counts of those lines only. Boilerplate lines are removed from every document but the
first that has them (smallest document id, then position), so no text vanishes from the corpus.

Edge cases: a null text has no lines; blank lines are never boilerplate; a null site counts as one site of its own; rows that
are equal in id, site and text are treated alike; null ids come last when the first place is chosen. Columns beyond the named ones
are carried along, whatever their names. Only SQL functions are used.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

_LG_K = 12
# Five standard errors of a sketch with 2^12 registers.
_ERROR = 5 * 1.04 / 2 ** (_LG_K / 2)


def _row_key(id_col: str, text_col: str, site_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [
        F.col(id_col).alias("_id"),
        F.xxhash64(text, F.col(site_col)).alias("_h"),
    ]


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``_id, _h, _site, _pos, _k1, _k2``: the non-blank lines of every document, hashed."""
    rows = docs.select(
        *_row_key(id_col, text_col, site_col),
        F.coalesce(F.concat(F.lit("s"), F.col(site_col).cast("string")), F.lit("")).alias("_site"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("_pos", "_line"),
    ).filter(F.length(F.trim("_line")) > 0)
    return rows.select("_id", "_h", "_site", "_pos", F.xxhash64("_line").alias("_k1"), F.xxhash64(F.lit(1), "_line").alias("_k2"))


def boilerplate(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``(_k1, _k2)`` of the lines that are on at least ``min_sites`` sites."""
    lines = _lines(docs, id_col, text_col, site_col)
    margin = ceil(min_sites * _ERROR)
    spread = lines.groupBy("_k1", "_k2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(_LG_K))).alias("sites"))
    spread = durable(spread.filter(F.col("sites") >= min_sites - margin))
    sure = spread.filter(F.col("sites") > min_sites + margin).select("_k1", "_k2")
    near = spread.filter(F.col("sites") <= min_sites + margin).select("_k1", "_k2")
    exact = lines.join(near, ["_k1", "_k2"]).groupBy("_k1", "_k2", "_site").agg(F.lit(1).alias("one"))
    exact = exact.groupBy("_k1", "_k2").agg(F.count("*").alias("sites")).filter(F.col("sites") >= min_sites)
    return durable(sure.unionByName(exact.select("_k1", "_k2")))


def removals(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``(_id, _h, _removed)``: positions of the lines to remove, for documents that lose any."""
    keys = boilerplate(docs, min_sites, id_col, text_col, site_col)
    hits = durable(_lines(docs, id_col, text_col, site_col).join(keys, ["_k1", "_k2"]).select("_k1", "_k2", "_id", "_h", "_pos"))
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_h").alias("h"), F.col("_pos").alias("pos"))
    first = hits.groupBy("_k1", "_k2").agg(F.min(place).alias("first"))
    later = hits.join(durable(first), ["_k1", "_k2"]).filter(place != F.col("first"))
    return durable(later.groupBy("_id", "_h").agg(F.collect_set("_pos").alias("_removed")))


def cut_lines(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_lines``, ``n_removed`` and ``kept``, the text without its removed lines."""
    gone = removals(docs, min_sites, id_col, text_col, site_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col(text_col).alias("_text"), *_row_key(id_col, text_col, site_col))
    # Removals grow with the documents: the same sort-merge join at every size, never a broadcast.
    gone = gone.hint("merge")
    joined = keyed.join(gone.withColumnRenamed("_id", "_gid").withColumnRenamed("_h", "_gh"), F.col("_h").eqNullSafe(F.col("_gh")) & F.col("_id").eqNullSafe(F.col("_gid")), "left")
    parts = F.split(F.coalesce("_text", F.lit("")), "\n")
    # Every position once with its fate, in order: linear in the lines up to the sort, however many of them go.
    places = F.sequence(F.lit(0), F.size(parts) - 1)
    stays = F.transform(F.array_except(places, F.col("_removed")), lambda i: F.struct(i.alias("i"), F.lit(True).alias("stays")))
    goes = F.transform("_removed", lambda i: F.struct(i.alias("i"), F.lit(False).alias("stays")))
    fates = F.array_sort(F.concat(stays, goes))
    lined = F.zip_with(parts, fates, lambda line, fate: F.struct(line.alias("line"), fate["stays"].alias("stays")))
    kept = F.array_join(F.transform(F.filter(lined, lambda x: x["stays"]), lambda x: x["line"]), "\n")
    return joined.select(
        "row",
        F.when(F.col("_text").isNull() | (F.col("_text") == ""), F.lit(0)).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(kept).alias("kept"),
    )


def report(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` per document."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(site_col).alias("site"))
    cut = cut_lines(narrow, min_sites, "id", "text", "site")
    digest = F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")
    return cut.select(F.col("row.id").alias(id_col), "n_lines", "n_removed", digest)


def without_boilerplate(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``docs`` with the same columns and rows, boilerplate lines cut from the text."""
    cut = cut_lines(docs, min_sites, id_col, text_col, site_col)
    return cut.select(*[(F.col("kept") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


SQL = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL
), spread AS (
  SELECT line FROM lines WHERE length(trim(line)) > 0 GROUP BY line
  HAVING count(DISTINCT coalesce('s' || source, '')) >= 10
), first_place AS (
  SELECT line, min(struct_pack(d := doc_id, p := pos)) AS place FROM lines SEMI JOIN spread USING (line) GROUP BY line
), marked AS (
  SELECT l.doc_id, l.line, l.pos,
         f.line IS NOT NULL AND struct_pack(d := l.doc_id, p := l.pos) <> f.place AS gone
  FROM lines l LEFT JOIN first_place f USING (line)
), cut AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE c.n_lines END AS n_lines,
       coalesce(c.n_removed, 0) AS n_removed, sha256(coalesce(c.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cut c USING (doc_id)
"""
