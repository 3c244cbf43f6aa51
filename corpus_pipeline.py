"""The corpus pipeline: stages over ``documents``, each by one operator of ``pelorus.llm``.

A stage gets all rows its predecessor kept and returns the columns of ``documents``; ``n_chars`` follows the text.
The last stage returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelorus.llm import op1_bpe, op2_lines, op3_decontaminate, op4_jaccard, op5_toxicity
from pelorus.llm.common import table
from pelorus.llm.registry import tokenizer_path
from pelorus.session import configure, durable


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = op5_toxicity.train(docs, table(configure(spark), sf_dir, "labels"))
    return op5_toxicity.keep_clean(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site lines stay in the first document that has them."""
    configure(spark)
    return _measured(op2_lines.without_boilerplate(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    configure(spark)
    return op4_jaccard.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out."""
    blocks = op3_decontaminate.phrases(table(configure(spark), sf_dir, "benchmark"))
    return _measured(op3_decontaminate.without_phrases(docs, blocks))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256`` of the remaining texts."""
    configure(spark)
    return op1_bpe.round_trip(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# The learned classifier of the first stage is not expressible in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
