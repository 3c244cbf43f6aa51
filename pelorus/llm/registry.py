"""The subpackage's registered queries and their SQL, one module per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import op11_hard_negatives, op1_bpe, op2_lines, op3_decontaminate, op4_jaccard, op5_toxicity, op6_roles, op7_url_filter, op8_exact_topk, op9_substrings, op12_merkle, op13_mixing
from .common import table
from .op10_token_files import write_tokens

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_lines.report(table(configure(spark), sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = op3_decontaminate.phrases(table(configure(spark), sf_dir, "benchmark"))
    return op3_decontaminate.report(table(spark, sf_dir, "documents"), blocks)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_jaccard.components_of(table(configure(spark), sf_dir, "documents"))


def op5_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    return op5_toxicity.judge(docs, op5_toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_roles.format_chats(table(configure(spark), sf_dir, "conversations"))


# The rules of the registered query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return op7_url_filter.judge(table(spark, sf_dir, "pages"), op7_url_filter.build(rules))


def op8_exact_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op8_exact_topk.impacts(table(configure(spark), sf_dir, "embeddings"))
    return op8_exact_topk.search(op8_exact_topk.build(rows), rows.filter("vec_id % 20 = 0"), 20)


def op9_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_substrings.report(table(configure(spark), sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_tokens(table(configure(spark), sf_dir, "documents"), tokenizer_path()).documents()


def op11_hard_negatives_mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = op11_hard_negatives.prepare(table(configure(spark), sf_dir, "embeddings"), shifted)
    return op11_hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_merkle.report(table(configure(spark), sf_dir, "documents"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_mixing.mix(table(configure(spark), sf_dir, "documents"))


_QUERIES = (
    op1_bpe_round_trip, op2_line_dedup, op3_decontamination, op4_ngram_jaccard, op5_toxicity_scores, op6_role_repair, op7_url_rules, op8_exact_top20, op9_repeated_substrings, op10_token_files,
    op11_hard_negatives_mined, op12_merkle_manifest, op13_source_mix,
)
_SQL = {"op2_line_dedup": op2_lines.SQL, "op7_url_rules": op7_url_filter.SQL, "op8_exact_top20": op8_exact_topk.SQL, "op11_hard_negatives_mined": op11_hard_negatives.SQL, "op12_merkle_manifest": op12_merkle.SQL, "op13_source_mix": op13_mixing.SQL}


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
