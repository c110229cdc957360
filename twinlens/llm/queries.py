"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinlens.llm import (conversation_repair, decontaminate_bm25, embedding_cover_tree, mixing_es, pii_boosting,
                          quality_bradley_terry, quality_divergence, secrets_cnn, simhash_vptree, suffix_dedup,
                          token_alignment, url_redirects, warc_derivatives)
from twinlens.llm import oracles

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc_derivatives.responses(_table(spark, sf_dir, "pages"))
    return warc_derivatives.derive(responses).select(
        *[c.split()[0] for c in warc_derivatives.DERIVED.split(", ") if not c.startswith("block ")],
        F.when(F.col("record_type") == "conversion", F.col("block").cast("string")).alias("text"))


def op2_quality_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bradley_terry.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_url_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_redirects.judge(_table(spark, sf_dir, "pages"))


def op4_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_divergence.judge(_table(spark, sf_dir, "documents"), ["doc_id"], whole=True)
    return out.select("row.*", "*").drop("row").withColumns({c: F.round(c, 9) for c in (
        "class_distance", "word_distance", "listed_distance", "listed_reach")})


def op6_secrets_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_cnn.report(_table(spark, sf_dir, "documents"))


def op7_mixing_es(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_es.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf_dir, "documents"))


def op9_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boosting.report(_table(spark, sf_dir, "documents"))


def op10_decontaminate_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate_bm25.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignments(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(_table(spark, sf_dir, "conversations"))


def op13_embedding_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_cover_tree.near_duplicates(_table(spark, sf_dir, "embeddings"))


_QUERIES = [op1_warc_derivatives, op2_quality_bradley_terry, op3_url_redirects, op4_simhash_vptree,
            op5_quality_divergence, op6_secrets_cnn, op7_mixing_es, op8_suffix_dedup, op9_pii_boosting,
            op10_decontaminate_bm25, op11_token_alignment, op12_conversation_repair, op13_embedding_cover_tree]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
