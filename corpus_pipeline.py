"""Corpus pipeline: quality rules, near-dedup, decontamination, redaction, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinlens.llm import decontaminate_bm25, mixing_es, pii_boosting, quality_divergence, simhash_vptree
from twinlens.session import materialize

#: No stage but the last is plain SQL (XXH64 fingerprints, trained trees).
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the divergence rules keep, the check against the longer word lists among them."""
    return quality_divergence.judge(docs, docs.columns, whole=True).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the smallest doc_id."""
    return simhash_vptree.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate_bm25.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the text."""
    out = pii_boosting.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in out.columns else out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often and how many words."""
    return mixing_es.mix(docs).where(F.col("taken") > 0)


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("personal data", personal_data),
          ("mixing", mixture)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
