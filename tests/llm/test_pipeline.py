"""The pipeline's stages on a small table, and the registered queries' shapes."""
import re

import numpy as np
import pandas as pd

import __spark_entry__ as se
import corpus_pipeline
from twinlens.llm import decontaminate_bm25, quality_divergence, simhash_vptree

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test-stage")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if k == 1:
            again = simhash_vptree.near_duplicates(docs)
            assert again.where("doc_id <> component_id").count() == 0
        if k == 2:
            assert decontaminate_bm25.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert docs.where("taken <= 0 or taken > 2 * size").count() == 0 < docs.count()


def test_quality_rejects_texts_without_their_languages_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()[["doc_id", "text", "lang"]]
    rng = np.random.default_rng(0)
    prose = docs[docs.text.fillna("").str.split().str.len().between(80, 2000)
                 & ~docs.text.fillna("").str.contains(r"[|!&$%*#]")]
    clean = prose.groupby("lang").head(6)
    assert len(clean) == 24
    # each word's letters drawn anew: the same classes of characters and no common word
    gibberish = clean.assign(doc_id=clean.doc_id + 10**6, text=[
        re.sub(r"[a-z]{2,}", lambda m: "".join(rng.choice(list("bcdfghjklmnpqrtvwxz"), len(m[0]))), t) for t in clean.text])
    turn = {"en": "de", "de": "fr", "fr": "es", "es": "en"}
    foreign = clean.assign(doc_id=clean.doc_id + 2 * 10**6, lang=[turn[x] for x in clean.lang])
    made = spark.createDataFrame(pd.concat([docs, gibberish, foreign]))
    kept = set(corpus_pipeline.quality(spark, made, SF).toPandas().doc_id)
    assert not kept & set(gibberish.doc_id)
    assert not kept & set(foreign.doc_id)
    assert set(clean.doc_id) <= kept
    plain = {r.doc_id for r in quality_divergence.judge(made, ["doc_id"]).where("kept").select("row.doc_id").collect()}
    assert len(plain & set(foreign.doc_id)) > 12  # the short list alone lets them pass
    assert len(kept & set(prose.doc_id)) >= 0.99 * len(plain & set(prose.doc_id))


def test_quality_keeps_languages_with_few_common_words(spark):
    """A reference of which the list holds little gives no ground to reject."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefghij"), 7)) for _ in range(60)), "xx") for i in range(200)]
    assert corpus_pipeline.quality(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), SF).count() > 190


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test-stage")
    assert docs.count() == 0


def test_registered():
    names = [n.split("_")[0] for n in se.queries()]
    assert all(f"op{n}" in names for n in range(1, 11)) and "pipeline" in se.queries()
