"""No document and no column is lost; added personal data; one statistic for any benchmark size."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_brute_force import prose
from twinlens.llm import decontaminate_bm25, mixing_es, pii_boosting, simhash_vptree

SF = "/root/testdata/sf0.01"
NAMES = ["base", "spans", "_t", "_more", "_base", "_null", "_out", "e_key", "e_src", "row", "id", "fp", "of", "text_",
         "a.b", "_hits", "_size", "src", "doc id"]


def test_documents_that_share_an_id_each_stay(spark):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(1, a, 1), (1, b, 2), (2, a, 3), (3, b + " x", 4), (None, prose(3, 50), 5), (None, prose(3, 50), 6),
            (None, a, 7), (5, prose(4, 40), 8), (5, prose(4, 40), 9), (6, None, 10), (7, "", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    for parts in (1, 5):
        kept = simhash_vptree.keep_one(docs.repartition(parts)).collect()
        texts = sorted((r.text or "", r.doc_id) for r in kept if r.doc_id is not None)
        near = 1 in {r.doc_id for r in kept if r.text == b}
        assert near and (a, 1) in texts and (prose(4, 40), 5) in texts
        assert sum(r.text == a for r in kept) == 1 and sum(r.text == prose(3, 50) for r in kept) == 1
        assert [r.doc_id for r in kept if not r.text] == [6]
        assert len([r for r in kept if r.doc_id == 5]) == 1


@pytest.mark.parametrize("step", ["near_dedup", "personal_data", "decontamination", "mixture", "quality"])
def test_columns_of_any_name_pass(spark, step):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    named = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])
    plain = getattr(corpus_pipeline, step)(spark, docs, SF)
    out = getattr(corpus_pipeline, step)(spark, named, SF)
    assert [c for c in out.columns if c in NAMES] == NAMES
    first = out.select(*[F.col(f"`{n.replace('`', '``')}`") for n in NAMES]).distinct().collect()
    assert [tuple(r) for r in first] == [tuple(range(len(NAMES)))]
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in plain.select("doc_id").collect())


@pytest.fixture(scope="module")
def trees(spark):
    return pii_boosting.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_planted_personal_data_without_a_base_rule(spark, trees):
    held = pii_boosting.made_findings(1000, seed=99)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(held)], "doc_id long, text string, a int, b int, good boolean")
    touch = F.exists("spans", lambda s: (s["start"] < F.col("b")) & (s["end"] > F.col("a")))
    base = F.exists("base", lambda s: (s["start"] < F.col("b")) & (s["end"] > F.col("a")))
    rows = pii_boosting.find(df, "doc_id", "a", "b", "good", trees=trees).select("good", touch.alias("hit"), base.alias("rule")).collect()
    good, other = [r for r in rows if r.good], [r for r in rows if not r.good and not r.rule]
    recall, false = sum(r.hit for r in good) / len(good), sum(r.hit for r in other)
    assert recall >= 0.9 and sum(r.hit for r in good) / (sum(r.hit for r in good) + false) >= 0.95
    assert sum(r.rule for r in good) < 10  # the base rules know next to none of them


def test_stated_forms_are_found_and_redacted(spark, trees, monkeypatch):
    monkeypatch.setattr(pii_boosting, "train", lambda docs: trees)
    forms = ["john [at] mail [dot] org", "(555) 010-4410", "ssn 123-45-6710"]
    rows = [(i, prose(i, 12) + " " + forms[i % 3] + " " + prose(i + 500, 6)) for i in range(100)]
    out = pii_boosting.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = [r for r in out if any(x in r.text for x in ("[dot]", "010-4410", "123-45-6710"))]
    assert len(left) <= 10
    # digits alone, dates and long numbers stay
    clean = [(0, "On 2024-01-15 at 12:30, 9807915762804490 items"), (1, "total 12 345 678 and version 10.2.30.4001")]
    same = pii_boosting.redact(spark.createDataFrame(clean, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.text) for r in same] == clean


def test_long_candidates_are_proposed(spark):
    local, digits = "x" * 300, "12" * 40
    rows = [(0, f"see {local} [at] mail [dot] org"), (1, f"n {digits} m")]
    got = spark.createDataFrame(rows, "doc_id long, text string").select(pii_boosting.proposals(F.col("text")).alias("p"))
    spans = [[(s.kind, len(s.m)) for s in r.p] for r in got.collect()]
    assert ("address", 300 + len(" [at] mail [dot] org")) in spans[0] and ("number", 80) in spans[1]


def test_benchmark_size_changes_no_hit(spark):
    items = [(i % 30 if i % 7 else None, prose(900 + i, 12 + i % 20)) for i in range(60)] + [(5, None), (5, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, prose(i, 40) + " " + items[i % 60][1][: 400 - 3 * (i % 50)]) for i in range(120)],
                                 "doc_id long, text string")

    def hits(n):
        out = []
        for index in decontaminate_bm25.indexes(bench, max_items=n):
            h = docs.select("doc_id", F.explode(decontaminate_bm25.hits_column(spark, index, F.col("text"))).alias("h"))
            out += [(r.doc_id, r.h.item_id, round(r.h.score, 9), r.h.question_overlap, r.h.answer_overlap, r.h.at_word)
                    for r in h.collect()]
        return sorted(out, key=repr)

    assert hits(10) == hits(20_000) != []


def test_mixing_takes_the_least_keys(spark):
    """Within a source no document is left out that comes before one taken."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    keyed = mixing_es._keyed(docs).select("doc_id", "_key", "_tie")
    rows = mixing_es.mix(docs).join(keyed, "doc_id").select("source", "_key", "_tie", "epochs", "edge_words", "size").collect()
    for source in {r.source for r in rows}:
        own = sorted((r for r in rows if r.source == source and r.size), key=lambda r: (r._key, r._tie))
        epochs = [r.epochs for r in own]
        assert epochs == sorted(epochs, reverse=True) and sum(r.edge_words > 0 for r in own) <= 1
