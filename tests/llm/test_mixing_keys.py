"""The documents that the mix takes are those with the least keys, whatever their qualities."""
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from twinlens.llm import mixing_es


def table(spark, quality):
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        n = rng.choice([0, 1, 3, 20, 60])
        low = quality == "low" or (quality == "both" and i % 3)
        chars = "0123456789" if low else "abcdefghij"
        text = " ".join("".join(rng.choice(chars) for _ in range(6)) for _ in range(n))
        rows.append((i, text, rng.choice(["a", "a", "a", "a", "b", "c", None])))
    rows += [(9, "same text twice " * 9, "b")] * 5
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)


@pytest.mark.parametrize("quality", ["low", "high", "both"])
def test_least_keys_are_taken(spark, quality):
    docs = table(spark, quality)
    got = defaultdict(list)
    keys = mixing_es._keyed(docs).select("doc_id", "text", "source", "_key", "_tie", "_bucket", "_fine").collect()
    places = [(r._key, r._tie, r._bucket, r._fine) for r in keys]
    assert all(0 <= b < mixing_es.BUCKETS and 0 <= f < mixing_es.BUCKETS for _, _, b, f in places)
    order = sorted(places)
    assert [p[2:] for p in order] == sorted(p[2:] for p in order)  # ranges follow the keys
    assert max(sum(1 for p in places if p[2] == b) for b in {p[2] for p in places}) <= 0.01 * len(places)
    # equal documents have equal keys, so either may stand for the other
    key_of = {(r.doc_id, r.text, r.source): (r._key, r._tie) for r in keys}
    for r in mixing_es.mix(docs).collect():
        got[r.source].append((key_of[r.doc_id, r.text, r.source], r))
    for source, rows in got.items():
        target, size = rows[0][1].target, rows[0][1].source_size
        assert size == sum(r.size for _, r in rows)
        whole = int(target // size)
        budget = int(target - whole * size)
        rows.sort(key=lambda x: x[0])
        i = 0
        while i < len(rows):
            same = [r for k, r in rows[i:i + 10] if k == rows[i][0]]
            n = sum(r.size for r in same)
            take = n if n < budget else budget // len(same) * len(same)
            assert sum(r.taken - whole * r.size for r in same) == take, (source, i)
            budget -= min(n, budget)
            i += len(same)


def test_range_of_the_edge_is_small(spark):
    docs = table(spark, "low").withColumn("_fine", F.lit("clash")).withColumn("base", F.lit(1))
    out = mixing_es.mix(docs)
    assert out.columns[:5] == docs.columns and out.count() == docs.count()
