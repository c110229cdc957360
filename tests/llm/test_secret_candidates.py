"""Candidates of the secret scan, their windows, and keys of formats that the made findings lack."""
import random

import pytest
from pyspark.sql import functions as F

from twinlens.llm import secrets_cnn as sc

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def key(rng, n, chars=LETTERS + "0123456789"):
    return "".join(rng.choice(chars) for _ in range(n))


def found(text):
    return {text[a:b] for _, a, b, _, base, _ in sc.candidates(text) if not base}


def test_candidates():
    rng = random.Random(1)
    letters, late = key(rng, 40, LETTERS), key(rng, 68, LETTERS) + "4abcdE"
    url = "https://x.org/" + "abcdefghij/" * 7
    assert letters in found(f"use {letters} now") and late in found(f"use {late}.")
    assert "ghp_" + letters in found(url + "ghp_" + letters)  # 91 characters into its run
    assert "hunter2xyz" in found("pwd=hunter2xyz") and "qWeRtYuIoP" in found("auth_key: 'qWeRtYuIoP'")
    touching = "g" * 20 + "/0123456789abcdef01234567/" + letters  # a base finding in the middle
    assert {"g" * 20 + "/", letters} <= {t.removeprefix("/") for t in found(touching)}
    assert found("=" * 40) == found("") == found(None) == set() and found("a short one: no") == set()


@pytest.mark.parametrize("n", [1, 16, 36, 37, 48, 49, 400, 5000])
def test_windows_cover_whole_candidates(n):
    text = "<" * 30 + "".join(LETTERS[i % 52] for i in range(n)) + ">" * 30
    ws = sc.windows(text, 30, 30 + n)
    assert all(len(w) <= sc.WIDTH for w in ws) and ws[0].startswith("<" * sc.BEFORE)
    covered = set()
    for i, w in enumerate(ws):
        at = 30 - sc.BEFORE + i * sc.STRIDE
        assert text[at:at + sc.WIDTH] == w
        covered |= set(range(at, at + len(w)))
    assert set(range(30, 30 + n + sc.AFTER)) <= covered


def test_runs_and_parts():
    assert sc.settled_spans([(0, 100, True), (60, 90, False)]) == [(60, 90)]  # a key in a long path
    assert sc.settled_spans([(0, 100, True), (10, 70, False)]) == [(0, 100)]
    assert sc.settled_spans([(0, 40, True)]) == [(0, 40)] and sc.settled_spans([]) == []
    assert sc.settled_spans([(0, 9, False), (5, 12, False), (12, 20, False)]) == [(0, 12), (12, 20)]
    rng = random.Random(3)
    for _ in range(300):  # never overlapping, and nothing of an accepted part is lost
        spans = [(a, a + rng.randrange(1, 30), rng.random() < 0.4) for a in (rng.randrange(100) for _ in range(8))]
        got = sc.settled_spans(spans)
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))
        assert all(any(s <= a and b <= e for s, e in got) for a, b, run in spans if not run)


def test_planted_keys_of_other_formats(spark):
    rng = random.Random(7)
    formats = [lambda: "glpat-" + key(rng, 20), lambda: "npm_" + key(rng, 36), lambda: "hf_" + key(rng, 34, LETTERS),
               lambda: "dckr_pat_" + key(rng, 27), lambda: key(rng, 120),
               lambda: "https://files.org/" + "some/long/path/of/names/" * 4 + key(rng, 36) + "/end"]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    base = [r.text for r in docs.where("length(text) > 300").orderBy("doc_id").limit(120).collect()]
    rows, keys = [], {}
    for i, text in enumerate(base):
        token = formats[i % len(formats)]()
        at = text.find(" ", len(text) // 2)
        rows.append((10 ** 6 + i, f"{text[:at]} {token} {text[at:]}", "extra"))
        core = token.split("/")[-2] if "/" in token else token
        keys[10 ** 6 + i] = (at + 1 + token.index(core), at + 1 + token.index(core) + len(core))
    rows += [(2 * 10 ** 6, None, None), (2 * 10 ** 6 + 1, "ab" * 500_000, ""), (2 * 10 ** 6 + 2, "x:" * 200_000, "")]
    planted = docs.withColumn("found", F.lit("clash")).union(spark.createDataFrame(rows, "doc_id long, text string, found string"))
    spans = {r.doc_id: [(s.start, s.end) for s in r.found if not s.base] for r in sc.find(planted).collect()}
    assert len(spans) == planted.count()
    hit = sum(any(s < e and a < b and min(b, e) - max(a, s) >= 0.9 * (b - a) for s, e in spans[i]) for i, (a, b) in keys.items())
    clean = [i for i, v in spans.items() if i < 10 ** 6 and v]
    assert hit >= 0.9 * len(keys), hit
    assert len(clean) <= 0.01 * docs.count(), clean
