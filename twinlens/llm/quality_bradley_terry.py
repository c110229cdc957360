"""Document quality by Bradley-Terry pairwise ranking (operator 2).

A preference pair is a document labelled 1 and one labelled 0. The probability
that the first is preferred is the logistic function of the difference of the
two scores, a score being a weighted sum of text features; the weights come
from logistic loss on feature differences. The cut is a quantile of the
training scores (the share of rejected labels); scores are scaled so that the
cut lies at ``CUT`` between 0 and 1.

Features of all whole texts are computed in one pass in Arrow batches and
written out; labels are joined to these narrow rows, and at most ``SAMPLE``
labelled rows (the least by hash) reach the driver to fit. Rows in the held-out
fifth are never learned from.

Defined cases: null and empty texts are scored like any other; equal rows
score alike; without both labels all scores equal ``CUT``; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinlens.llm.common import bounded_sample
from twinlens.session import materialize

#: Contract values.
CUT = 0.3
FOLDS = 5
#: Parameters of the fit.
SAMPLE = 20_000
PAIRS = 60_000
PENALTY = 1e-3
SEED = 11

FEATURES = ["log_words", "word_length", "upper", "digit", "symbol", "bang", "mark", "wide", "bars",
            "distinct_words", "same_as_last", "repeated_triples", "repeated_lines", "top_word"]
_GROUPS = {name: np.frombuffer(chars, np.uint8) for name, chars in {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&<>@^~{}[]\\=+_",
    "bang": b"!?", "mark": b".,;:'\"()-", "wide": bytes(range(128, 256)), "bars": b"|"}.items()}


def describe(text: str | None) -> list[float]:
    """The features of a whole text, in the order of FEATURES."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    parts = raw.split()
    n = len(parts)
    solid = max(1, sum(map(len, parts)))
    shares = [float(seen[g].sum()) / solid for g in _GROUPS.values()]
    if not n:
        return [0.0, 0.0, *shares, 1.0, 0.0, 0.0, 0.0, 0.0]
    counts: dict[bytes, int] = {}
    for w in parts:
        counts[w] = counts.get(w, 0) + 1
    same = sum(a == b for a, b in pairwise(parts)) / n
    triples = len(set(zip(parts, parts[1:], parts[2:], strict=False)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [float(np.log1p(n)), solid / n, *shares, len(counts) / n, same,
            1 - triples / (n - 2) if n > 2 else 0.0, 1 - len(set(lines)) / len(lines), max(counts.values()) / n]


def described(docs: DataFrame) -> DataFrame:
    """``(doc_id, f)``: the features of every document."""
    @F.pandas_udf("array<double>")
    def f(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([describe(t) for t in texts], dtype=object)

    return docs.select("doc_id", f.asNondeterministic()(F.col("text")).alias("f"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Ranking:
    """Weights of the standardised features, the cut and the scale of the scores."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = (x - self.mean) / self.scale
        rng = np.random.default_rng(SEED)
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        d = z[rng.choice(good, PAIRS)] - z[rng.choice(bad, PAIRS)]
        w = np.zeros(x.shape[1])
        for _ in range(12):  # Newton steps of the penalised logistic loss
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            grad = d.T @ (1 - p) / len(d) - PENALTY * w
            curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + PENALTY * np.eye(len(w))
            w = w + np.linalg.solve(curve, grad)
        s = z @ w
        self.cut = float(np.quantile(s, (y == 0).mean()))
        self.weights = w
        # one slope for the logistic curve through CUT at the cut
        logit, best = np.log(CUT / (1 - CUT)), (np.inf, 1.0)
        for a in np.geomspace(0.05, 20, 40):
            m = a * (s - self.cut) + logit
            loss = float(np.mean(np.logaddexp(0, m) - y * m))
            best = min(best, (loss, float(a)))
        self.slope, self.base = best[1], float(logit)

    def score(self, f: Column) -> Column:
        raw = sum(((F.get(f, F.lit(i)) - float(m)) * float(w / s) for i, (m, s, w) in enumerate(
            zip(self.mean, self.scale, self.weights, strict=True))), F.lit(0.0))
        return 1 / (1 + F.exp(-(self.slope * (raw - self.cut) + self.base)))


def fit(features: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking | None:
    """A ranking from labelled rows outside the held-out fifth; None unless both labels occur."""
    own = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("y")).where(
        F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    # labels are few and narrow; a bounded share of them is cut out before features are joined
    own = bounded_sample(own, sample, "_id", "y")
    rows = (features.join(own, F.col("doc_id") == F.col("_id")).select("_id", "f", "y")
            .orderBy("_id", "y", "f").limit(sample).collect())
    y = np.array([r.y for r in rows])
    return Ranking(np.array([r.f for r in rows]), y) if 0 < y.sum() < len(y) else None


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    features = materialize(described(docs), "quality-features")
    ranking = fit(features, labels)
    s = F.lit(CUT) if ranking is None else ranking.score(F.col("f"))
    return features.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), s.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))
