"""Registered queries of the two-layer head, with their SQL.

The head's first parameters follow a rule (``first_head``), so that both sides
can write them down; everything else is computed from the fused features of the
labelled rows. In SQL a layer is a table (part, row, col, weight), the forward
pass two aggregates with a ReLU between them, the backward pass their mirror image.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from twinlens.operators import evaluate as ev
from twinlens.operators.audit import audit_probabilities
from twinlens.operators.fusion import Head, default_blocks, score
from twinlens.operators.training import fit_full_batch, head_gradient, history_frame
from twinlens.plans import pipeline as pl
from twinlens.plans.fixtures import IMG_DIM, TXT_DIM, with_ctes
from twinlens.plans.registry import _insert_cte, _val_wide_query, register
from twinlens.session import scratch_path
from twinlens.sources.model_io import load_head, save_head

WIDTH, HIDDEN, CLASSES = IMG_DIM + TXT_DIM, 8, 3
EPOCHS, RATE, DECAY = 6, 0.005, 0.01


def first_head(d: int = WIDTH, hidden: int = HIDDEN, k: int = CLASSES) -> Head:
    """``W1[h, j] = ((h d + j) % 7 - 3) / 10``, ``b1[h] = (2 h - 7) / 20``, ``W2[k, h] = ((k H + h) % 5 - 2) / 5``,
    ``b2[k] = (k - 1) / 10``."""
    w1 = ((np.arange(hidden * d) % 7 - 3) / 10.0).reshape(hidden, d)
    w2 = ((np.arange(k * hidden) % 5 - 2) / 5.0).reshape(k, hidden)
    return Head([(w1, (2 * np.arange(hidden) - 7) / 20.0), (w2, (np.arange(k) - 1) / 10.0)],
                default_blocks(IMG_DIM, TXT_DIM))


_FIRST = f"""p0 AS (
  SELECT 'W1' AS part, h.range AS r, j.range AS c, ((h.range * {WIDTH} + j.range) % 7 - 3) / 10.0::DOUBLE AS w
  FROM range({HIDDEN}) h, range({WIDTH}) j
  UNION ALL SELECT 'b1', range, 0, (2 * range - 7) / 20.0::DOUBLE FROM range({HIDDEN})
  UNION ALL SELECT 'W2', k.range, h.range, ((k.range * {HIDDEN} + h.range) % 5 - 2) / 5.0::DOUBLE
  FROM range({CLASSES}) k, range({HIDDEN}) h
  UNION ALL SELECT 'b2', range, 0, (range - 1) / 10.0::DOUBLE FROM range({CLASSES}))"""


def _forward(p: str, e: str) -> str:
    """Hidden units, logits and their maximum for every labelled row, by the parameters in table ``p``."""
    return f"""sum{e} AS (
  SELECT f.guid, w.r AS h, sum(f.v * w.w) AS a FROM fe f JOIN {p} w ON w.part = 'W1' AND w.c = f.pos GROUP BY 1, 2),
pre{e} AS (
  SELECT s.guid, s.label, s.split, b.r AS h, b.w + coalesce(x.a, 0.0) AS a
  FROM split s JOIN {p} b ON b.part = 'b1' LEFT JOIN sum{e} x ON x.guid = s.guid AND x.h = b.r),
z{e} AS (
  SELECT a.guid, a.label, a.split, w.r AS k, any_value(b.w) + sum(w.w * greatest(a.a, 0.0)) AS z
  FROM pre{e} a JOIN {p} w ON w.part = 'W2' AND w.c = a.h JOIN {p} b ON b.part = 'b2' AND b.r = w.r
  GROUP BY 1, 2, 3, 4),
top{e} AS (
  SELECT guid, label, split, max(z) AS m, min_by(k, (-z, k)) AS pred FROM z{e} GROUP BY 1, 2, 3),
soft{e} AS (
  SELECT z.guid, z.label, z.k, z.z, t.m, sum(exp(z.z - t.m)) OVER (PARTITION BY z.guid) AS s
  FROM z{e} z JOIN top{e} t ON t.guid = z.guid WHERE z.split = 'train')"""


def _backward(p: str, e: str) -> str:
    """Gradient of the mean cross-entropy over the training rows, for every parameter."""
    return f"""err{e} AS (
  SELECT guid, k, (exp(z - m) / s - CASE WHEN k = label THEN 1.0 ELSE 0.0 END)
                  / (SELECT count(*) FROM split WHERE split = 'train') AS g FROM soft{e}),
back{e} AS (
  SELECT a.guid, a.h, CASE WHEN a.a > 0 THEN sum(d.g * w.w) ELSE 0.0 END AS g
  FROM pre{e} a JOIN err{e} d ON d.guid = a.guid JOIN {p} w ON w.part = 'W2' AND w.r = d.k AND w.c = a.h
  GROUP BY a.guid, a.h, a.a),
found{e} AS (
  SELECT 'W2' AS part, d.k AS r, a.h AS c, sum(d.g * greatest(a.a, 0.0)) AS g
  FROM err{e} d JOIN pre{e} a ON a.guid = d.guid GROUP BY 2, 3
  UNION ALL SELECT 'b2', k, 0, sum(g) FROM err{e} GROUP BY k
  UNION ALL SELECT 'b1', h, 0, sum(g) FROM back{e} GROUP BY h
  UNION ALL SELECT 'W1', b.h, f.pos, sum(b.g * f.v) FROM back{e} b JOIN fe f ON f.guid = b.guid GROUP BY 2, 3),
g{e} AS (
  SELECT p.part, p.r, p.c, p.w, coalesce(f.g, 0.0) AS g
  FROM {p} p LEFT JOIN found{e} f ON f.part = p.part AND f.r = p.r AND f.c = p.c)"""


def _with(ctes: str, body: str) -> str:
    return _insert_cte(with_ctes("-- body\n" + body, "fe", "split"), ctes)


@register("mlp_score", _with(f"{_FIRST},\n{_forward('p0', '0')}", """
SELECT z.guid, z.label, t.pred AS pred, round(max(CASE WHEN k = 0 THEN z END), 9) AS z0,
       round(max(CASE WHEN k = 1 THEN z END), 9) AS z1, round(max(CASE WHEN k = 2 THEN z END), 9) AS z2
FROM z0 z JOIN top0 t ON t.guid = z.guid WHERE z.split = 'val' GROUP BY z.guid, z.label, t.pred"""))
def q_mlp_score(spark, sf):
    """Logits and class of the two-layer head for the validation rows."""
    val = pl.labelled_features(spark, sf).where(F.col("split") == "val")
    s = score(val, first_head())
    return s.select("guid", "label", F.col("pred").cast("bigint").alias("pred"),
                    *[F.round(F.col("logits")[i], 9).alias(f"z{i}") for i in range(CLASSES)])


@register("head_gradient", _with(f"{_FIRST},\n{_forward('p0', '0')},\n{_backward('p0', '0')}", """
SELECT CAST(substr(part, 2) AS INTEGER) - 1 AS layer, substr(part, 1, 1) AS part, CAST(r AS INTEGER) AS row,
       CAST(c AS INTEGER) AS col, round(g, 10) AS gradient FROM g0"""))
def q_head_gradient(spark, sf):
    """Gradient of the two-layer head over the whole training split, every parameter."""
    train = pl.labelled_features(spark, sf).where(F.col("split") == "train")
    return head_gradient(train, first_head())[1].withColumn("gradient", F.round("gradient", 10))


@register("head_loss", _with(f"{_FIRST},\n{_forward('p0', '0')}", """
SELECT count(*) AS n, round(avg(ln(s) + m - z), 10) AS loss,
       (SELECT count(*) FROM top0 WHERE split = 'train' AND pred = label) AS correct
FROM soft0 WHERE k = label"""))
def q_head_loss(spark, sf):
    """Mean cross-entropy and right answers of the two-layer head over the training split."""
    train = pl.labelled_features(spark, sf).where(F.col("split") == "train")
    return head_gradient(train, first_head())[0].withColumn("loss", F.round("loss", 10))


def _training_sql(epochs: int) -> str:
    """AdamW steps as a chain of tables, one set an epoch."""
    parts = [_FIRST, "s0 AS (SELECT part, r, c, w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM p0)"]
    for e in range(epochs):
        parts += [_forward(f"s{e}", str(e)), _backward(f"s{e}", str(e)), f"""s{e + 1} AS (
  SELECT part, r, c, w * (1 - {RATE}::DOUBLE * {DECAY}::DOUBLE)
         - {RATE}::DOUBLE * (m / (1 - pow(0.9::DOUBLE, {e + 1}))) / (sqrt(v / (1 - pow(0.999::DOUBLE, {e + 1}))) + 1e-8) AS w,
         m, v
  FROM (SELECT s.part, s.r, s.c, s.w, 0.9::DOUBLE * s.m + 0.1::DOUBLE * g.g AS m,
               0.999::DOUBLE * s.v + 0.001::DOUBLE * g.g * g.g AS v
        FROM s{e} s JOIN g{e} g ON g.part = s.part AND g.r = s.r AND g.c = s.c) x)"""]
    parts.append(_forward(f"s{epochs}", str(epochs)))
    rows = [f"""
  SELECT {e + 1} AS epoch, (SELECT avg(ln(s) + m - z) FROM soft{e} WHERE k = label) AS train_loss,
         (SELECT 100.0::DOUBLE * count(*) FILTER (pred = label) / count(*) FROM top{e} WHERE split = 'train') AS train_acc,
         (SELECT 100.0::DOUBLE * count(*) FILTER (pred = label) / count(*) FROM top{e + 1} WHERE split = 'val') AS val_acc"""
            for e in range(epochs)]
    parts.append("history AS (" + "\n  UNION ALL".join(rows) + ")")
    return ",\n".join(parts)


@register("full_batch_training", _with(_training_sql(EPOCHS), """
SELECT epoch, round(train_loss, 8) AS train_loss, round(train_acc, 8) AS train_acc, round(val_acc, 8) AS val_acc,
       val_acc > coalesce(max(val_acc) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS is_best
FROM history"""))
def q_full_batch_training(spark, sf):
    """Losses, accuracies and best epochs of AdamW on the exact gradient, from the first head on."""
    fe = pl.labelled_features(spark, sf)
    hist = fit_full_batch(fe.where(F.col("split") == "train"), fe.where(F.col("split") == "val"), first_head(),
                          EPOCHS, RATE, DECAY)[2]
    return history_frame(spark, hist).withColumns(
        {c: F.round(c, 8) for c in ("train_loss", "train_acc", "val_acc")})


@register("head_store", _val_wide_query("""
SELECT row_no, guid, label, pred, round(z0, 6) AS z0, round(z1, 6) AS z1, round(z2, 6) AS z2 FROM val_wide"""))
def q_head_store(spark, sf):
    """Validation scores by the head read back from its table, not by the fitted one in memory."""
    fit = pl.fit_fixture(spark, sf)
    path = scratch_path(spark, "stored-head")
    save_head(spark, fit.head, path)
    s = score(fit.val, load_head(spark, path))
    return s.select("row_no", "guid", "label", "pred",
                    *[F.round(F.col("logits")[i], 6).alias(f"z{i}") for i in range(CLASSES)])


#: Sharper than the centroid head's logits, and a bound that some rows exceed.
SHARPNESS, OVER = 40.0, 0.45

_PROBABILITIES = f"""
SELECT row_no, guid, pred, {SHARPNESS} * z0 AS z0, {SHARPNESS} * z1 AS z1, {SHARPNESS} * z2 AS z2,
       {SHARPNESS} * greatest(z0, z1, z2) AS mx FROM val_wide"""


@register("probability_audit_rows", _val_wide_query(f"""
SELECT row_no, guid, CASE pred WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS pred_tag,
       round(z0, 6) AS z0, round(z1, 6) AS z1, round(z2, 6) AS z2, round(exp(z0 - mx) / s, 6) AS p0,
       round(exp(z1 - mx) / s, 6) AS p1, round(exp(z2 - mx) / s, 6) AS p2, exp(z0 - mx) / s > {OVER} AS overconfident
FROM (SELECT *, exp(z0 - mx) + exp(z1 - mx) + exp(z2 - mx) AS s FROM ({_PROBABILITIES}) a) b"""))
def q_probability_audit_rows(spark, sf):
    """Logits, probabilities, class and over-confidence of every validation row."""
    s = pl.scored_val(spark, sf).withColumn("logits", F.transform("logits", lambda z: F.round(z, 9) * F.lit(SHARPNESS)))
    a = audit_probabilities(s, "logits", "pred", 0, OVER)
    return a.select("row_no", "guid", "pred_tag", *[F.round(F.col("logits")[i], 6).alias(f"z{i}") for i in range(CLASSES)],
                    *[F.round(F.col("probs")[i], 6).alias(f"p{i}") for i in range(CLASSES)], "overconfident")
