"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver tables through the fixture views, over whole
tables. Vector outputs are emitted in long form ``(key, pos, value)`` and sums
of floats are rounded (9-12 dp) so both engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinlens.functions.arrays import cross_entropy, relu, affine, softmax
from twinlens.functions.guid import normalize_guid
from twinlens.functions.labels import decode_label
from twinlens.functions.text import (STRIP_RE, decode_report, decode_text, encode_gb18030, is_blank, preview,
                                     strip_ws)
from twinlens.operators import evaluate as ev
from twinlens.operators.audit import audit_probabilities, audit_rows, audit_summary, overconfidence_report
from twinlens.operators.fusion import centroids
from twinlens.operators.modality import attach_images, attach_text, prepare_manifest
from twinlens.operators.split import split_counts, split_order_key
from twinlens.operators.text_prep import (assign_batches, build_vocab, encode_rows, encode_words,
                                          pad_batches, text_features)
from twinlens.operators.training import batch_mean_loss, best_epoch, mark_improvements
from twinlens.plans import pipeline as pl
from twinlens.plans.fixtures import (TXT_DIM, fx_batch_loss, fx_edge_blob, fx_edge_image, fx_edge_text, fx_history, fx_image_grid,
                                     fx_image_vec, fx_manifest, fx_test_manifest, fx_text, with_ctes)
from twinlens.session import materialize, spread
from twinlens.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}

VOCAB_SIZE = 1000
MAX_LEN = 128


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _Q[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _long(df: DataFrame, keys: list[str], arr: str, decimals: int, nonzero: bool = True,
          value: str = "v") -> DataFrame:
    out = df.select(*keys, F.posexplode(arr).alias("pos", "_v"))
    if nonzero:
        out = out.where(F.col("_v") != 0)
    return out.select(*keys, F.col("pos").cast("bigint").alias("pos"),
                      F.round("_v", decimals).alias(value))


def _decode_sql(c: str) -> str:
    return f"CASE {c} WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END"


def _strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '{STRIP_RE}', '', 'g')"


# ------------------------------------------------------------- flagship

FLAGSHIP_SQL = with_ctes("""
SELECT mode, count(*) AS total,
       CAST(sum(CASE WHEN label = k THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       round(100.0::DOUBLE * sum(CASE WHEN label = k THEN 1 ELSE 0 END) / count(*), 2) AS acc
FROM val_pred GROUP BY mode""", "val_pred")


@register("ablation_report", FLAGSHIP_SQL)
def q_ablation_report(spark, sf):
    return pl.flagship(spark, sf)


# ------------------------------------------------------- manifest family

@register("guid_normalize", with_ctes(
    "SELECT row_no, raw_guid, guid FROM norm_manifest", "norm_manifest"))
def q_guid_normalize(spark, sf):
    m = fx_manifest(spark, sf)
    return m.select("row_no", F.col("guid").alias("raw_guid"), normalize_guid("guid").alias("guid"))


@register("manifest_encode_labels", with_ctes(
    "SELECT row_no, guid, tag, label FROM norm_manifest", "norm_manifest"))
def q_encode(spark, sf):
    return prepare_manifest(fx_manifest(spark, sf)).select("row_no", "guid", "tag", "label")


@register("decode_labels", with_ctes(
    f"SELECT row_no, label, {_decode_sql('label')} AS tag_decoded FROM norm_manifest",
    "norm_manifest"))
def q_decode(spark, sf):
    m = prepare_manifest(fx_manifest(spark, sf))
    return m.select("row_no", "label", decode_label("label").alias("tag_decoded"))


@register("unlabelled_manifest", with_ctes(
    "SELECT row_no, guid FROM fx_test_manifest", "fx_test_manifest"))
def q_unlabelled(spark, sf):
    return prepare_manifest(fx_test_manifest(spark, sf), labelled=False).select("row_no", "guid")


@register("attach_text", with_ctes("""
SELECT m.row_no, m.guid, t.guid IS NOT NULL AS has_text, coalesce(t.text, '') AS text
FROM norm_manifest m LEFT JOIN fx_text t ON t.guid = m.guid""", "norm_manifest", "fx_text"))
def q_attach_text(spark, sf):
    m = prepare_manifest(fx_manifest(spark, sf))
    return attach_text(m, fx_text(spark, sf)).select("row_no", "guid", "has_text", "text")


@register("attach_images", with_ctes("""
SELECT m.row_no, m.guid, i.guid IS NOT NULL AS has_image,
       CAST(coalesce(len(i.img_feat), 0) AS BIGINT) AS n_dims,
       i.img_feat[1] AS first_v, i.img_feat[64] AS last_v
FROM norm_manifest m LEFT JOIN fx_image_vec i ON i.guid = m.guid""",
    "norm_manifest", "fx_image_vec"))
def q_attach_images(spark, sf):
    m = prepare_manifest(fx_manifest(spark, sf))
    j = attach_images(m, fx_image_vec(spark, sf), image_col="img_feat")
    return j.select("row_no", "guid", "has_image",
                    F.coalesce(F.size("img_feat"), F.lit(0)).cast("bigint").alias("n_dims"),
                    F.col("img_feat")[0].alias("first_v"), F.col("img_feat")[63].alias("last_v"))


@register("split_manifest", with_ctes(
    "SELECT row_no, guid, tag, split FROM split", "split"))
def q_split(spark, sf):
    return pl.split_fixture(spark, sf).select("row_no", "guid", "tag", "split")


@register("split_counts", with_ctes(
    "SELECT split, tag, count(*) AS n FROM split GROUP BY 1, 2", "split"))
def q_split_counts(spark, sf):
    return split_counts(pl.split_fixture(spark, sf), by=("split", "tag"))


# ---------------------------------------------------------------- text

@register("text_strip_preview", with_ctes(f"""
SELECT guid, substring({_strip_sql('text')}, 1, 50) AS preview,
       CAST(length({_strip_sql('text')}) AS BIGINT) AS n_chars,
       length({_strip_sql('text')}) = 0 AS is_empty
FROM fx_edge_text""", "fx_edge_text"))
def q_strip(spark, sf):
    t = fx_edge_text(spark, sf)
    s = strip_ws("text")
    return t.select("guid", preview(s).alias("preview"),
                    F.length(s).cast("bigint").alias("n_chars"), is_blank("text").alias("is_empty"))


@register("gb18030_decode", with_ctes(f"""
SELECT guid, {_strip_sql("replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))")} AS text
FROM fx_edge_text""", "fx_edge_text"))
def q_gb18030(spark, sf):
    t = spread(fx_edge_text(spark, sf)).select("guid", encode_gb18030(F.col("text")).alias("blob"))
    return t.select("guid", decode_text(F.col("blob"), "gb18030").alias("text"))


@register("text_features", with_ctes(
    "SELECT guid, pos, round(v, 12) AS v FROM txt_long", "txt_long"))
def q_text_features(spark, sf):
    f = text_features(fx_text(spark, sf), "text", TXT_DIM, hashing="md5")
    return _long(f, ["guid"], "txt_feat", 12)


_VOCAB_SQL = f"""vocab AS (
  SELECT * FROM (VALUES ('[PAD]', NULL::BIGINT, 0), ('[UNK]', NULL::BIGINT, 1),
                        ('[CLS]', NULL::BIGINT, 2), ('[SEP]', NULL::BIGINT, 3)) s(token, cnt, token_id)
  UNION ALL
  SELECT token, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, token) + 3 AS INTEGER) AS token_id
  FROM (SELECT w AS token, count(*) AS cnt FROM txt_tok WHERE w <> '' GROUP BY 1
        ORDER BY cnt DESC, token LIMIT {VOCAB_SIZE}))"""


def _insert_cte(sql: str, cte: str) -> str:
    """Append ``cte`` after the last CTE of a ``with_ctes`` query."""
    head, body = _split_body(sql)
    return head + ",\n" + cte + "\n-- body\n" + body


def _split_body(sql: str) -> tuple[str, str]:
    marker = "\n-- body\n"
    i = sql.index(marker)
    return sql[:i], sql[i + len(marker):]


def _vocab_query(body: str, *needed: str) -> str:
    return _insert_cte(with_ctes("-- body\n" + body, "txt_tok", *needed), _VOCAB_SQL)


@register("vocab_topk", _vocab_query("SELECT token, cnt, token_id FROM vocab"))
def q_vocab(spark, sf):
    return build_vocab(fx_text(spark, sf), VOCAB_SIZE)


_TOK_SQL = """tok AS (
  SELECT guid, list_filter(string_split_regex(regexp_replace(lower(text), '(\\p{Han})', ' \\1 ', 'g'), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS ws
  FROM fx_text)"""


def _tok_query(body: str) -> str:
    return _insert_cte(_vocab_query(body, "fx_text"), _TOK_SQL)


@register("encode_text", _tok_query(f"""
SELECT guid, CAST(0 AS BIGINT) AS pos, 2 AS token_id FROM tok
UNION ALL
SELECT b.guid, CAST(b.pos AS BIGINT), coalesce(v.token_id, 1)
FROM (SELECT guid, unnest(ws[1:{MAX_LEN - 2}]) AS token,
             generate_subscripts(ws[1:{MAX_LEN - 2}], 1) AS pos FROM tok) b
LEFT JOIN vocab v ON v.token = b.token
UNION ALL
SELECT guid, CAST(least(len(ws), {MAX_LEN - 2}) + 1 AS BIGINT), 3 FROM tok"""))
def q_encode_text(spark, sf):
    t = fx_text(spark, sf)
    e = encode_words(t, build_vocab(t, VOCAB_SIZE), MAX_LEN)
    return e.select("guid", F.col("pos").cast("bigint").alias("pos"), F.col("token_id").cast("int"))


@register("pad_batch", _tok_query(f"""
SELECT guid, batch_id, seq_len, max(seq_len) OVER (PARTITION BY batch_id) AS padded_len, seq_len AS n_mask
FROM (SELECT guid, seq_len,
             CAST(floor((row_number() OVER (ORDER BY row_no) - 1) / 16) AS BIGINT) AS batch_id
      FROM (SELECT guid, CAST(guid AS BIGINT) AS row_no,
                   CAST(least(len(ws), {MAX_LEN - 2}) + 2 AS INTEGER) AS seq_len
            FROM tok) x) y"""))
def q_pad_batch(spark, sf):
    t = fx_text(spark, sf)
    e = encode_rows(spread(t), build_vocab(t, VOCAB_SIZE), MAX_LEN)
    # written out: the range partitioning of the batches samples its input
    ids = materialize(e.select("guid", F.col("guid").cast("bigint").alias("row_no"), "input_ids"), "encoded")
    p = pad_batches(assign_batches(ids, 16, "row_no"), "input_ids", "longest")
    n_mask = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return p.select("guid", "batch_id", "seq_len", "padded_len", n_mask.alias("n_mask"))


# ------------------------------------------------------ fusion, scoring

@register("fuse_features", with_ctes(
    "SELECT guid, label, split, CAST(pos AS BIGINT) AS pos, round(v, 12) AS v FROM fe WHERE v <> 0",
    "fe"))
def q_fuse(spark, sf):
    fe = pl.labelled_features(spark, sf)
    return _long(fe, ["guid", "label", "split"], "features", 12)


@register("centroid_fit", with_ctes(
    "SELECT k, CAST(pos AS BIGINT) AS pos, round(mu, 10) AS mu FROM centroid WHERE mu <> 0",
    "centroid"))
def q_centroid_fit(spark, sf):
    fe = pl.labelled_features(spark, sf)
    c = centroids(fe.where(F.col("split") == "train"), "features", "label")
    return _long(c, ["k"], "mu", 10, value="mu")


_VAL_WIDE = """val_wide AS (
  SELECT l.row_no, l.guid, l.label, any_value(p.k) AS pred,
         max(CASE WHEN l.k = 0 THEN l.z END) AS z0, max(CASE WHEN l.k = 1 THEN l.z END) AS z1,
         max(CASE WHEN l.k = 2 THEN l.z END) AS z2
  FROM val_logit l JOIN val_pred p ON p.guid = l.guid AND p.mode = l.mode
  WHERE l.mode = 'multimodal' GROUP BY l.row_no, l.guid, l.label)"""


def _val_wide_query(body: str) -> str:
    return _insert_cte(with_ctes("-- body\n" + body, "val_logit", "val_pred"), _VAL_WIDE)


@register("centroid_score", _val_wide_query(
    "SELECT row_no, guid, label, pred, round(z0, 6) AS z0, round(z1, 6) AS z1, round(z2, 6) AS z2 "
    "FROM val_wide"))
def q_centroid_score(spark, sf):
    s = pl.scored_val(spark, sf)
    return s.select("row_no", "guid", "label", "pred",
                    *[F.round(F.col("logits")[i], 6).alias(f"z{i}") for i in range(3)])


@register("accuracy", with_ctes("""
SELECT count(*) AS total, CAST(sum(CASE WHEN label = k THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       round(100.0::DOUBLE * sum(CASE WHEN label = k THEN 1 ELSE 0 END) / count(*), 2) AS accuracy
FROM val_pred WHERE mode = 'multimodal'""", "val_pred"))
def q_accuracy(spark, sf):
    return ev.accuracy(pl.scored_val(spark, sf), "pred", "label")


_BAD_SQL = f"""
SELECT p.guid, coalesce(t.text, '') AS text, {_decode_sql('p.label')} AS true_label,
       {_decode_sql('p.k')} AS pred_label
FROM val_pred p LEFT JOIN fx_text t ON t.guid = p.guid
WHERE p.mode = 'multimodal' AND p.label <> p.k"""


@register("bad_cases", with_ctes(_BAD_SQL, "val_pred", "fx_text"))
def q_bad_cases(spark, sf):
    return pl.misclassified(spark, sf)


@register("bad_case_count", with_ctes(
    "SELECT count(*) AS n_bad FROM val_pred WHERE mode = 'multimodal' AND label <> k", "val_pred"))
def q_bad_case_count(spark, sf):
    s = pl.scored_val(spark, sf)
    return ev.bad_case_count(s.where(F.col("pred") != F.col("label")))


@register("head_bad_cases", with_ctes(f"""
SELECT guid, {_decode_sql('label')} AS true_label, {_decode_sql('k')} AS pred_label
FROM val_pred WHERE mode = 'multimodal' AND label <> k
ORDER BY md5(guid || '|42'), guid, row_no LIMIT 5""", "val_pred"))
def q_head_bad_cases(spark, sf):
    b = pl.misclassified(spark, sf, keep=("row_no",))
    top = ev.head_rows(b, [split_order_key("guid", 42), F.col("guid"), F.col("row_no")], 5)
    return top.select("guid", "true_label", "pred_label")


@register("predict_manifest", with_ctes("SELECT row_no, guid, tag FROM test_pred", "test_pred"))
def q_predict(spark, sf):
    return pl.predict_fixture(spark, sf)


@register("class_distribution", with_ctes(
    "SELECT tag, count(*) AS n FROM test_pred GROUP BY tag", "test_pred"))
def q_class_distribution(spark, sf):
    return ev.class_distribution(pl.predict_fixture(spark, sf), "tag")


# ------------------------------------------------------ training history

@register("epoch_loss", with_ctes("""
SELECT epoch, count(*) AS n_batches, round(avg(bl), 10) AS loss
FROM (SELECT epoch, batch_id, avg(loss) AS bl FROM fx_batch_loss GROUP BY 1, 2) b
GROUP BY epoch""", "fx_batch_loss"))
def q_epoch_loss(spark, sf):
    return batch_mean_loss(fx_batch_loss(spark, sf), decimals=10)


@register("best_epoch", with_ctes("""
SELECT epoch, val_acc FROM fx_history WHERE val_acc > 0 ORDER BY val_acc DESC, epoch LIMIT 1""",
    "fx_history"))
def q_best_epoch(spark, sf):
    return best_epoch(fx_history(spark, sf))


@register("improvements", with_ctes("""
SELECT epoch, val_acc,
       val_acc > coalesce(max(val_acc) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING
                                                               AND 1 PRECEDING), 0) AS improved
FROM fx_history""", "fx_history"))
def q_improvements(spark, sf):
    return mark_improvements(fx_history(spark, sf))


# ------------------------------------------------------- scalar kernels

# Three logits per embedding from the whole 64-vector: z = W e + b with the
# fixed kernel of ``relu_affine_weights``; labels 0..9 fold onto 3 classes.
_E3 = """z3 AS (
  SELECT e.vec_id, CAST(e.label AS BIGINT) % 3 AS y, k.range AS k,
         sum(CAST(u.v AS DOUBLE) * (((k.range * 64 + u.pos - 1) % 7) - 3) / 10.0) + (k.range - 1) / 10.0 AS z
  FROM embeddings e, unnest(e.embedding) WITH ORDINALITY AS u(v, pos), range(3) k
  GROUP BY e.vec_id, e.label, k.range),
e3 AS (
  SELECT vec_id, y, max(CASE WHEN k = 0 THEN z END) AS e0, max(CASE WHEN k = 1 THEN z END) AS e1,
         max(CASE WHEN k = 2 THEN z END) AS e2, max(z) AS m
  FROM z3 GROUP BY vec_id, y),
e3s AS (SELECT *, exp(e0 - m) + exp(e1 - m) + exp(e2 - m) AS s FROM e3)"""


def _logits3(spark, sf) -> DataFrame:
    w, b = relu_affine_weights()
    emb = table(spark, sf, "embeddings")
    return emb.select("vec_id", (F.col("label").cast("bigint") % 3).alias("y"),
                      affine(F.col("embedding").cast("array<double>"), w, b).alias("z"))


def relu_affine_weights(n_out: int = 3, n_in: int = 64):
    """Fixed kernel for the affine checks: ``W[k][j] = ((k*n_in + j) % 7 - 3) / 10``."""
    w = [[((k * n_in + j) % 7 - 3) / 10.0 for j in range(n_in)] for k in range(n_out)]
    b = [(k - 1) / 10.0 for k in range(n_out)]
    return w, b


@register("softmax_probs", f"""WITH {_E3}
SELECT vec_id, round(exp(e0 - m) / s, 9) AS p0, round(exp(e1 - m) / s, 9) AS p1,
       round(exp(e2 - m) / s, 9) AS p2 FROM e3s""")
def q_softmax(spark, sf):
    p = _logits3(spark, sf).select("vec_id", softmax("z").alias("p"))
    return p.select("vec_id", *[F.round(F.col("p")[i], 9).alias(f"p{i}") for i in range(3)])


@register("cross_entropy", f"""WITH {_E3}
SELECT vec_id, y, round(ln(s) + m - CASE y WHEN 0 THEN e0 WHEN 1 THEN e1 ELSE e2 END, 9) AS loss
FROM e3s""")
def q_cross_entropy(spark, sf):
    z = _logits3(spark, sf)
    return z.select("vec_id", "y", F.round(cross_entropy("z", "y"), 9).alias("loss"))


@register("relu_affine", with_ctes("""
SELECT guid, round(max(CASE WHEN k = 0 THEN h END), 9) AS h0,
       round(max(CASE WHEN k = 1 THEN h END), 9) AS h1, round(max(CASE WHEN k = 2 THEN h END), 9) AS h2
FROM (SELECT guid, k, greatest(sum(v * (((k * 64 + pos) % 7) - 3) / 10.0) + (k - 1) / 10.0, 0.0) AS h
      FROM fx_image_long CROSS JOIN (SELECT range AS k FROM range(3)) kk GROUP BY guid, k) x
GROUP BY guid""", "fx_image_long"))
def q_relu_affine(spark, sf):
    w, b = relu_affine_weights()
    g = fx_image_vec(spark, sf)
    h = g.select("guid", relu(affine("img_feat", w, b)).alias("h"))
    return h.select("guid", *[F.round(F.col("h")[i], 9).alias(f"h{i}") for i in range(3)])


# ----------------------------------------------------------------- audit

@register("audit_corpus", with_ctes(f"""
SELECT count(*) AS total,
       CAST(sum(CASE WHEN t.guid IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_text,
       CAST(sum(CASE WHEN t.guid IS NOT NULL AND CAST(t.guid AS BIGINT) % 10 NOT IN (1, 4, 7) THEN 1 ELSE 0 END)
            AS BIGINT) AS n_text_readable,
       CAST(sum(CASE WHEN t.guid IS NOT NULL AND length({_strip_sql('t.text')}) = 0 THEN 1 ELSE 0 END)
            AS BIGINT) AS n_text_empty,
       CAST(sum(CASE WHEN i.guid IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_image,
       CAST(sum(CASE WHEN i.image_ok THEN 1 ELSE 0 END) AS BIGINT) AS n_image_readable,
       CAST(sum(CASE WHEN list_max(i.px) = 0 AND list_min(i.px) = 0 THEN 1 ELSE 0 END)
            AS BIGINT) AS n_image_black
FROM norm_manifest m LEFT JOIN fx_edge_text t ON t.guid = m.guid
LEFT JOIN fx_edge_image i ON i.guid = m.guid""", "norm_manifest", "fx_edge_text", "fx_edge_image"))
def q_audit_corpus(spark, sf):
    m = prepare_manifest(fx_manifest(spark, sf))
    texts = fx_edge_blob(spark, sf).select("guid", decode_report("blob").alias("r")).select(
        "guid", "r.text", F.col("r.ok").alias("text_ok"))
    rows = audit_rows(m, texts, fx_edge_image(spark, sf), px_col="px")
    return audit_summary(rows)


@register("audit_probabilities", _val_wide_query("""
SELECT CASE pred WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS pred_tag,
       count(*) AS n,
       CAST(sum(CASE WHEN exp(z0 - mx) / s > 0.4 THEN 1 ELSE 0 END) AS BIGINT) AS n_over,
       round(avg(exp(z0 - mx) / s), 6) AS mean_p
FROM (SELECT *, exp(z0 - mx) + exp(z1 - mx) + exp(z2 - mx) AS s
      FROM (SELECT *, greatest(z0, z1, z2) AS mx FROM val_wide) a) b
GROUP BY 1"""))
def q_audit_probabilities(spark, sf):
    a = audit_probabilities(pl.scored_val(spark, sf), "logits", "pred", 0, 0.4)
    return overconfidence_report(a, 0)


# ------------------------------------------------------------- image grids

from twinlens.operators import image_prep as ip  # noqa: E402

_G = 8
_DRAW_SQL = ("('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '|1|42|{step}'), 1, 8))::BIGINT")


@register("image_hflip", with_ctes(f"""
SELECT i.guid, CASE WHEN f.flipped THEN (i.pos // 8) * 8 + 7 - i.pos % 8 ELSE i.pos END AS pos,
       round(i.v, 12) AS v, f.flipped
FROM fx_image_long i JOIN (SELECT CAST(vec_id AS VARCHAR) AS guid,
                                  {_DRAW_SQL.format(step='flip')} < {ip.flip_threshold(0.5)} AS flipped
                           FROM embeddings) f ON f.guid = i.guid""", "fx_image_long"))
def q_image_hflip(spark, sf):
    g = fx_image_grid(spark, sf)
    flipped, out = ip.random_hflip_grid(F.col("px"), F.col("guid"), _G, _G, 1, 42, 0.5)
    r = g.select("guid", flipped.alias("flipped"), out.alias("out"))
    return _long(r, ["guid", "flipped"], "out", 12, nonzero=False)


@register("image_rotate", f"""
WITH ang AS (
  SELECT CAST(vec_id AS VARCHAR) AS guid, embedding,
         -15.0::DOUBLE + 30.0::DOUBLE * ({_DRAW_SQL.format(step='rot')}::DOUBLE / 4294967296.0::DOUBLE) AS angle
  FROM embeddings),
cs AS (SELECT *, round(cos(-angle * pi() / 180.0::DOUBLE), 15) AS c,
              round(sin(-angle * pi() / 180.0::DOUBLE), 15) AS s FROM ang),
px AS (SELECT guid, angle, embedding, p.range AS pos,
              floor(c * ((p.range % 8) + -3.5::DOUBLE) + s * ((p.range // 8) + -3.5::DOUBLE) + 4.0)::BIGINT AS xi,
              floor(-s * ((p.range % 8) + -3.5::DOUBLE) + c * ((p.range // 8) + -3.5::DOUBLE) + 4.0)::BIGINT AS yi
       FROM cs CROSS JOIN range(64) p)
SELECT guid, round(angle, 9) AS angle, pos,
       round(CASE WHEN xi >= 0 AND xi < 8 AND yi >= 0 AND yi < 8
                  THEN CAST(embedding[yi * 8 + xi + 1] AS DOUBLE) ELSE 0.0::DOUBLE END, 12) AS v
FROM px""")
def q_image_rotate(spark, sf):
    g = fx_image_grid(spark, sf).withColumn("angle", ip.random_angle(F.col("guid"), 1, 42, 15.0))
    r = g.select("guid", F.round("angle", 9).alias("angle"),
                 ip.rotate_arrays(F.col("px"), F.col("angle"), _G, _G).alias("out"))
    return _long(r, ["guid", "angle"], "out", 12, nonzero=False)


_RESIZE_OUT = 5
_RW_SQL = f"""rw AS (
  SELECT o, x, w / sum(w) OVER (PARTITION BY o) AS w FROM (
    SELECT o.range AS o, x.range AS x,
           greatest(0.0::DOUBLE, 1.0 - abs((x.range - (o.range + 0.5) * ({_G}.0::DOUBLE / {_RESIZE_OUT}.0::DOUBLE) + 0.5)
                                         / greatest({_G}.0::DOUBLE / {_RESIZE_OUT}.0::DOUBLE, 1.0))) AS w
    FROM range({_RESIZE_OUT}) o CROSS JOIN range({_G}) x
    WHERE x.range >= greatest(floor((o.range + 0.5) * ({_G}.0::DOUBLE / {_RESIZE_OUT}.0::DOUBLE)
                                    - greatest({_G}.0::DOUBLE / {_RESIZE_OUT}.0::DOUBLE, 1.0) + 0.5), 0)
      AND x.range < least(floor((o.range + 0.5) * ({_G}.0::DOUBLE / {_RESIZE_OUT}.0::DOUBLE)
                                + greatest({_G}.0::DOUBLE / {_RESIZE_OUT}.0::DOUBLE, 1.0) + 0.5), {_G})) t)"""


@register("image_resize", _insert_cte(with_ctes(f"""-- body
SELECT i.guid, ry.o * {_RESIZE_OUT} + rx.o AS pos, round(sum(ry.w * rx.w * i.v), 9) AS v
FROM fx_image_long i JOIN rw ry ON ry.x = i.pos // {_G} JOIN rw rx ON rx.x = i.pos % {_G}
GROUP BY i.guid, ry.o, rx.o""", "fx_image_long"), _RW_SQL))
def q_image_resize(spark, sf):
    g = fx_image_grid(spark, sf)
    r = g.select("guid", ip.resize_arrays(F.col("px"), _G, _G, _RESIZE_OUT, _RESIZE_OUT).alias("out"))
    return _long(r, ["guid"], "out", 9, nonzero=False)


@register("image_normalize", with_ctes(
    f"SELECT guid, pos, round((v - {ip.MEAN[0]}::DOUBLE) / {ip.STD[0]}::DOUBLE, 12) AS v "
    "FROM fx_image_long", "fx_image_long"))
def q_image_normalize(spark, sf):
    g = fx_image_grid(spark, sf)
    r = g.select("guid", ip.normalize_grid(F.col("px"), ip.MEAN[0], ip.STD[0]).alias("out"))
    return _long(r, ["guid"], "out", 12, nonzero=False)


@register("image_extrema", with_ctes("""
SELECT guid, list_min(img_feat) AS vmin, list_max(img_feat) AS vmax,
       list_min(img_feat) = 0 AND list_max(img_feat) = 0 AS is_black FROM fx_image_vec""",
    "fx_image_vec"))
def q_image_extrema(spark, sf):
    g = fx_image_grid(spark, sf)
    lo, hi, black = ip.grid_extrema(F.col("px"))
    return g.select("guid", lo.alias("vmin"), hi.alias("vmax"), black.alias("is_black"))


@register("channel_stats", with_ctes("""
SELECT count(*) AS n, round(sum(v) / count(*), 8) AS mean,
       round(sqrt(sum(v * v) / count(*) - (sum(v) / count(*)) * (sum(v) / count(*))), 8) AS std
FROM fx_image_long""", "fx_image_long"))
def q_channel_stats(spark, sf):
    st = ip.channel_stats(fx_image_grid(spark, sf), "px")
    return st.select("n", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


def _image_structs(spark, sf) -> DataFrame:
    """Spark image structs (8x8, BGR bytes) derived from ``embeddings``.

    ``q = clip(round((v + 4) * 32), 0, 255)``; pixel p is (B, G, R) =
    (255 - q[p], q[63 - p] div 2, q[p]). Built natively: hex digits, unhex.
    """
    q = F.transform("embedding", lambda x: F.least(F.greatest(F.round((x + 4.0) * 32.0), F.lit(0.0)),
                                                   F.lit(255.0)).cast("int"))
    # q is its own column: the pixel lambda reads it three times per pixel
    emb = table(spark, sf, "embeddings").select("vec_id", q.alias("q"))
    qc = F.col("q")
    bgr = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_G * _G - 1)), lambda p: F.array(
        255 - F.get(qc, p), (F.get(qc, _G * _G - 1 - p) / 2).cast("int"), F.get(qc, p))))
    data = F.unhex(F.array_join(F.transform(bgr, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    guid = F.col("vec_id").cast("string")
    img = F.struct(F.concat(F.lit("embeddings/"), guid).alias("origin"), F.lit(_G).alias("height"),
                   F.lit(_G).alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"),
                   data.alias("data"))
    return emb.select(guid.alias("guid"), img.alias("image"))


@register("image_struct_extrema", """
WITH q AS (
  SELECT CAST(e.vec_id AS VARCHAR) AS guid,
         CAST(least(greatest(round((CAST(u.v AS DOUBLE) + 4.0) * 32.0), 0.0), 255.0) AS INTEGER) AS q
  FROM embeddings e, unnest(e.embedding) AS u(v))
SELECT guid, CAST(min(q) AS INTEGER) AS r_min, CAST(max(q) AS INTEGER) AS r_max,
       CAST(min(q) // 2 AS INTEGER) AS g_min, CAST(max(q) // 2 AS INTEGER) AS g_max,
       CAST(255 - max(q) AS INTEGER) AS b_min, CAST(255 - min(q) AS INTEGER) AS b_max,
       max(q) = 0 AND max(q) // 2 = 0 AND 255 - min(q) = 0 AS is_black
FROM q GROUP BY guid""")
def q_image_struct_extrema(spark, sf):
    ext = _image_structs(spark, sf).select("guid", ip.struct_extrema(F.col("image")).alias("e"))
    names = ["r_min", "r_max", "g_min", "g_max", "b_min", "b_max"]
    cols = [F.col("e")[i].cast("int").alias(n) for i, n in enumerate(names)]
    black = (F.col("e")[1] == 0) & (F.col("e")[3] == 0) & (F.col("e")[5] == 0)
    return ext.select("guid", *cols, black.alias("is_black"))


# ---------------------------------------------- training (rows-only check)

@register("mlp_head_fit")
def q_mlp_head_fit(spark, sf):
    """Fusion head trained with AdamW, 5 epochs, batch 16, lr 2e-5 (M3, M7, M8).

    Returns the per-epoch history with improvement flags. The best head is
    saved as a table and read back (A9, A10); ``stored_acc`` is the read head's
    validation accuracy, in the row of the epoch it comes from. Iterative: no SQL form.
    """
    from twinlens.operators.fusion import default_blocks, score
    from twinlens.operators.training import fit_fusion_head, history_frame
    from twinlens.plans.fixtures import IMG_DIM
    from twinlens.session import scratch_path
    from twinlens.sources.model_io import load_head, save_head
    fe = pl.labelled_features(spark, sf)
    train, val = fe.where(F.col("split") == "train"), fe.where(F.col("split") == "val")
    best, last, hist = fit_fusion_head(train, val, default_blocks(IMG_DIM, TXT_DIM))
    out = mark_improvements(history_frame(spark, hist))
    if best is None:
        return out.withColumn("stored_acc", F.lit(None).cast("double"))
    path = scratch_path(spark, "best-head")
    save_head(spark, best, path)
    acc = ev.accuracy(score(val, load_head(spark, path)), "pred", "label").select(
        (100.0 * F.col("correct") / F.col("total")).alias("stored_acc"),
        F.lit(max(h[0] for h in hist if h[4])).alias("epoch"))
    return out.join(acc, "epoch", "left")


@register("ml_head_fit")
def q_ml_head_fit(spark, sf):
    """Spark ML multilayer perceptron on the fused features; val accuracy (M4)."""
    from pyspark.ml.functions import array_to_vector
    from twinlens.operators.training import fit_ml_head
    fe = pl.labelled_features(spark, sf)
    model = fit_ml_head(fe.where(F.col("split") == "train"))
    val = fe.where(F.col("split") == "val").withColumn("fv", array_to_vector("features"))
    pred = model.transform(val).withColumn("pred", F.col("prediction").cast("int"))
    return ev.accuracy(pred, "pred", "label")


from twinlens.plans import file_queries, image_queries, model_queries  # noqa: E402, F401
