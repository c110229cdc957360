"""Fixture views over the driver tables (FIXTURES.md), in Spark and in SQL.

Each ``fx_*`` function builds the view as a lazy DataFrame; ``SQL_CTES`` holds
the same definitions as DuckDB common table expressions, so every oracle
query reads exactly the input its Spark twin reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinlens.functions.text import encode_gb18030
from twinlens.sources.tables import table

IMG_DIM = 64
TXT_DIM = 32
GRID = 8
BATCH_OFFSET = 43


def fx_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_no, guid, tag)``; every row kept, guid spelled five ways by ``doc_id % 5``.

    The fifth spelling, ``'8`` (a spreadsheet-forced text id), is not a number,
    so guid repair keeps it as text and no text or image file matches it: the
    missing-modality defaults are exercised without dropping any input row.
    """
    lab = table(spark, sf_dir, "labels")
    d = F.col("doc_id").cast("string")
    guid = (F.when(F.col("doc_id") % 5 == 0, d)
            .when(F.col("doc_id") % 5 == 1, F.concat(d, F.lit(".0")))
            .when(F.col("doc_id") % 5 == 2, F.concat(F.lit(" "), d, F.lit(" ")))
            .when(F.col("doc_id") % 5 == 3, F.concat(d, F.lit("e0")))
            .otherwise(F.concat(F.lit("'"), d)))
    tag = (F.when(F.col("toxic") == 1, "negative")
           .when(F.col("quality") == 1, "positive").otherwise("neutral"))
    return lab.select(F.col("doc_id").alias("row_no"), guid.alias("guid"), tag.alias("tag"))


def fx_test_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled manifest: documents with no row in ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels").select("doc_id")
    un = docs.join(lab, "doc_id", "left_anti")
    return un.select(F.col("doc_id").alias("row_no"), F.col("doc_id").cast("string").alias("guid"))


def fx_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded text per guid: every document, whole text."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("guid"), "text")


def fx_image_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precomputed image features ``(guid, img_feat ARRAY<DOUBLE>(64))``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").cast("string").alias("guid"),
                      F.col("embedding").cast("array<double>").alias("img_feat"))


def fx_image_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same 64 values read as an 8x8 one-channel raster, row-major."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").cast("string").alias("guid"),
                      F.col("embedding").cast("array<double>").alias("px"))


def fx_edge_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text; by id, one in six each is blank, padded, or has CR LF or CR line ends."""
    n, text = F.col("doc_id") % 6, F.col("text")
    edge = (F.when(n == 0, F.lit(" \r\n\t\u3000")).when(n == 1, F.concat(F.lit("\u3000\r\n "), text, F.lit(" \n")))
            .when(n == 2, F.replace(text, F.lit(" "), F.lit("\r\n"))).when(n == 3, F.replace(text, F.lit(" "), F.lit("\r")))
            .otherwise(text))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("guid"), edge.alias("text"))


def fx_edge_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_edge_text`` as GB18030 bytes; by id, three in ten hold bytes that are not valid.

    Stray bytes stand after the third character (``doc_id % 10`` = 1) or first (4), or
    a character is cut off at the end (7). All of them are dropped by a lenient decode.
    """
    t = fx_edge_text(spark, sf_dir)
    n, text = F.col("guid").cast("bigint") % 10, F.col("text")
    cut = F.when(n == 1, 3).otherwise(0)
    head = encode_gb18030(F.substring(text, F.lit(1), cut))
    tail = encode_gb18030(F.substring(text, cut + 1, F.length(text)))
    stray, half = F.unhex(F.lit("FFFF")), F.unhex(F.lit("81"))
    blob = F.when((n == 1) | (n == 4), F.concat("head", stray, "tail")).when(n == 7, F.concat("tail", half)).otherwise(
        F.col("tail"))
    return t.select("guid", head.alias("head"), tail.alias("tail")).select("guid", blob.alias("blob"))


def fx_edge_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raster; by id, one in nine is black and one in seven unreadable."""
    px = F.col("embedding").cast("array<double>")
    black = F.when(F.col("vec_id") % 9 == 0, F.transform(px, lambda x: x * 0)).otherwise(px)
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("guid"), black.alias("px"), (F.col("vec_id") % 7 != 0).alias("image_ok"))


def fx_batch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample, every event: ``(epoch, batch_id, loss)``.

    Batches are 80 consecutive events (16 per epoch) offset by 43, so the first
    batch of each epoch is short (7 or 8 rows) and the mean of batch means
    differs from the row mean.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select((F.col("event_id") % 5 + 1).alias("epoch"),
                     F.floor((F.col("event_id") + BATCH_OFFSET) / 80).cast("bigint").alias("batch_id"),
                     F.col("value").alias("loss"))


def fx_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-epoch validation accuracy ``(epoch, val_acc)``."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy((F.col("event_id") % 5 + 1).alias("epoch"))
            .agg(F.round(F.lit(100.0) * F.avg(F.when(F.col("event_type") == "click", 1.0)
                                               .otherwise(0.0)), 6).alias("val_acc")))


# DuckDB definitions of the same views (tables are pre-registered views).
SQL_CTES: dict[str, str] = {
    "fx_manifest": """fx_manifest AS (
  SELECT doc_id AS row_no,
    CASE doc_id % 5 WHEN 0 THEN CAST(doc_id AS VARCHAR)
                    WHEN 1 THEN CAST(doc_id AS VARCHAR) || '.0'
                    WHEN 2 THEN ' ' || CAST(doc_id AS VARCHAR) || ' '
                    WHEN 3 THEN CAST(doc_id AS VARCHAR) || 'e0'
                    ELSE chr(39) || CAST(doc_id AS VARCHAR) END AS guid,
    CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
         ELSE 'neutral' END AS tag
  FROM labels)""",
    "fx_test_manifest": """fx_test_manifest AS (
  SELECT d.doc_id AS row_no, CAST(d.doc_id AS VARCHAR) AS guid FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))""",
    "fx_text": """fx_text AS (
  SELECT CAST(doc_id AS VARCHAR) AS guid, text FROM documents)""",
    "fx_edge_text": """fx_edge_text AS (
  SELECT CAST(doc_id AS VARCHAR) AS guid,
    CASE doc_id % 6 WHEN 0 THEN ' ' || chr(13) || chr(10) || chr(9) || chr(12288)
      WHEN 1 THEN chr(12288) || chr(13) || chr(10) || ' ' || text || ' ' || chr(10)
      WHEN 2 THEN replace(text, ' ', chr(13) || chr(10)) WHEN 3 THEN replace(text, ' ', chr(13))
      ELSE text END AS text FROM documents)""",
    "fx_edge_image": """fx_edge_image AS (
  SELECT CAST(vec_id AS VARCHAR) AS guid, vec_id % 7 <> 0 AS image_ok,
    CASE WHEN vec_id % 9 = 0 THEN list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * 0)
      ELSE CAST(embedding AS DOUBLE[]) END AS px FROM embeddings)""",
    "fx_image_vec": """fx_image_vec AS (
  SELECT CAST(vec_id AS VARCHAR) AS guid, CAST(embedding AS DOUBLE[]) AS img_feat
  FROM embeddings)""",
    "fx_image_long": """fx_image_long AS (
  SELECT CAST(vec_id AS VARCHAR) AS guid, generate_subscripts(embedding, 1) - 1 AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)""",
    "fx_batch_loss": """fx_batch_loss AS (
  SELECT event_id % 5 + 1 AS epoch, (event_id + 43) // 80 AS batch_id, value AS loss
  FROM events)""",
    "fx_history": """fx_history AS (
  SELECT event_id % 5 + 1 AS epoch,
         round(100.0::DOUBLE * avg(CASE WHEN event_type = 'click' THEN 1.0::DOUBLE
                                        ELSE 0.0::DOUBLE END), 6) AS val_acc
  FROM events GROUP BY 1)""",
}

# Oracle forms of the operators used by several queries.
SQL_CTES["norm_manifest"] = """norm_manifest AS (
  SELECT row_no, guid AS raw_guid,
    CASE WHEN guid IS NULL OR guid = '' THEN 'nan'
         WHEN regexp_matches(trim(guid), '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$')
              AND abs(TRY_CAST(trim(guid) AS DOUBLE)) < 9.2e18
         THEN CAST(CAST(trunc(TRY_CAST(trim(guid) AS DOUBLE)) AS BIGINT) AS VARCHAR)
         ELSE guid END AS guid,
    tag,
    CASE tag WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END AS label
  FROM fx_manifest)"""
SQL_CTES["split_rank"] = """split_rank AS (
  SELECT *, row_number() OVER (ORDER BY md5(guid || '|42'), guid, row_no) AS rn,
         count(*) OVER () AS n FROM norm_manifest)"""
SQL_CTES["split"] = """split AS (
  SELECT row_no, guid, tag, label,
         CASE WHEN rn <= ceil(0.2::DOUBLE * n) THEN 'val' ELSE 'train' END AS split
  FROM split_rank)"""
SQL_CTES["txt_tok"] = """txt_tok AS (
  SELECT guid, unnest(string_split_regex(regexp_replace(lower(text), '(\\p{Han})', ' \\1 ', 'g'), '[^\\p{L}\\p{N}]+')) AS w FROM fx_text)"""
SQL_CTES["txt_bucket"] = """txt_bucket AS (
  SELECT guid, ('0x' || substr(md5(w), 1, 8))::BIGINT % 32 AS pos, count(*) AS c
  FROM txt_tok WHERE w <> '' GROUP BY 1, 2)"""
SQL_CTES["txt_long"] = """txt_long AS (
  SELECT b.guid, b.pos, b.c / sqrt(n.ss) AS v
  FROM txt_bucket b JOIN (SELECT guid, sum(c * c) AS ss FROM txt_bucket GROUP BY 1) n
  ON b.guid = n.guid)"""
# long-form fused features of labelled rows: image block 0-63, text block 64-95
SQL_CTES["fe"] = """fe AS (
  SELECT s.guid, s.label, s.split, i.pos, i.v, 'img' AS md
  FROM split s JOIN fx_image_long i ON i.guid = s.guid
  UNION ALL
  SELECT s.guid, s.label, s.split, 64 + t.pos, t.v, 'txt' AS md
  FROM split s JOIN txt_long t ON t.guid = s.guid)"""
SQL_CTES["class_n"] = """class_n AS (
  SELECT label AS k, count(*) AS n FROM split WHERE split = 'train' GROUP BY 1)"""
SQL_CTES["centroid"] = """centroid AS (
  SELECT ce.k, ce.pos, ce.md, ce.sv / cn.n AS mu
  FROM (SELECT label AS k, pos, md, sum(v) AS sv FROM fe WHERE split = 'train'
        GROUP BY 1, 2, 3) ce JOIN class_n cn ON ce.k = cn.k)"""
SQL_CTES["modes"] = """modes AS (
  SELECT 'multimodal' AS mode UNION ALL SELECT 'text_only' UNION ALL SELECT 'image_only')"""
SQL_CTES["cnorm"] = """cnorm AS (
  SELECT c.k, m.mode, sum(c.mu * c.mu) AS n2 FROM centroid c, modes m
  WHERE (m.mode <> 'text_only' OR c.md = 'txt') AND (m.mode <> 'image_only' OR c.md = 'img')
  GROUP BY 1, 2)"""
SQL_CTES["cdot"] = """cdot AS (
  SELECT f.guid, c.k, m.mode, sum(f.v * c.mu) AS dt
  FROM fe f JOIN centroid c ON f.pos = c.pos AND f.md = c.md, modes m
  WHERE f.split = 'val' AND (m.mode <> 'text_only' OR f.md = 'txt')
    AND (m.mode <> 'image_only' OR f.md = 'img')
  GROUP BY 1, 2, 3)"""
SQL_CTES["val_logit"] = """val_logit AS (
  SELECT v.row_no, v.guid, v.label, v.tag, cn.k, cn.mode,
         round(coalesce(d.dt, 0) - 0.5 * cn.n2, 9) AS z
  FROM (SELECT * FROM split WHERE split = 'val') v CROSS JOIN cnorm cn
  LEFT JOIN cdot d ON d.guid = v.guid AND d.k = cn.k AND d.mode = cn.mode)"""
SQL_CTES["val_pred"] = """val_pred AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY guid, mode ORDER BY z DESC, k) AS rk
                 FROM val_logit) WHERE rk = 1)"""

SQL_CTES["test_fe"] = """test_fe AS (
  SELECT m.guid, i.pos, i.v, 'img' AS md FROM fx_test_manifest m JOIN fx_image_long i ON i.guid = m.guid
  UNION ALL
  SELECT m.guid, 64 + t.pos, t.v, 'txt' AS md FROM fx_test_manifest m JOIN txt_long t ON t.guid = m.guid)"""
SQL_CTES["test_dot"] = """test_dot AS (
  SELECT f.guid, c.k, sum(f.v * c.mu) AS dt
  FROM test_fe f JOIN centroid c ON f.pos = c.pos AND f.md = c.md GROUP BY 1, 2)"""
SQL_CTES["test_logit"] = """test_logit AS (
  SELECT m.row_no, m.guid, cn.k, round(coalesce(d.dt, 0) - 0.5 * cn.n2, 9) AS z
  FROM fx_test_manifest m CROSS JOIN (SELECT * FROM cnorm WHERE mode = 'multimodal') cn
  LEFT JOIN test_dot d ON d.guid = m.guid AND d.k = cn.k)"""
SQL_CTES["test_pred"] = """test_pred AS (
  SELECT row_no, guid, k,
         CASE k WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS tag
  FROM (SELECT *, row_number() OVER (PARTITION BY guid ORDER BY z DESC, k) AS rk FROM test_logit)
  WHERE rk = 1)"""

# dependency order of the CTEs above
_DEPS = {
    "norm_manifest": ["fx_manifest"],
    "split_rank": ["norm_manifest"],
    "split": ["split_rank"],
    "txt_tok": ["fx_text"],
    "txt_bucket": ["txt_tok"],
    "txt_long": ["txt_bucket"],
    "fe": ["split", "fx_image_long", "txt_long"],
    "class_n": ["split"],
    "centroid": ["fe", "class_n"],
    "cnorm": ["centroid", "modes"],
    "cdot": ["fe", "centroid", "modes"],
    "val_logit": ["split", "cnorm", "cdot"],
    "val_pred": ["val_logit"],
    "test_fe": ["fx_test_manifest", "fx_image_long", "txt_long"],
    "test_dot": ["test_fe", "centroid"],
    "test_logit": ["fx_test_manifest", "cnorm", "test_dot"],
    "test_pred": ["test_logit"],
}


def with_ctes(body: str, *needed: str) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _DEPS.get(name, []):
            visit(dep)
        order.append(name)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(SQL_CTES[n] for n in order) + "\n" + body
