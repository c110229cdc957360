"""Corpus and probability audits.

Every manifest row is audited with one left join to both modalities, and the summary is a single aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinlens.functions.arrays import softmax
from twinlens.functions.labels import decode_label
from twinlens.functions.text import is_blank, preview
from twinlens.operators.modality import join_sides, lookup_join


def audit_rows(manifest: DataFrame, texts: DataFrame, images: DataFrame,
               guid_col: str = "guid", text_col: str = "text",
               px_col: str | None = "px") -> DataFrame:
    """Per-row flags: files present, readable, empty text, all-black image.

    ``texts``: ``(guid, text[, text_ok])``, or the flags already reduced from
    the text, ``(guid, text_empty, text_preview[, text_ok])``; ``images``:
    ``(guid, px | image[, image_ok])``. Image size comes from the decoded
    struct when present (B12). Text flags are computed on the text side, so
    the joins shuffle a flag and a 50-character preview, never whole texts.
    """
    tok = F.col("text_ok") if "text_ok" in texts.columns else F.lit(True)
    if "text_empty" in texts.columns:
        empty, prev = F.col("text_empty"), F.col("text_preview")
    else:
        txt = F.coalesce(F.col(text_col), F.lit(""))
        empty, prev = is_blank(txt), preview(txt)
    t = texts.select(F.col(guid_col).alias("_g"), tok.alias("_tok"), empty.alias("_empty"),
                     prev.alias("_prev"))
    img_cols = [F.col(guid_col).alias("_gi"),
                (F.col("image_ok") if "image_ok" in images.columns else F.lit(True)).alias("_iok")]
    has_size = "image" in images.columns or "width" in images.columns
    if "image" in images.columns:
        img_cols += [F.col("image.width").alias("width"), F.col("image.height").alias("height")]
    elif "width" in images.columns:
        img_cols += [F.col("width"), F.col("height")]
    if px_col and px_col in images.columns:
        img_cols.append(((F.array_max(px_col) == 0) & (F.array_min(px_col) == 0)).alias("_px"))
    has_black = "image_black" in images.columns
    if has_black:
        img_cols.append(F.col("image_black").alias("_blk"))
    i = images.select(*img_cols)
    t, i = t.withColumn(guid_col, F.col("_g")), i.withColumn(guid_col, F.col("_gi"))
    j = lookup_join(manifest, join_sides(t, i, guid_col), guid_col)
    out = j.select(
        *[c for c in manifest.columns],
        F.col("_g").isNotNull().alias("text_exists"),
        F.coalesce(F.col("_tok"), F.lit(False)).alias("text_readable"),
        (F.col("_g").isNotNull() & F.coalesce(F.col("_empty"), F.lit(True))).alias("text_empty"),
        F.coalesce(F.col("_prev"), F.lit("")).alias("text_preview"),
        F.col("_gi").isNotNull().alias("image_exists"),
        F.coalesce(F.col("_iok"), F.lit(False)).alias("image_readable"),
        *([F.col("width"), F.col("height")] if has_size else []),
        *([F.col("_px").alias("image_black")]
          if px_col and px_col in images.columns else []),
        *([F.coalesce(F.col("_blk"), F.lit(False)).alias("image_black")] if has_black else []),
    )
    return out


def audit_summary(rows: DataFrame) -> DataFrame:
    """One row of counts over the audited corpus."""
    def n(c):
        return F.sum(F.col(c).cast("int")).cast("bigint")
    aggs = [F.count(F.lit(1)).alias("total"), n("text_exists").alias("n_text"),
            n("text_readable").alias("n_text_readable"), n("text_empty").alias("n_text_empty"),
            n("image_exists").alias("n_image"),
            n("image_readable").alias("n_image_readable")]
    if "image_black" in rows.columns:
        aggs.append(F.sum(F.coalesce(F.col("image_black"), F.lit(False)).cast("int"))
                    .cast("bigint").alias("n_image_black"))
    return rows.agg(*aggs)


def audit_probabilities(scored: DataFrame, logits_col: str = "logits", pred_col: str = "pred",
                        cls: int = 0, threshold: float = 0.9) -> DataFrame:
    """Softmax probabilities, predicted tag and the over-confidence flag."""
    return (scored.withColumn("probs", softmax(logits_col))
            .withColumn("pred_tag", decode_label(pred_col))
            .withColumn("overconfident", F.col("probs")[cls] > F.lit(threshold)))


def overconfidence_report(audited: DataFrame, cls: int = 0) -> DataFrame:
    """Per predicted tag: rows, rows over the threshold, mean P(class)."""
    return (audited.groupBy("pred_tag")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.col("overconfident").cast("int")).cast("bigint").alias("n_over"),
                 F.round(F.avg(F.col("probs")[cls]), 6).alias("mean_p")))
