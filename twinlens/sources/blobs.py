"""Per-guid text and image files (A3, A4).

Both readers return one row per guid. When a folder holds the same guid twice
(two sub-folders), the lexicographically first path wins; the aggregate runs on
``guid``, so the following join on ``guid`` reuses its partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinlens.functions.text import decode_report

# Largest set of manifest guids broadcast to cut a blob listing before decoding.
MAX_SEMI_KEYS = 1_000_000


def _guid_from_path(path_col, ext: str):
    # file names are URI-encoded by the sources; decode before matching guids
    name = F.regexp_extract(path_col, rf"([^/]+)\.{ext}$", 1)
    return F.url_decode(name)


def manifest_keys(manifest: DataFrame, guid_col: str = "guid",
                  limit: int | None = None) -> DataFrame | None:
    """Distinct manifest guids to broadcast, or None above ``limit``.

    With keys, the readers keep only the manifest's blobs before any decoding
    or encoding (a broadcast semi join inside the scan stage). Above the bound
    every blob is encoded and the manifest join drops the rest; raw bytes are
    never shuffled either way.
    """
    limit = MAX_SEMI_KEYS if limit is None else limit
    keys = manifest.select(F.col(guid_col).alias("guid")).where(F.col("guid").isNotNull()).distinct()
    if keys.count() > limit:
        return None
    return F.broadcast(keys)


def _only(df: DataFrame, guids: DataFrame | None) -> DataFrame:
    return df if guids is None else df.join(guids, "guid", "left_semi")


def _load(reader, folder: str, ext: str, recursive: bool) -> DataFrame:
    """Top-level ``folder/*.ext`` (the reference layout), or every level."""
    if recursive:
        return (reader.option("pathGlobFilter", f"*.{ext}").option("recursiveFileLookup", True)
                .load(folder))
    return reader.load(f"{folder.rstrip('/')}/*.{ext}")


def read_text_blobs(spark: SparkSession, folder: str, encoding: str = "gb18030",
                    recursive: bool = False, dedupe: bool = True,
                    guids: DataFrame | None = None) -> DataFrame:
    """``{guid}.txt`` files -> ``(guid, text, text_ok)`` (``path`` too without dedupe).

    Bytes are decoded (Arrow batches) with malformed sequences dropped, then
    stripped, before any shuffle; ``text_ok`` says whether there were none (B11). ``guids`` (see ``manifest_keys``) keeps only
    those files, before decoding.
    """
    raw = _load(spark.read.format("binaryFile"), folder, "txt", recursive)
    raw = _only(raw.select(_guid_from_path(F.col("path"), "txt").alias("guid"), "path", "content"),
                guids)
    df = raw.select("guid", "path", decode_report(F.col("content"), encoding).alias("_r")).select(
        "guid", "path", F.col("_r.text").alias("text"), F.col("_r.ok").alias("text_ok"))
    return first_per_guid(df, "path") if dedupe else df


def first_per_guid(df: DataFrame, path_col: str) -> DataFrame:
    """One row per guid: the lexicographically first path wins (partial + final aggregate)."""
    cols = [c for c in df.columns if c not in ("guid", path_col)]
    agg = df.groupBy("guid").agg(F.min_by(F.struct(*cols), F.col(path_col)).alias("_f"))
    return agg.select("guid", *[F.col(f"_f.{c}").alias(c) for c in cols])


def read_image_blobs(spark: SparkSession, folder: str, recursive: bool = False,
                     dedupe: bool = True, guids: DataFrame | None = None) -> DataFrame:
    """``{guid}.jpg`` files -> ``(guid, image, image_ok)`` (``origin`` too without dedupe).

    Spark's image source decodes in the JVM (BGR order); an undecodable file
    keeps its row with ``nChannels = -1`` so the audit can count it. For
    feature extraction read with ``dedupe=False``, encode, then dedupe: only
    feature vectors are shuffled, never the decoded rasters. ``guids`` keeps
    only those files before any Python work.
    """
    raw = _load(spark.read.format("image").option("dropInvalid", False), folder, "jpg", recursive)
    df = _only(raw.select(_guid_from_path(F.col("image.origin"), "jpg").alias("guid"),
                          F.col("image.origin").alias("origin"), F.col("image"),
                          (F.col("image.nChannels") > 0).alias("image_ok")), guids)
    return first_per_guid(df, "origin") if dedupe else df
