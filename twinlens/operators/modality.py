"""Attach modalities to a manifest.

Lookups are left outer joins on the normalised guid: every manifest row
survives exactly once (blob tables hold one row per guid), and a missing side
gets its default plus a ``has_*`` flag instead of being dropped. Spark picks
broadcast or sort-merge at run time (AQE); a left outer join can only
broadcast its right side, which is what a small blob table needs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinlens.functions.guid import normalize_guid
from twinlens.functions.labels import encode_label
from twinlens.session import materialize

# A guid with more manifest rows than this is hot. With AQE's skew join on
# (Spark's default) the join is split at run time; with it off, hot guids are
# salted over several join tasks.
HOT_GUID_ROWS = 1_000_000
MAX_HOT_GUIDS = 10_000
MAX_SALT = 1024


def _aqe_splits_skew(spark) -> bool:
    conf = spark.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")


def lookup_join(m: DataFrame, side: DataFrame, key: str = "guid") -> DataFrame:
    """``m`` left outer join ``side`` on ``key``; ``side`` has one row per key.

    Without AQE's skew split, guids holding more than ``HOT_GUID_ROWS`` manifest
    rows (at most ``MAX_HOT_GUIDS``, found by one partial + final aggregate) are
    salted: their manifest rows spread over ``n`` salts by ``row_no`` (or a hash
    of the row) and their one blob row is copied ``n`` times. Every manifest row
    still meets its blob row exactly once.
    """
    # a stream's micro-batches are bounded by its trigger; no hot-key pass there
    if m.isStreaming or _aqe_splits_skew(m.sparkSession):
        return m.join(side, key, "left")
    hot = (m.groupBy(key).count().where(F.col("count") > HOT_GUID_ROWS)
           .orderBy(F.desc("count")).limit(MAX_HOT_GUIDS).collect())
    if not hot:
        return m.join(side, key, "left")
    n = min(MAX_SALT, math.ceil(max(r["count"] for r in hot) / HOT_GUID_ROWS))
    is_hot = F.col(key).isin([r[key] for r in hot])
    row_key = F.col("row_no") if "row_no" in m.columns else F.xxhash64(*m.columns)
    ms = m.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(row_key), F.lit(n)))
                      .otherwise(F.lit(0)).cast("bigint"))
    ss = (side.where(is_hot)
          .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                    F.lit(n - 1).cast("bigint"))))
          .unionByName(side.where(~is_hot).withColumn("_salt", F.lit(0).cast("bigint"))))
    return ms.join(ss, [key, "_salt"], "left").drop("_salt")


def join_sides(a: DataFrame, b: DataFrame, key: str = "guid") -> DataFrame:
    """One row per key with the columns of two modality tables, written out.

    Either table has one row per key, so this join has no hot key. The manifest
    then needs one join, between plain scans: adaptive execution can split a
    hot guid there, which it can't in a chain of joins or beside an aggregate.
    """
    return materialize(a.join(b, key, "full_outer"), "modalities")


def prepare_manifest(df: DataFrame, labelled: bool = True, strict: bool = True) -> DataFrame:
    """Normalise guids and (labelled mode) encode tags.

    Labelled rows carry ``label``; unlabelled rows do not.
    """
    cols = [F.col("row_no"), F.col("guid").alias("raw_guid"), normalize_guid("guid").alias("guid")]
    if labelled:
        cols += [F.col("tag"), encode_label("tag", strict=strict).alias("label")]
    return df.select(*cols)


def attach_text(m: DataFrame, texts: DataFrame, guid_col: str = "guid",
                text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """Manifest ⟕ text; missing -> ``''`` with ``has_text = false``.

    ``extra`` columns of the text table (e.g. precomputed features) ride along.
    A text table of encoded columns only (no ``text_col``) attaches just those:
    ``has_text`` marks a match and no raw text crosses the join.
    """
    raw = text_col in texts.columns
    t = texts.select(F.col(guid_col).alias(guid_col),
                     (F.col(text_col) if raw else F.lit(True)).alias("_t"), *extra)
    j = lookup_join(m, t, guid_col).withColumn("has_text", F.col("_t").isNotNull())
    if raw:
        j = j.withColumn(text_col, F.coalesce(F.col("_t"), F.lit("")))
    return j.drop("_t")


def attach_images(m: DataFrame, images: DataFrame, guid_col: str = "guid",
                  image_col: str = "img_feat", ok_col: str | None = None) -> DataFrame:
    """Manifest ⟕ image.

    ``has_image`` is false for a missing or undecodable image; the column is
    left NULL there and the default is applied after feature extraction
    (one constant vector), never as a per-row default raster.
    """
    keep = [F.col(guid_col), F.col(image_col).alias("_i")]
    if ok_col:
        keep.append(F.col(ok_col).alias("_ok"))
    j = lookup_join(m, images.select(*keep), guid_col)
    ok = F.col("_i").isNotNull() & (F.col("_ok") if ok_col else F.lit(True))
    return (j.withColumn("has_image", F.coalesce(ok, F.lit(False)))
            .withColumn(image_col, F.when(F.col("has_image"), F.col("_i")))
            .drop("_i", *(["_ok"] if ok_col else [])))


def attach_modalities(m: DataFrame, texts: DataFrame, images: DataFrame, extra: tuple[str, ...] = (),
                      guid_col: str = "guid", image_col: str = "img_feat", ok_col: str | None = None) -> DataFrame:
    """Manifest ⟕ (texts ⟗ images) with a single manifest join.

    Adds ``has_text``, the ``extra`` text columns, ``has_image`` and
    ``image_col`` as ``attach_text`` followed by ``attach_images`` would.
    """
    t = texts.select(guid_col, F.lit(True).alias("_t"), *extra)
    i = images.select(guid_col, F.col(image_col).alias("_i"), (F.col(ok_col) if ok_col else F.lit(True)).alias("_ok"))
    j = lookup_join(m, join_sides(t, i, guid_col), guid_col)
    return (j.withColumn("has_text", F.col("_t").isNotNull())
            .withColumn("has_image", F.coalesce(F.col("_i").isNotNull() & F.col("_ok"), F.lit(False)))
            .withColumn(image_col, F.when(F.col("has_image"), F.col("_i"))).drop("_t", "_i", "_ok"))
