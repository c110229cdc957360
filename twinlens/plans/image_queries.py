"""Registered image queries over whole transform chains, with their SQL.

Input: the image structs that ``registry`` derives from ``embeddings`` (8x8,
three channels). The SQL resamples by joins with a weight table, turns and
flips by index arithmetic and counts histogram bins by their edges.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from twinlens.functions.text import decode_report, is_blank, preview
from twinlens.operators import image_prep as ip
from twinlens.operators import image_steps as st
from twinlens.operators.audit import audit_rows
from twinlens.operators.modality import prepare_manifest
from twinlens.plans.fixtures import fx_edge_blob, fx_manifest, with_ctes
from twinlens.plans.registry import _image_structs, _long, _strip_sql, register
from twinlens.session import spread

#: Side of the given rasters, of the encoded image and of the augmented one.
SIDE, ENCODED, AUGMENTED = 8, 12, 6
EPOCHS = (1, 2)

# channel planes in RGB order, values in [0, 1]
_PLANES = f"""q AS (
  SELECT CAST(vec_id AS VARCHAR) AS guid, list_transform(embedding, lambda x:
         CAST(least(greatest(round((CAST(x AS DOUBLE) + 4.0) * 32.0), 0.0), 255.0) AS INTEGER)) AS q
  FROM embeddings),
plane AS (
  SELECT guid, c.range AS c, p.range // {SIDE} AS y, p.range % {SIDE} AS x,
         CASE c.range WHEN 0 THEN q[p.range + 1] WHEN 1 THEN q[{SIDE * SIDE} - p.range] // 2
                      ELSE 255 - q[p.range + 1] END / 255.0::DOUBLE AS v
  FROM q, range(3) c, range({SIDE * SIDE}) p)"""


def _weights_sql(name: str, size: int) -> str:
    """Triangle filter from SIDE to ``size`` samples, widened when shrinking; weights of a sample sum to 1."""
    scale = f"({SIDE}.0::DOUBLE / {size}.0::DOUBLE)"
    reach = f"greatest({scale}, 1.0)"
    return f"""{name} AS (
  SELECT o, x, w / sum(w) OVER (PARTITION BY o) AS w FROM (
    SELECT o.range AS o, x.range AS x,
           greatest(0.0::DOUBLE, 1.0 - abs((x.range - (o.range + 0.5) * {scale} + 0.5) / {reach})) AS w
    FROM range({size}) o, range({SIDE}) x
    WHERE x.range >= greatest(floor((o.range + 0.5) * {scale} - {reach} + 0.5), 0)
      AND x.range < least(floor((o.range + 0.5) * {scale} + {reach} + 0.5), {SIDE})) t)"""


def _resized_sql(size: int) -> str:
    return f"""{_PLANES},
{_weights_sql("rw", size)},
resized AS (
  SELECT guid, c, ry.o AS y, rx.o AS x, sum(ry.w * rx.w * v) AS v
  FROM plane JOIN rw ry ON ry.x = plane.y JOIN rw rx ON rx.x = plane.x GROUP BY guid, c, ry.o, rx.o)"""


def _by_channel(values) -> str:
    return f"CASE c WHEN 0 THEN {values[0]!r}::DOUBLE WHEN 1 THEN {values[1]!r}::DOUBLE ELSE {values[2]!r}::DOUBLE END"


_NORMAL = f"(v - {_by_channel(ip.MEAN)}) / ({_by_channel(ip.STD)})"


@register("image_struct_vector", f"""WITH {_resized_sql(ENCODED)},
n AS (SELECT guid, c, y, x, {_NORMAL} AS v FROM resized),
bin AS (SELECT range AS b, -2.5::DOUBLE + range * 0.65625::DOUBLE AS low FROM range(8))
SELECT guid, c * 16 + (y // 3) * 4 + x // 3 AS pos, round(avg(v), 9) AS v FROM n GROUP BY guid, c, y // 3, x // 3
UNION ALL
SELECT n.guid, 48 + n.c * 8 + b AS pos,
       round(sum(CASE WHEN n.v >= low AND (n.v < low + 0.65625::DOUBLE OR b = 7 AND n.v = 2.75) THEN 1.0 ELSE 0.0 END)
             / {ENCODED * ENCODED}, 9) AS v
FROM n, bin GROUP BY n.guid, n.c, b""")
def q_image_struct_vector(spark, sf):
    """All values of the built-in image encoder in evaluation mode: RGB, resize, normalise, grid and histogram."""
    f = ip.image_features(_image_structs(spark, sf), "image", "guid", ip.grid_encoder, 72, train=False, size=ENCODED)
    return _long(f, ["guid"], "img_feat", 9, nonzero=False)


_EDGES = " + ".join(f"(v >= {-2.5 + 0.65625 * k!r}::DOUBLE)::INTEGER" for k in range(1, 8))

# enlarging takes two samples an axis at most; sums are by cell and by bin, no raster is grouped
@register("image_struct_features", f"""WITH {_PLANES},
{_weights_sql("rw", ip.SIZE)},
tap AS (SELECT o, min(x) AS i0, min_by(w, x) AS w0, max(x) AS i1,
               CASE WHEN count(*) = 1 THEN 0.0::DOUBLE ELSE max_by(w, x) END AS w1
        FROM rw WHERE w > 0 GROUP BY o),
flat AS (SELECT guid, c, list(v ORDER BY y, x) AS px FROM plane GROUP BY guid, c),
large AS (
  SELECT guid, c, ty.o AS y, tx.o AS x,
         ty.w0 * (tx.w0 * px[ty.i0 * {SIDE} + tx.i0 + 1] + tx.w1 * px[ty.i0 * {SIDE} + tx.i1 + 1])
         + ty.w1 * (tx.w0 * px[ty.i1 * {SIDE} + tx.i0 + 1] + tx.w1 * px[ty.i1 * {SIDE} + tx.i1 + 1]) AS v
  FROM flat, tap ty, tap tx),
n AS (SELECT guid, c, y, x, {_NORMAL} AS v FROM large),
f AS (SELECT avg(v) AS v, guid FROM n GROUP BY guid, c, y // {ip.SIZE // 4}, x // {ip.SIZE // 4}
      UNION ALL SELECT count(*) / {ip.SIZE * ip.SIZE}.0::DOUBLE, guid FROM n GROUP BY guid, c, {_EDGES})
SELECT guid, CAST(72 AS INTEGER) AS n_dims, round(sum(v * v), 9) AS sq_norm FROM f GROUP BY guid""")
def q_image_struct_features(spark, sf):
    """Evaluation-mode image pipeline (I1, I4-I7) at the full size of 224, in Arrow batches where the images sit."""
    f = ip.image_features(spread(_image_structs(spark, sf)), "image", "guid", ip.grid_encoder, 72, train=False)
    sq = F.aggregate("img_feat", F.lit(0.0), lambda a, x: a + x * x)
    return f.select("guid", F.size("img_feat").alias("n_dims"), F.round(sq, 9).alias("sq_norm"))


@register("image_augment", f"""WITH {_resized_sql(AUGMENTED)},
flat AS (SELECT guid, c, list(v ORDER BY y, x) AS px FROM resized GROUP BY guid, c),
drawn AS (
  SELECT *, CAST('0x' || substr(md5(guid || '|' || epoch || '|42|flip'), 1, 8) AS BIGINT)
            < {ip.flip_threshold(0.5)} AS flipped,
         -15.0::DOUBLE + 30.0::DOUBLE
           * (CAST('0x' || substr(md5(guid || '|' || epoch || '|42|rot'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE) AS angle
  FROM (SELECT CAST(vec_id AS VARCHAR) AS guid, e.epoch FROM embeddings, (VALUES (1), (2)) e(epoch)) k),
turn AS (
  SELECT *, round(cos(-angle * pi() / 180.0::DOUBLE), 15) AS co, round(sin(-angle * pi() / 180.0::DOUBLE), 15) AS si
  FROM drawn),
source AS (
  SELECT guid, epoch, flipped, p.range AS p,
         CAST(floor(co * (p.range % {AUGMENTED} + 0.5::DOUBLE - {AUGMENTED / 2}::DOUBLE)
                    + si * (p.range // {AUGMENTED} + 0.5::DOUBLE - {AUGMENTED / 2}::DOUBLE)
                    + {AUGMENTED / 2}::DOUBLE) AS BIGINT) AS xi,
         CAST(floor(-si * (p.range % {AUGMENTED} + 0.5::DOUBLE - {AUGMENTED / 2}::DOUBLE)
                    + co * (p.range // {AUGMENTED} + 0.5::DOUBLE - {AUGMENTED / 2}::DOUBLE)
                    + {AUGMENTED / 2}::DOUBLE) AS BIGINT) AS yi
  FROM turn, range({AUGMENTED * AUGMENTED}) p),
turned AS (
  SELECT source.guid, epoch, c, p,
         CASE WHEN xi >= 0 AND xi < {AUGMENTED} AND yi >= 0 AND yi < {AUGMENTED}
              THEN px[yi * {AUGMENTED} + CASE WHEN flipped THEN {AUGMENTED - 1} - xi ELSE xi END + 1]
              ELSE 0.0::DOUBLE END AS v
  FROM source JOIN flat ON flat.guid = source.guid)
SELECT guid, epoch, c * {AUGMENTED * AUGMENTED} + p AS pos, round({_NORMAL}, 9) AS v FROM turned""")
def q_image_augment(spark, sf):
    """The training chain (resize, flip, rotate, normalise) in two epochs, each with draws of its own."""
    images = _image_structs(spark, sf)
    chain = st.standard(AUGMENTED)
    out = None
    for epoch in EPOCHS:
        t = ip.image_tensors(images, chain, train=True, epoch=epoch).select(
            "guid", F.lit(epoch).alias("epoch"), "tensor")
        out = t if out is None else out.union(t)
    return _long(out, ["guid", "epoch"], "tensor", 9, nonzero=False)


def centre_crop(images, draws):
    """A step of a caller's own: the middle 6 x 6 pixels."""
    return [x[1:7, 1:7] for x in images]


def pooled():
    """An encoder with nested output, ``[n, 12, 1, 1]``: the mean of each quarter of each channel."""
    def encode(batch):
        n, c, h, w = batch.shape
        return batch.reshape(n, c, 2, h // 2, 2, w // 2).mean(axis=(3, 5)).reshape(n, c * 4, 1, 1)
    return encode


@register("image_custom_chain", f"""WITH {_PLANES}
SELECT guid, c * 4 + ((y - 1) // 3) * 2 + (x - 1) // 3 AS pos, round(avg((v - 0.5::DOUBLE) / 0.25::DOUBLE), 9) AS v
FROM plane WHERE x BETWEEN 1 AND 6 AND y BETWEEN 1 AND 6 GROUP BY guid, c, (y - 1) // 3, (x - 1) // 3""")
def q_image_custom_chain(spark, sf):
    """A caller's chain (crop, other channel statistics) and an encoder whose nested output is flattened."""
    chain = st.Transform((centre_crop, st.Normalize((0.5,) * 3, (0.25,) * 3)))
    f = ip.image_features(_image_structs(spark, sf), encoder_factory=pooled, dim=12, transform=chain)
    return _long(f, ["guid"], "img_feat", 9, nonzero=False)


def _uneven_structs(spark, sf):
    """The structs with 8, 7 or 6 rows of pixels by id; every seventh undecodable, every ninth black."""
    im, n = F.col("image"), F.col("guid").cast("bigint")
    height = (SIDE - n % 3).cast("int")
    size = height * SIDE * 3
    data = F.when(n % 9 == 0, F.unhex(F.repeat(F.lit("00"), size))).otherwise(F.substring(im["data"], F.lit(1), size))
    bad, no = n % 7 == 0, F.lit(-1)
    image = F.struct(im["origin"].alias("origin"), F.when(bad, no).otherwise(height).alias("height"),
                     F.when(bad, no).otherwise(SIDE).alias("width"), F.when(bad, no).otherwise(3).alias("nChannels"),
                     F.when(bad, no).otherwise(16).alias("mode"), F.when(bad, F.unhex(F.lit(""))).otherwise(data).alias("data"))
    return _image_structs(spark, sf).select("guid", image.alias("image"))


@register("audit_rows", with_ctes(f"""
SELECT m.row_no, m.guid, t.guid IS NOT NULL AS text_exists,
       t.guid IS NOT NULL AND CAST(t.guid AS BIGINT) % 10 NOT IN (1, 4, 7) AS text_readable,
       t.guid IS NOT NULL AND length(t.s) = 0 AS text_empty, coalesce(substring(t.s, 1, 50), '') AS text_preview,
       i.vec_id IS NOT NULL AS image_exists, i.vec_id IS NOT NULL AND i.vec_id % 7 <> 0 AS image_readable,
       CAST(CASE WHEN i.vec_id % 7 = 0 THEN -1 WHEN i.vec_id IS NOT NULL THEN {SIDE} END AS INTEGER) AS width,
       CAST(CASE WHEN i.vec_id % 7 = 0 THEN -1 ELSE {SIDE} - i.vec_id % 3 END AS INTEGER) AS height,
       coalesce(i.vec_id % 7 <> 0 AND i.vec_id % 9 = 0, false) AS image_black
FROM norm_manifest m
LEFT JOIN (SELECT guid, {_strip_sql("replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))")} AS s
           FROM fx_edge_text) t ON t.guid = m.guid
LEFT JOIN (SELECT CAST(vec_id AS VARCHAR) AS guid, vec_id FROM embeddings) i ON i.guid = m.guid""",
    "norm_manifest", "fx_edge_text"))
def q_audit_rows(spark, sf):
    """Every manifest row's audit: files there and readable, text preview, image size, all black."""
    texts = fx_edge_blob(spark, sf).select("guid", decode_report("blob").alias("r")).select(
        "guid", F.col("r.ok").alias("text_ok"), is_blank("r.text").alias("text_empty"),
        preview("r.text").alias("text_preview"))
    images = _uneven_structs(spark, sf)
    flags = images.select("guid", (F.col("image.nChannels") > 0).alias("image_ok"), F.col("image.width").alias("width"),
                          F.col("image.height").alias("height"),
                          ip.all_black(F.col("image.data"), F.col("image.nChannels")).alias("image_black"))
    rows = audit_rows(prepare_manifest(fx_manifest(spark, sf)), texts, flags, px_col=None)
    return rows.select("row_no", "guid", "text_exists", "text_readable", "text_empty", "text_preview", "image_exists",
                       "image_readable", "width", "height", "image_black")
