"""Image preparation.

Two realisations of the same steps:

* array expressions on small rasters stored as ``ARRAY<DOUBLE>`` (the 8x8
  fixture grids): flip, rotation, resize, normalise, extrema and channel
  statistics run JVM-side and are checked against SQL;
* ``image_features``: one Arrow-batch column function over decoded image
  structs that converts to RGB, runs a chain of steps (``image_steps``: resize,
  augment in training, normalise, or any other) and encodes. The tensor lives
  only inside the batch; what leaves Python is the feature vector.

Random augmentation is keyed: the draw for a row is
``md5(guid|epoch|seed|step)``, identical in both realisations and in SQL, and
independent of partitioning and order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinlens.functions.udf import arrow_udf

# ImageNet channel statistics used by the reference transforms.
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)
SIZE = 224

_TWO32 = 4294967296


# ------------------------------------------------------------- keyed draws

def draw_expr(guid: Column, epoch: int, seed: int, step: str) -> Column:
    """Uniform [0, 1) draw per row as a native expression."""
    h = F.md5(F.concat(guid.cast("string"), F.lit(f"|{epoch}|{seed}|{step}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def draw_py(guid: str, epoch: int, seed: int, step: str) -> int:
    return int(hashlib.md5(f"{guid}|{epoch}|{seed}|{step}".encode()).hexdigest()[:8], 16)


def flip_threshold(p: float = 0.5) -> int:
    return int(math.floor(p * _TWO32))


def angle_of(draw, degrees: float = 15.0):
    """Uniform angle in [-degrees, degrees) from a 32-bit draw."""
    return -degrees + (2.0 * degrees) * (draw / float(_TWO32))


# ---------------------------------------------------------------- weights

def resize_weights(n_in: int, n_out: int) -> np.ndarray:
    """Bilinear resampling weights with antialiasing on downscale, ``[n_out, n_in]``.

    The usual triangle filter of public image libraries (Pillow's BILINEAR).

    Output sample ``o`` is centred at ``(o + 0.5) * scale``; the triangle filter
    is widened by ``scale`` when shrinking, and each row is normalised.
    """
    scale = n_in / n_out
    fs = max(scale, 1.0)
    support = 1.0 * fs
    w = np.zeros((n_out, n_in))
    for o in range(n_out):
        center = (o + 0.5) * scale
        lo = max(int(math.floor(center - support + 0.5)), 0)
        hi = min(int(math.floor(center + support + 0.5)), n_in)
        for x in range(lo, hi):
            t = abs((x - center + 0.5) / fs)
            w[o, x] = max(0.0, 1.0 - t)
        s = w[o].sum()
        if s != 0:
            w[o] /= s
    return w


# ---------------------------------------------------- array-raster versions

def hflip_grid(px: Column, h: int, w: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)),
                       lambda i: F.element_at(px, F.floor(i / w).cast("int") * w + (w - 1) - i % w + 1))


def random_hflip_grid(px: Column, guid: Column, h: int, w: int, epoch: int = 1,
                      seed: int = 42, p: float = 0.5) -> tuple[Column, Column]:
    """``(flipped?, raster)`` with a keyed p-draw per row."""
    flipped = draw_expr(guid, epoch, seed, "flip") < F.lit(flip_threshold(p))
    return flipped, F.when(flipped, hflip_grid(px, h, w)).otherwise(px)


def rotation_cos_sin(angle: Column) -> tuple[Column, Column]:
    a = -angle * F.lit(math.pi) / F.lit(180.0)
    return F.round(F.cos(a), 15), F.round(F.sin(a), 15)


def rotate_grid(px: Column, c: Column, s: Column, h: int, w: int, fill: float = 0.0) -> Column:
    """Rotate about the centre, nearest neighbour, same size, fill outside.

    Output pixel centre ``(x + .5, y + .5)`` maps back through the inverse
    rotation; the source index is the floor of the mapped point. ``c``/``s``
    are the cosine and sine columns (computed once per row, see
    ``random_rotate_grid``).
    """
    cx, cy = w / 2.0, h / 2.0

    def pick(i):
        dx = (i % w).cast("double") + F.lit(0.5 - cx)
        dy = F.floor(i / w).cast("double") + F.lit(0.5 - cy)
        xin = c * dx + s * dy + F.lit(cx)
        yin = -s * dx + c * dy + F.lit(cy)
        xi, yi = F.floor(xin).cast("int"), F.floor(yin).cast("int")
        inside = (xi >= 0) & (xi < w) & (yi >= 0) & (yi < h)
        return F.when(inside, F.element_at(px, yi * w + xi + 1)).otherwise(F.lit(float(fill)))

    return F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), pick)


def random_rotate_grid(df: DataFrame, px_col: str, guid_col: str, h: int, w: int, epoch: int = 1,
                       seed: int = 42, degrees: float = 15.0, out_col: str = "rotated") -> DataFrame:
    """Keyed random rotation in [-degrees, degrees); adds ``angle`` and ``out_col``."""
    angle = angle_of(draw_expr(F.col(guid_col), epoch, seed, "rot").cast("double"), degrees)
    c, s = rotation_cos_sin(F.col("angle"))
    out = df.withColumn("angle", angle).withColumn("_c", c).withColumn("_s", s)
    return (out.withColumn(out_col, rotate_grid(F.col(px_col), F.col("_c"), F.col("_s"), h, w))
            .drop("_c", "_s"))


def _lit_matrix(m: np.ndarray) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in m])


def resize_grid(px: Column, h: int, w: int, oh: int, ow: int) -> Column:
    """Separable bilinear resize with constant weight matrices.

    ``out[oy, ox] = sum_y Wr[oy, y] * sum_x Wc[ox, x] * px[y, x]``; the weight
    matrices are literals (constant-folded), the sums higher-order functions.
    """
    wr, wc = _lit_matrix(resize_weights(h, oh)), _lit_matrix(resize_weights(w, ow))
    zero = F.lit(0.0).cast("double")

    def out(i):
        rrow = F.element_at(wr, F.floor(i / ow).cast("int") + 1)
        crow = F.element_at(wc, (i % ow) + 1)

        def row_sum(acc, y):
            inner = F.aggregate(F.sequence(F.lit(0), F.lit(w - 1)), zero,
                                lambda a2, x: a2 + F.element_at(crow, x + 1)
                                * F.element_at(px, y * w + x + 1))
            return acc + F.element_at(rrow, y + 1) * inner
        return F.aggregate(F.sequence(F.lit(0), F.lit(h - 1)), zero, row_sum)

    return F.transform(F.sequence(F.lit(0), F.lit(oh * ow - 1)), out)


def resize_arrays(px: Column, h: int, w: int, oh: int, ow: int) -> Column:
    """The production (numpy) resize applied to array rasters in Arrow batches.

    One ``einsum`` per batch with the same weights as ``resize_rgb``.
    """
    wr, wc = resize_weights(h, oh), resize_weights(w, ow)

    @arrow_udf(T.ArrayType(T.DoubleType()))
    def _resize(s: pd.Series) -> pd.Series:
        if len(s) == 0:
            return pd.Series([], dtype=object)
        x = np.stack([np.asarray(v, dtype=np.float64) for v in s]).reshape(-1, h, w)
        out = np.einsum("oh,nhw,pw->nop", wr, x, wc).reshape(len(s), oh * ow)
        return pd.Series(list(out))

    return _resize(px)


def rotate_arrays(px: Column, angle: Column, h: int, w: int, fill: float = 0.0) -> Column:
    """The production (numpy) rotation applied to array rasters in Arrow batches."""
    @arrow_udf(T.ArrayType(T.DoubleType()))
    def _rotate(s: pd.Series, a: pd.Series) -> pd.Series:
        out = [rotate_rgb(np.asarray(v, dtype=np.float64).reshape(h, w, 1), float(ang), fill).ravel()
               for v, ang in zip(s, a)]
        return pd.Series(out, dtype=object)

    return _rotate(px, angle)


def random_angle(guid: Column, epoch: int = 1, seed: int = 42, degrees: float = 15.0) -> Column:
    return angle_of(draw_expr(guid, epoch, seed, "rot").cast("double"), degrees)


def normalize_grid(px: Column, mean: float, std: float) -> Column:
    """``(x - mean) / std``."""
    return F.transform(px, lambda x: (x - F.lit(mean)) / F.lit(std))


def grid_extrema(px: Column) -> tuple[Column, Column, Column]:
    """min, max, all-black."""
    lo, hi = F.array_min(px), F.array_max(px)
    return lo, hi, (lo == 0) & (hi == 0)


def channel_stats(df: DataFrame, px_col: str = "px") -> DataFrame:
    """Corpus mean/std of pixel values from sums and sums of squares.

    Per-row sums are computed in the row; one global partial + final aggregate.
    """
    zero = F.lit(0.0).cast("double")
    s = F.aggregate(px_col, zero, lambda acc, x: acc + x)
    ss = F.aggregate(px_col, zero, lambda acc, x: acc + x * x)
    agg = df.agg(F.sum(F.size(px_col)).cast("bigint").alias("n"), F.sum(s).alias("_s"),
                 F.sum(ss).alias("_ss"))
    mean = F.col("_s") / F.col("n")
    return agg.select("n", mean.alias("mean"),
                      F.sqrt(F.col("_ss") / F.col("n") - mean * mean).alias("std"))


# ------------------------------------------------------- decoded images

def to_rgb(data: bytes, height: int, width: int, n_channels: int) -> np.ndarray:
    """Spark image bytes (BGR/BGRA/grey, row-major) -> float RGB ``[H, W, 3]`` in [0, 1]."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, n_channels)
    if n_channels == 1:
        rgb = np.repeat(a, 3, axis=2)
    else:
        rgb = a[:, :, [2, 1, 0]]
    return rgb.astype(np.float64) / 255.0


def rgb_extrema(data: bytes, height: int, width: int, n_channels: int):
    """Per-channel (min, max) in 0-255 after RGB conversion."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, n_channels)
    rgb = np.repeat(a, 3, axis=2) if n_channels == 1 else a[:, :, [2, 1, 0]]
    return [(int(rgb[:, :, c].min()), int(rgb[:, :, c].max())) for c in range(3)]


def struct_extrema(image: Column) -> Column:
    """Per-channel (min, max) of Spark image structs after RGB conversion.

    ``[r_min, r_max, g_min, g_max, b_min, b_max]`` in 0-255, computed where the
    image is decoded (Arrow batches); NULL for an undecodable image.
    """
    @arrow_udf(T.ArrayType(T.IntegerType()))
    def _extrema(data: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.Series:
        out = []
        for d, hh, ww, cc in zip(data, h, w, c):
            if d is None or cc is None or cc <= 0:
                out.append(None)
                continue
            out.append([v for pair in rgb_extrema(bytes(d), int(hh), int(ww), int(cc)) for v in pair])
        return pd.Series(out)

    return _extrema(image["data"], image["height"], image["width"], image["nChannels"])


@arrow_udf(T.BooleanType())
def all_black(data: pd.Series, n_ch: pd.Series) -> pd.Series:
    """Whether every colour value is 0; NULL for an undecodable image."""
    out = []
    for d, c in zip(data, n_ch):
        if d is None or c is None or c <= 0:
            out.append(None)
            continue
        a = np.frombuffer(d, dtype=np.uint8).reshape(-1, c)
        out.append(bool(a[:, :3].max() == 0) if len(a) else True)
    return pd.Series(out)


def resize_rgb(img: np.ndarray, oh: int = SIZE, ow: int = SIZE) -> np.ndarray:
    """Separable bilinear resize: rows, then columns, each one BLAS product."""
    wr, wc = resize_weights(img.shape[0], oh), resize_weights(img.shape[1], ow)
    rows = np.tensordot(wr, img, axes=(1, 0))                          # [oh, w, c]
    return np.tensordot(rows, wc, axes=(1, 1)).transpose(0, 2, 1)      # [oh, ow, c]


def rotate_rgb(img: np.ndarray, angle: float, fill: float = 0.0) -> np.ndarray:
    h, w = img.shape[:2]
    a = -math.radians(angle)
    c, s = round(math.cos(a), 15), round(math.sin(a), 15)
    yy, xx = np.mgrid[0:h, 0:w]
    dx, dy = xx + 0.5 - w / 2.0, yy + 0.5 - h / 2.0
    xi = np.floor(c * dx + s * dy + w / 2.0).astype(np.int64)
    yi = np.floor(-s * dx + c * dy + h / 2.0).astype(np.int64)
    inside = (xi >= 0) & (xi < w) & (yi >= 0) & (yi < h)
    out = np.full_like(img, fill)
    out[inside] = img[yi[inside], xi[inside]]
    return out


def prepare_one(img: np.ndarray, guid: str, train: bool, epoch: int, seed: int,
                size: int = SIZE) -> np.ndarray:
    """The standard chain on one image; returns ``[3, size, size]``."""
    from twinlens.operators.image_steps import standard
    return standard(size)([img], [guid], train, epoch, seed)[0]


def grid_encoder(grid: int = 4, bins: int = 8, lo: float = -2.5, hi: float = 2.75):
    """Built-in image encoder: per-channel grid means + value histograms."""
    edges = np.linspace(lo, hi, bins + 1)

    def encode(batch: np.ndarray) -> np.ndarray:
        n, ch, h, w = batch.shape
        g = batch.reshape(n, ch, grid, h // grid, grid, w // grid).mean(axis=(3, 5)).reshape(n, -1)
        hist = np.stack([np.stack([np.histogram(batch[i, c], bins=edges)[0] for c in range(ch)])
                         for i in range(n)]).reshape(n, -1) / float(h * w)
        return np.concatenate([g, hist], axis=1)
    return encode


def black_image_feature(encoder: Callable[[np.ndarray], np.ndarray], size: int = SIZE, transform=None) -> np.ndarray:
    """Encoder output of the default black image (a missing image), computed once."""
    from twinlens.operators.image_steps import standard
    out = np.asarray(encoder((transform or standard(size)).black()), dtype=np.float64)
    return out.reshape(-1)


def _decoded(batches: Iterator[tuple[pd.Series, ...]], use: Callable[[list[np.ndarray], list[str]], np.ndarray],
             batch: int) -> Iterator[pd.Series]:
    """``use`` over the decodable images of Arrow batches, ``batch`` at a time; None for the others."""
    for guid, data, height, width, channels in batches:
        out: list = [None] * len(guid)
        found = [i for i, (d, c) in enumerate(zip(data, channels, strict=True))
                 if d is not None and c is not None and c > 0]
        for s in range(0, len(found), batch):
            at = found[s:s + batch]
            rgb = [to_rgb(data.iloc[i], int(height.iloc[i]), int(width.iloc[i]), int(channels.iloc[i])) for i in at]
            for i, f in zip(at, use(rgb, [str(guid.iloc[i]) for i in at]), strict=True):
                out[i] = f
        yield pd.Series(out, dtype=object)


def _per_image(df: DataFrame, image_col: str, guid_col: str, make: Callable[[], Callable], batch: int) -> Column:
    """A column of ``make()``'s arrays: only the decoded image goes to Python, only the array comes back."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        yield from _decoded(batches, make(), batch)

    image = F.col(image_col)
    return run.asNondeterministic()(F.col(guid_col), image["data"], image["height"], image["width"], image["nChannels"])


def image_features(df: DataFrame, image_col: str = "image", guid_col: str = "guid",
                   encoder_factory: Callable[[], Callable[[np.ndarray], np.ndarray]] = grid_encoder,
                   dim: int = 72, train: bool = False, epoch: int = 1, seed: int = 42,
                   size: int = SIZE, out_col: str = "img_feat", batch: int = 32, transform=None) -> DataFrame:
    """Decoded image struct -> feature vector in Arrow batches.

    ``transform`` is a chain of steps (``image_steps``; by default the standard
    one at ``size``). The encoder gets ``[n, channels, h, w]`` and returns n rows of
    ``dim`` values, nested or not. Rows whose image is missing or undecodable get
    NULL (apply the constant ``black_image_feature`` afterwards). Only
    ``out_col`` is added.
    """
    from twinlens.operators.image_steps import flat_features, standard
    chain = transform or standard(size)

    def make():
        enc = encoder_factory()
        return lambda images, guids: flat_features(enc(chain(images, guids, train, epoch, seed)), len(guids), dim)

    return df.withColumn(out_col, _per_image(df, image_col, guid_col, make, batch))


def image_tensors(df: DataFrame, transform, image_col: str = "image", guid_col: str = "guid", train: bool = False,
                  epoch: int = 1, seed: int = 42, out_col: str = "tensor", batch: int = 32) -> DataFrame:
    """The transformed image itself, channel by channel and row by row, as one array.

    For small sizes and inspection: models read the tensor inside
    ``image_features`` and never ship it.
    """
    def make():
        return lambda images, guids: transform(images, guids, train, epoch, seed).reshape(len(guids), -1)

    return df.withColumn(out_col, _per_image(df, image_col, guid_col, make, batch))
