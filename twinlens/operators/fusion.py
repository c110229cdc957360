"""Fusion, heads and scoring.

A head is a small stack of affine layers with ReLU between them. Its size is
bounded by the feature width and class count (2816x512 + 512x3 floats for the
reference network), never by the data, so it is broadcast to the executors and
applied in Arrow batches with numpy. Fitting is a distributed aggregate; only
the fitted parameters reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinlens.functions.udf import arrow_udf
from twinlens.functions.arrays import zeros
from twinlens.functions.labels import NUM_CLASSES

# Largest head broadcast to executors (float64 parameters).
MAX_HEAD_BYTES = 512 * 1024 * 1024


@dataclass
class Block:
    name: str
    start: int
    stop: int


@dataclass
class Head:
    """Affine layers ``[(W[out, in], b[out]), ...]`` with ReLU between.

    ``block_bias`` splits part of the first layer's bias by input block, so a
    masked block drops its bias too (the centroid head's ``-|c_blk|^2 / 2``).
    """
    layers: list[tuple[np.ndarray, np.ndarray]]
    blocks: list[Block]
    block_bias: dict[str, np.ndarray] = field(default_factory=dict)
    kind: str = "mlp"

    @property
    def n_in(self) -> int:
        return self.layers[0][0].shape[1]

    @property
    def n_out(self) -> int:
        return self.layers[-1][0].shape[0]

    def nbytes(self) -> int:
        return sum(w.nbytes + b.nbytes for w, b in self.layers)

    def first_pre(self, x: np.ndarray, active: dict[str, bool] | None = None,
                  consts: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """First-layer pre-activation, per-block so masks reuse partials."""
        w0, b0 = self.layers[0]
        pre = np.broadcast_to(b0, (x.shape[0], w0.shape[0])).copy()
        for blk in self.blocks:
            on = True if active is None else active.get(blk.name, True)
            wb = w0[:, blk.start:blk.stop]
            if on:
                pre += x[:, blk.start:blk.stop] @ wb.T
                if blk.name in self.block_bias:
                    pre += self.block_bias[blk.name]
            elif consts is not None and blk.name in consts:
                pre += consts[blk.name] @ wb.T
        return pre

    def rest(self, pre: np.ndarray) -> np.ndarray:
        h = pre
        for w, b in self.layers[1:]:
            h = np.maximum(h, 0.0) @ w.T + b
        return h

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self.rest(self.first_pre(x))


def _stack(series: pd.Series, width: int) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, width))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series])


def predict_logits(z: np.ndarray) -> np.ndarray:
    """First index of the maximum (ties -> lowest class)."""
    return np.argmax(z, axis=1).astype(np.int32)


def _broadcast_head(spark, head: Head):
    if head.nbytes() > MAX_HEAD_BYTES:
        raise ValueError(f"head of {head.nbytes()} bytes exceeds the broadcast guard")
    return spark.sparkContext.broadcast(head)


# ------------------------------------------------------------------ fusion

def fuse_features(df: DataFrame, img_col: str = "img_feat", txt_col: str = "txt_feat",
                  img_dim: int = 64, txt_dim: int = 32, out_col: str = "features",
                  img_missing: Column | None = None, txt_missing: Column | None = None) -> DataFrame:
    """Late fusion, image block first.

    A missing modality becomes its encoder's output for the default input
    (``*_missing``; zeros for the precomputed fixture vectors), so no default
    raster or token list is ever materialised per row.
    """
    im = img_missing if img_missing is not None else zeros(img_dim)
    tm = txt_missing if txt_missing is not None else zeros(txt_dim)
    return df.withColumn(out_col, F.concat(F.coalesce(F.col(img_col), im),
                                           F.coalesce(F.col(txt_col), tm)))


def default_blocks(img_dim: int = 64, txt_dim: int = 32) -> list[Block]:
    return [Block("img", 0, img_dim), Block("txt", img_dim, img_dim + txt_dim)]


# ------------------------------------------------------------ centroid head

def class_sums(df: DataFrame, features_col: str = "features", label_col: str = "label") -> DataFrame:
    """Per-class feature sums and counts: one partial + final aggregate.

    The aggregation buffer is one dense vector per class per task.
    """
    return (df.groupBy(F.col(label_col).alias("k"))
            .agg(Summarizer.sum(array_to_vector(F.col(features_col))).alias("_s"),
                 F.count(F.lit(1)).alias("n"))
            .select("k", "n", vector_to_array(F.col("_s"), "float64").alias("s")))


def centroids(df: DataFrame, features_col: str = "features", label_col: str = "label") -> DataFrame:
    """``(k, n, mu ARRAY<DOUBLE>)``: class means over the rows given (M5)."""
    cs = class_sums(df, features_col, label_col)
    return cs.select("k", "n", F.transform("s", lambda x: x / F.col("n")).alias("mu"))


def fit_centroid_head(df: DataFrame, blocks: list[Block], features_col: str = "features",
                      label_col: str = "label", num_classes: int = NUM_CLASSES) -> Head:
    """Nearest-centroid head: ``z_k = c_k . x - |c_k|^2 / 2`` per active block.

    A stand-in with closed-form weights (SQL-checkable); classes with no rows
    get a zero centroid.
    """
    rows = centroids(df, features_col, label_col).collect()   # <= num_classes rows
    d = blocks[-1].stop
    w = np.zeros((num_classes, d))
    for r in rows:
        if r["k"] is not None and 0 <= r["k"] < num_classes:
            w[int(r["k"])] = np.asarray(r["mu"], dtype=np.float64)
    bb = {blk.name: -0.5 * (w[:, blk.start:blk.stop] ** 2).sum(axis=1) for blk in blocks}
    return Head(layers=[(w, np.zeros(num_classes))], blocks=blocks, block_bias=bb, kind="centroid")


# ----------------------------------------------------------------- scoring

def score(df: DataFrame, head: Head, features_col: str = "features",
          logits_col: str = "logits", pred_col: str = "pred") -> DataFrame:
    """Add logits and the predicted class.

    The head is a broadcast variable; each Arrow batch is one matrix product.
    """
    bh = _broadcast_head(df.sparkSession, head)
    width = head.n_in

    @arrow_udf(T.ArrayType(T.DoubleType()))
    def logits_udf(x: pd.Series) -> pd.Series:
        h = bh.value
        return pd.Series(list(h.forward(_stack(x, width))))

    from twinlens.functions.arrays import argmax
    return (df.withColumn(logits_col, logits_udf(F.col(features_col)))
            .withColumn(pred_col, argmax(logits_col)))


#: Mode names of the ablation.
MODES = ("multimodal", "text_only", "image_only")
MODE_ACTIVE = {
    "multimodal": {"img": True, "txt": True},
    "text_only": {"img": False, "txt": True},
    "image_only": {"img": True, "txt": False},
}


def score_modes(df: DataFrame, head: Head, features_col: str = "features",
                modes: tuple[str, ...] = MODES, consts: dict[str, np.ndarray] | None = None,
                out_col: str = "preds") -> DataFrame:
    """Predicted class under each modality mask, in one pass.

    ``out_col[i]`` is the prediction for ``modes[i]``. A masked block
    contributes the head's response to ``consts[block]`` (the encoder output
    of the masked input; absent = zeros) and drops its block bias.
    """
    bh = _broadcast_head(df.sparkSession, head)
    width = head.n_in
    cst = consts or {}

    @arrow_udf(T.ArrayType(T.IntegerType()))
    def preds_udf(x: pd.Series) -> pd.Series:
        h = bh.value
        xs = _stack(x, width)
        cols = []
        for m in modes:
            pre = h.first_pre(xs, MODE_ACTIVE[m], cst)
            cols.append(predict_logits(h.rest(pre)))
        return pd.Series(list(np.stack(cols, axis=1))) if len(xs) else pd.Series([], dtype=object)

    return df.withColumn(out_col, preds_udf(F.col(features_col)))
