"""Training jobs and history reports.

``fit_fusion_head`` trains Linear -> ReLU -> Dropout -> Linear with
cross-entropy and AdamW. One Spark job per epoch: ``trainers`` partitions, dealt
anew each epoch by a hash of the rows, run seeded mini-batches (keyed shuffle
order, batch 16) from the broadcast parameters. Their parameters and optimiser
moments are averaged, weighted by rows, as chunks summed on the executors, so
one averaged head (bounded by the layer sizes) reaches the driver however many
trainers there are. It is local SGD with per-epoch averaging, a different
trajectory from one sequential optimiser; one trainer reproduces the
sequential loop. Files, cores and input partitions don't change the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinlens.functions.labels import NUM_CLASSES
from twinlens.operators.evaluate import accuracy
from twinlens.operators.fusion import Block, Head, MAX_HEAD_BYTES, score
from twinlens.session import discard, materialize

# ------------------------------------------------------------ reports


def batch_mean_loss(df: DataFrame, epoch_col: str = "epoch", batch_col: str = "batch_id",
                    loss_col: str = "loss", decimals: int = 10) -> DataFrame:
    """Epoch loss as the mean of batch means (D3): two aggregate levels."""
    per_batch = df.groupBy(epoch_col, batch_col).agg(F.avg(loss_col).alias("_bl"))
    return (per_batch.groupBy(epoch_col)
            .agg(F.count(F.lit(1)).alias("n_batches"), F.round(F.avg("_bl"), decimals).alias("loss")))


def best_epoch(history: DataFrame, acc_col: str = "val_acc") -> DataFrame:
    """Best epoch: highest accuracy above 0, earliest on ties."""
    h = history.where(F.col(acc_col) > 0)
    return h.agg(F.max_by("epoch", F.struct(F.col(acc_col), -F.col("epoch"))).alias("epoch"),
                 F.max(acc_col).alias(acc_col))


def mark_improvements(history: DataFrame, acc_col: str = "val_acc") -> DataFrame:
    """Epoch improves iff its accuracy beats every earlier one (start 0).

    The window spans one row per epoch, so its single partition is bounded.
    """
    w = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.coalesce(F.max(acc_col).over(w), F.lit(0.0))
    return history.withColumn("improved", F.col(acc_col) > prev)


def epoch_order_key(guid_col: str, epoch: int, seed: int):
    """Deterministic per-epoch shuffle key."""
    return F.md5(F.concat(F.col(guid_col), F.lit(f"|{epoch}|{seed}")))


# ------------------------------------------------------------ trainer

@dataclass
class TrainState:
    params: list[np.ndarray]       # W1, b1, W2, b2
    m: list[np.ndarray]
    v: list[np.ndarray]
    step: int = 0


def init_mlp(d: int, hidden: int, k: int, seed: int) -> TrainState:
    """Uniform(-1/sqrt(fan_in), 1/sqrt(fan_in)) weights and biases."""
    rng = np.random.default_rng(seed)
    a1, a2 = 1.0 / np.sqrt(d), 1.0 / np.sqrt(hidden)
    p = [rng.uniform(-a1, a1, (hidden, d)), rng.uniform(-a1, a1, hidden),
         rng.uniform(-a2, a2, (k, hidden)), rng.uniform(-a2, a2, k)]
    return TrainState(p, [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0)


def _forward_backward(p, x, y, keep_mask, dropout):
    w1, b1, w2, b2 = p
    pre = x @ w1.T + b1
    h = np.maximum(pre, 0.0)
    hd = h * keep_mask / (1.0 - dropout) if dropout > 0 else h
    z = hd @ w2.T + b2
    zmax = z.max(axis=1, keepdims=True)
    ez = np.exp(z - zmax)
    prob = ez / ez.sum(axis=1, keepdims=True)
    n = x.shape[0]
    loss = float(np.mean(np.log(ez.sum(axis=1)) + zmax[:, 0] - z[np.arange(n), y]))
    g = prob.copy()
    g[np.arange(n), y] -= 1.0
    g /= n
    gw2 = g.T @ hd
    gb2 = g.sum(axis=0)
    ghd = g @ w2
    gh = ghd * keep_mask / (1.0 - dropout) if dropout > 0 else ghd
    gpre = gh * (pre > 0)
    gw1 = gpre.T @ x
    gb1 = gpre.sum(axis=0)
    return loss, z, [gw1, gb1, gw2, gb2]


def _adamw(st: TrainState, grads, lr, wd, b1=0.9, b2=0.999, eps=1e-8):
    st.step += 1
    c1, c2 = 1 - b1 ** st.step, 1 - b2 ** st.step
    for i, g in enumerate(grads):
        st.params[i] *= (1 - lr * wd)
        st.m[i] = b1 * st.m[i] + (1 - b1) * g
        st.v[i] = b2 * st.v[i] + (1 - b2) * g * g
        st.params[i] -= lr * (st.m[i] / c1) / (np.sqrt(st.v[i] / c2) + eps)


def _seed_of(*parts) -> int:
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def _pack(arrs: list[np.ndarray]) -> bytes:
    return np.concatenate([a.ravel() for a in arrs]).astype(np.float64).tobytes()


def _unpack(buf, shapes) -> list[np.ndarray]:
    flat = np.frombuffer(buf, dtype=np.float64)
    out, i = [], 0
    for s in shapes:
        n = int(np.prod(s))
        out.append(flat[i:i + n].reshape(s).copy())
        i += n
    return out


#: Parameters: partitions that train side by side, and numbers merged in one row.
TRAINERS = 8
CHUNK = 1 << 16

_PART_SCHEMA = T.StructType([
    T.StructField("chunk", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("loss_sum", T.DoubleType()),
    T.StructField("n_batches", T.LongType()), T.StructField("correct", T.LongType()),
    T.StructField("steps", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())),
])


def _train_rows(df: DataFrame, epoch: int, seed: int, trainers: int, guid_col: str, label_col: str,
                features_col: str) -> DataFrame:
    """An epoch's rows dealt to the trainers and put in its order; ``row_no`` tells equal guids apart."""
    row = F.col("row_no") if "row_no" in df.columns else F.xxhash64(features_col)
    data = df.select(F.col(guid_col).alias("_g"), F.col(label_col).cast("int").alias("_y"),
                     F.col(features_col).alias("_x"), row.alias("_r"))
    return (data.repartition(trainers, F.xxhash64("_g", "_r", F.lit(epoch), F.lit(seed)))
            .sortWithinPartitions(epoch_order_key("_g", epoch, seed), "_r", "_y"))


def _sum_chunks(parts: DataFrame) -> DataFrame:
    """Sums of ``_PART_SCHEMA`` rows by chunk: one row per ``CHUNK`` numbers, summed on the executors."""
    return (parts.groupBy("chunk")
            .agg(*[F.sum(c).alias(c) for c in ("n", "loss_sum", "n_batches", "correct")],
                 F.max("steps").alias("steps"), Summarizer.sum(array_to_vector(F.col("v"))).alias("v"))
            .withColumn("v", vector_to_array("v")))


GRADIENT_SCHEMA = "layer int, part string, row int, col int, gradient double"


def _gradient_sums(df: DataFrame, head: Head, features_col: str, label_col: str) -> DataFrame:
    """``_PART_SCHEMA`` sums of loss and gradient over all rows, by chunk of the parameters."""
    if len(head.layers) != 2:
        raise ValueError("the gradient is that of a two-layer head")
    if head.nbytes() > MAX_HEAD_BYTES:
        raise ValueError("head too large to broadcast")
    params = [a for layer in head.layers for a in layer]
    shared = df.sparkSession.sparkContext.broadcast(params)

    def run(batches):
        total, n, loss, correct, nb = [np.zeros(p.shape) for p in shared.value], 0, 0.0, 0, 0
        for pdf in batches:
            for s in range(0, len(pdf), 1024):
                x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["_x"].iloc[s:s + 1024]])
                y = pdf["_y"].iloc[s:s + 1024].to_numpy(dtype=np.int64)
                mean, z, grads = _forward_backward(shared.value, x, y, None, 0.0)
                for t, g in zip(total, grads, strict=True):
                    t += g * len(x)
                n, loss, correct, nb = n + len(x), loss + mean * len(x), correct + int((z.argmax(1) == y).sum()), nb + 1
        if n:
            flat = np.concatenate([t.ravel() for t in total])
            for c, at in enumerate(range(0, len(flat), CHUNK)):
                yield pd.DataFrame({"chunk": [c], "n": [n], "loss_sum": [loss], "n_batches": [nb], "correct": [correct],
                                    "steps": [0], "v": [flat[at:at + CHUNK]]})

    rows = df.where(F.col(label_col).isNotNull()).select(F.col(features_col).alias("_x"),
                                                         F.col(label_col).cast("int").alias("_y"))
    return _sum_chunks(rows.mapInPandas(run, _PART_SCHEMA))


def head_gradient(df: DataFrame, head: Head, features_col: str = "features",
                  label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """Cross-entropy of a two-layer head over all rows, and its gradient.

    Returns ``(loss, gradient)``: ``(n, loss, correct)`` in one row, loss being the
    mean over the rows, and ``(layer, part, row, col, gradient)``, one row per
    parameter (part W or b). Each task adds its batches up in one buffer of the
    head's size and hands it over in chunks that are summed on the executors.
    Dropout is off. Rows without a label are left out; without any row the
    loss is NULL and the gradient empty.
    """
    sums = materialize(_gradient_sums(df, head, features_col, label_col), "gradient")
    loss = sums.where("chunk = 0").agg(F.max("n").alias("n"), (F.max("loss_sum") / F.max("n")).alias("loss"),
                                       F.max("correct").alias("correct"))
    spots, start = [], 0
    for i, layer in enumerate(head.layers):
        for part, a in zip("Wb", layer, strict=True):
            spot = F.struct(F.lit(i).alias("layer"), F.lit(part).alias("part"), F.lit(start).cast("long").alias("start"),
                            F.lit(a.shape[1] if part == "W" else 1).alias("width"))
            start += a.size
            spots.append(F.when(F.col("at") < start, spot))
    flat = sums.select("n", F.posexplode("v").alias("i", "v"), (F.col("chunk").cast("long") * CHUNK).alias("first"))
    placed = flat.withColumn("at", F.col("first") + F.col("i")).withColumn("p", F.coalesce(*spots)).withColumn(
        "i", F.col("at") - F.col("p.start"))
    return loss, placed.select("p.layer", "p.part", F.floor(F.col("i") / F.col("p.width")).cast("int").alias("row"),
                               (F.col("i") % F.col("p.width")).cast("int").alias("col"),
                               (F.col("v") / F.col("n")).alias("gradient"))


def fit_full_batch(train: DataFrame, val: DataFrame | None, head: Head, epochs: int = 5, lr: float = 2e-5,
                   weight_decay: float = 0.01, features_col: str = "features", label_col: str = "label"):
    """AdamW on the whole training set from the given two-layer head; ``(best_head, last_head, history rows)``.

    One step an epoch with the exact gradient, without dropout, so the result has
    no order, batch or seed in it. History and selection are those of
    ``fit_fusion_head``; train loss and accuracy are measured before the step.
    The gradient sums (the head's size) are the only thing that reaches the driver.
    """
    params = [np.array(a, dtype=np.float64) for layer in head.layers for a in layer]
    st = TrainState(params, [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params])
    best, best_acc, history, last = None, 0.0, [], head
    for epoch in range(1, epochs + 1):
        sums = sorted(_gradient_sums(train, last, features_col, label_col).collect(), key=lambda r: r.chunk)
        if not sums:
            raise ValueError("no training rows")
        n = sums[0].n
        total = np.concatenate([np.asarray(r.v) for r in sums])
        _adamw(st, _unpack((total / n).tobytes(), [p.shape for p in params]), lr, weight_decay)
        w1, b1, w2, b2 = (p.copy() for p in st.params)
        last = Head(layers=[(w1, b1), (w2, b2)], blocks=head.blocks, kind=head.kind)
        val_acc = None
        if val is not None:
            acc = accuracy(score(val, last, features_col), "pred", label_col).collect()[0]
            val_acc = 100.0 * acc["correct"] / acc["total"] if acc["total"] else None
        is_best = val_acc is not None and val_acc > best_acc
        if is_best:
            best_acc, best = val_acc, last
        history.append((epoch, sums[0].loss_sum / n, 100.0 * sums[0].correct / n, val_acc, is_best))
    return best, last, history


def fit_fusion_head(train: DataFrame | Callable[[int], DataFrame], val: DataFrame | None, blocks: list[Block],
                    features_col: str = "features", label_col: str = "label",
                    guid_col: str = "guid", hidden: int = 512, epochs: int = 5,
                    lr: float = 2e-5, batch_size: int = 16, dropout: float = 0.3,
                    weight_decay: float = 0.01, seed: int = 42,
                    num_classes: int = NUM_CLASSES, trainers: int = TRAINERS):
    """Train the fusion head; returns ``(best_head, last_head, history rows)``.

    ``train`` is a table, or a function of the epoch where features are
    augmented anew each epoch.

    History rows: ``(epoch, train_loss, train_acc, val_acc, is_best)``;
    train loss is the mean of batch means, the best head is kept on a strict
    improvement over the best validation accuracy so far (start 0).
    """
    rows_of = train if callable(train) else lambda _: train
    d = blocks[-1].stop
    st = init_mlp(d, hidden, num_classes, seed)
    shapes = [p.shape for p in st.params]
    if 3 * sum(int(np.prod(s)) for s in shapes) * 8 > MAX_HEAD_BYTES:
        raise ValueError("head too large to broadcast")
    best_acc, best_head, history = 0.0, None, []
    for epoch in range(1, epochs + 1):
        rows = rows_of(epoch)
        ordered = _train_rows(rows, epoch, seed, trainers, guid_col, label_col, features_col)
        bstate = ordered.sparkSession.sparkContext.broadcast((_pack(st.params + st.m + st.v), st.step))

        def run(batches, _b=bstate, _e=epoch):
            from pyspark import TaskContext
            blob, step0 = _b.value
            arrs = _unpack(blob, shapes * 3)
            local = TrainState(arrs[:4], arrs[4:8], arrs[8:], step0)
            pid = TaskContext.get().partitionId()
            rng = np.random.default_rng(_seed_of(seed, _e, pid))
            loss_sum, nb, correct, n = 0.0, 0, 0, 0
            buf_x, buf_y = np.zeros((0, shapes[0][1])), np.zeros(0, dtype=np.int64)

            def one_step(xb, yb):
                keep = (rng.random((len(xb), hidden)) >= dropout).astype(np.float64)
                loss, z, grads = _forward_backward(local.params, xb, yb, keep, dropout)
                _adamw(local, grads, lr, weight_decay)
                return loss, int((np.argmax(z, axis=1) == yb).sum())

            # stream Arrow batches; only a carry of < batch_size rows is buffered
            for pdf in batches:
                if not len(pdf):
                    continue
                xs = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["_x"]])
                buf_x = np.concatenate([buf_x, xs])
                buf_y = np.concatenate([buf_y, pdf["_y"].to_numpy(dtype=np.int64)])
                full = (len(buf_x) // batch_size) * batch_size
                for s0 in range(0, full, batch_size):
                    loss, c = one_step(buf_x[s0:s0 + batch_size], buf_y[s0:s0 + batch_size])
                    loss_sum, nb, correct, n = loss_sum + loss, nb + 1, correct + c, n + batch_size
                buf_x, buf_y = buf_x[full:], buf_y[full:]
            if len(buf_x):   # the last batch may be short
                loss, c = one_step(buf_x, buf_y)
                loss_sum, nb, correct, n = loss_sum + loss, nb + 1, correct + c, n + len(buf_x)
            if n == 0:
                return
            flat = np.concatenate([a.ravel() for a in local.params + local.m + local.v]) * n
            for c, at in enumerate(range(0, len(flat), CHUNK)):
                yield pd.DataFrame({"chunk": [c], "n": [n], "loss_sum": [loss_sum], "n_batches": [nb],
                                    "correct": [correct], "steps": [local.step - step0],
                                    "v": [flat[at:at + CHUNK]]})

        merged = _sum_chunks(ordered.mapInPandas(run, _PART_SCHEMA)).collect()
        bstate.destroy()
        if rows is not train:
            discard(rows)  # an epoch's augmented features, if they were written
        if not merged:
            raise ValueError("no training rows")
        merged.sort(key=lambda r: r.chunk)
        n, loss_sum, nb, correct, steps = (merged[0][c] for c in ("n", "loss_sum", "n_batches", "correct", "steps"))
        total = np.concatenate([np.asarray(r.v) for r in merged])
        arrs = _unpack((total / n).tobytes(), shapes * 3)
        st = TrainState(arrs[:4], arrs[4:8], arrs[8:], st.step + int(steps))
        head = Head(layers=[(st.params[0], st.params[1]), (st.params[2], st.params[3])],
                    blocks=blocks, kind="mlp")
        val_acc = None
        if val is not None:
            acc = accuracy(score(val, head, features_col), "pred", label_col).collect()[0]
            # selection compares the unrounded ratio
            val_acc = 100.0 * acc["correct"] / acc["total"] if acc["total"] else None
        is_best = val_acc is not None and val_acc > best_acc
        if is_best:
            best_acc, best_head = val_acc, head
        history.append((epoch, loss_sum / nb if nb else None,
                        100.0 * correct / n if n else None, val_acc, is_best))
    return best_head, head, history


HISTORY_SCHEMA = "epoch int, train_loss double, train_acc double, val_acc double, is_best boolean"


def history_frame(spark, history) -> DataFrame:
    return spark.createDataFrame(history, HISTORY_SCHEMA)


def fit_ml_head(train: DataFrame, features_col: str = "features", label_col: str = "label",
                hidden: int = 512, max_iter: int = 50, seed: int = 42):
    """Spark ML's multilayer perceptron as the built-in head (M4).

    Sigmoid hidden layer and L-BFGS: same role, not the same optimiser.
    """
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector
    d = len(train.select(features_col).first()[0])
    data = train.select(array_to_vector(F.col(features_col)).alias("fv"),
                        F.col(label_col).cast("double").alias("y"))
    mlp = MultilayerPerceptronClassifier(featuresCol="fv", labelCol="y", layers=[d, hidden, NUM_CLASSES],
                                         maxIter=max_iter, seed=seed, blockSize=128)
    return mlp.fit(data)
