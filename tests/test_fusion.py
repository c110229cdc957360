import numpy as np
from pyspark.sql import functions as F

from twinlens.operators.evaluate import ablation_report, accuracy
from twinlens.operators.fusion import (Block, Head, fit_centroid_head, fuse_features, score,
                                       score_modes)


def _df(spark, n=60, d=6, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(f"g{i}", int(i % 3), rng.normal(size=d).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "guid string, label int, features array<double>"), rows


def test_score_matches_numpy_and_partitioning(spark):
    df, rows = _df(spark)
    rng = np.random.default_rng(1)
    head = Head([(rng.normal(size=(4, 6)), rng.normal(size=4)), (rng.normal(size=(3, 4)), rng.normal(size=3))],
                [Block("img", 0, 3), Block("txt", 3, 6)])
    a = {r.guid: r.pred for r in score(df, head).collect()}
    b = {r.guid: r.pred for r in score(df.repartition(5), head).collect()}
    x = np.asarray([r[2] for r in rows])
    ref = np.argmax(np.round(head.forward(x), 9), axis=1)
    assert a == b == {r[0]: int(p) for r, p in zip(rows, ref)}


def test_centroid_head_and_modes(spark):
    df, rows = _df(spark, 90, 6, 2)
    blocks = [Block("img", 0, 3), Block("txt", 3, 6)]
    head = fit_centroid_head(df, blocks)
    x = np.asarray([r[2] for r in rows])
    y = np.asarray([r[1] for r in rows])
    mu = np.stack([x[y == k].mean(axis=0) for k in range(3)])
    assert np.allclose(head.layers[0][0], mu)
    got = {r.guid: list(r.preds) for r in score_modes(df, head).collect()}
    for i, r in enumerate(rows):
        mm = np.argmax(np.round(x[i] @ mu.T - 0.5 * (mu ** 2).sum(1), 9))
        to = np.argmax(np.round(x[i, 3:] @ mu[:, 3:].T - 0.5 * (mu[:, 3:] ** 2).sum(1), 9))
        io = np.argmax(np.round(x[i, :3] @ mu[:, :3].T - 0.5 * (mu[:, :3] ** 2).sum(1), 9))
        assert got[r[0]] == [mm, to, io]
    rep = {r.mode: r for r in ablation_report(score_modes(df, head)).collect()}
    assert set(rep) == {"multimodal", "text_only", "image_only"} and rep["multimodal"].total == 90


def test_fuse_defaults_and_length(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], None), ("b", None, [3.0])],
                               "guid string, img_feat array<double>, txt_feat array<double>")
    out = {r.guid: r.features for r in fuse_features(df, img_dim=2, txt_dim=1).collect()}
    assert out == {"a": [1.0, 2.0, 0.0], "b": [0.0, 0.0, 3.0]}


def test_accuracy_empty_is_null(spark):
    df = spark.createDataFrame([], "pred int, label int")
    r = accuracy(df).collect()
    assert r[0].total == 0 and r[0].accuracy is None
