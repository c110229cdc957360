import numpy as np
import pytest
from pyspark.sql import functions as F

from twinlens.operators import training as tr
from twinlens.operators.fusion import Block


def test_improvements_and_best_epoch(spark):
    h = spark.createDataFrame([(1, 50.0), (2, 70.0), (3, 70.0), (4, 60.0), (5, 72.0)],
                              "epoch int, val_acc double")
    imp = {r.epoch: r.improved for r in tr.mark_improvements(h).collect()}
    assert [e for e, v in sorted(imp.items()) if v] == [1, 2, 5]
    ties = spark.createDataFrame([(1, 10.0), (2, 30.0), (3, 30.0)], "epoch int, val_acc double")
    assert tr.best_epoch(ties).collect()[0].epoch == 2
    zero = spark.createDataFrame([(1, 0.0)], "epoch int, val_acc double")
    assert tr.best_epoch(zero).collect()[0].epoch is None


def test_mean_of_batch_means(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 0, 1.0), (1, 1, 4.0)],
                               "epoch int, batch_id int, loss double")
    r = tr.batch_mean_loss(df).collect()[0]
    assert r.loss == 2.5 and r.n_batches == 2


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    st = tr.init_mlp(6, 5, 3, seed=1)
    x, y = rng.normal(size=(4, 6)), np.array([0, 2, 1, 2])
    keep = np.ones((4, 5))
    _, _, grads = tr._forward_backward(st.params, x, y, keep, 0.0)
    eps = 1e-6
    for pi in range(4):
        p = st.params[pi]
        idx = tuple(rng.integers(0, s) for s in p.shape)
        old = p[idx]
        p[idx] = old + eps
        lp, _, _ = tr._forward_backward(st.params, x, y, keep, 0.0)
        p[idx] = old - eps
        lm, _, _ = tr._forward_backward(st.params, x, y, keep, 0.0)
        p[idx] = old
        assert abs((lp - lm) / (2 * eps) - grads[pi][idx]) < 1e-6


def test_loss_falls_on_separable_data(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        k = i % 3
        v = rng.normal(scale=0.3, size=8)
        v[k] += 3.0
        rows.append((f"g{i}", k, v.tolist(), "val" if i % 5 == 0 else "train"))
    df = spark.createDataFrame(rows, "guid string, label int, features array<double>, split string")
    blocks = [Block("img", 0, 4), Block("txt", 4, 8)]
    best, last, hist = tr.fit_fusion_head(df.where("split='train'").repartition(2),
                                          df.where("split='val'"), blocks, hidden=16, epochs=4,
                                          lr=0.05, dropout=0.1)
    losses = [h[1] for h in hist]
    assert losses[-1] < losses[0]
    assert hist[-1][3] > 80.0 and best is not None


def test_head_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f"g{i % 40}", i % 3, rng.normal(size=6).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "row_no long, guid string, label int, features array<double>")
    blocks = [Block("img", 0, 3), Block("txt", 3, 6)]
    heads = [tr.fit_fusion_head(df.repartition(n), None, blocks, hidden=8, epochs=2, lr=0.01, trainers=3)[1]
             for n in (1, 5)]
    for (w, b), (w2, b2) in zip(heads[0].layers, heads[1].layers, strict=True):
        assert np.allclose(w, w2, atol=1e-12) and np.allclose(b, b2, atol=1e-12)


def _head_rows(spark, n=700, width=6):
    rng = np.random.default_rng(8)
    rows = [(f"g{i}", int(rng.integers(3)), rng.normal(size=width).tolist()) for i in range(n)]
    return rows, spark.createDataFrame([*rows, ("none", None, [0.0] * width)],
                                       "guid string, label int, features array<double>")


def test_head_gradient_equals_finite_differences_and_any_partitioning(spark, monkeypatch):
    from twinlens.operators.fusion import Head
    rows, df = _head_rows(spark)
    p = tr.init_mlp(6, 5, 3, seed=2).params
    head = Head([(p[0], p[1]), (p[2], p[3])], [Block("img", 0, 3), Block("txt", 3, 6)])
    x, y = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    got = []
    for parts, chunk in ((1, 1 << 16), (7, 10)):  # a chunk far smaller than the head as well
        monkeypatch.setattr(tr, "CHUNK", chunk)
        loss, grad = tr.head_gradient(df.repartition(parts), head)
        got.append(({(r.layer, r.part, r.row, r.col): r.gradient for r in grad.collect()}, loss.collect()[0]))
    (one, loss), (many, loss2) = got
    assert len(one) == 5 * 6 + 5 + 3 * 5 + 3 and one.keys() == many.keys()
    assert all(abs(one[k] - many[k]) < 1e-12 for k in one) and abs(loss.loss - loss2.loss) < 1e-12
    assert loss.n == 700 and loss.correct == loss2.correct
    for (layer, part, row, col), g in one.items():
        a = p[2 * layer + (part == "b")]
        at = (row, col) if part == "W" else (row,)
        old, eps, ends = a[at], 1e-6, []
        for step in (eps, -eps):
            a[at] = old + step
            ends.append(tr._forward_backward(p, x, y, None, 0.0)[0])
        a[at] = old
        assert abs((ends[0] - ends[1]) / (2 * eps) - g) < 1e-6


def test_head_gradient_of_nothing(spark):
    from twinlens.operators.fusion import Head
    _, df = _head_rows(spark, 3)
    p = tr.init_mlp(6, 5, 3, seed=2).params
    blocks = [Block("img", 0, 3), Block("txt", 3, 6)]
    loss, grad = tr.head_gradient(df.limit(0), Head([(p[0], p[1]), (p[2], p[3])], blocks))
    assert grad.count() == 0 and loss.collect()[0].loss is None
    with pytest.raises(ValueError, match="two-layer"):
        tr.head_gradient(df, Head([(p[0], p[1])], blocks))


def test_full_batch_training_lowers_the_loss(spark):
    from twinlens.operators.fusion import Head
    rng = np.random.default_rng(3)
    rows = [(f"g{i}", i % 3, (np.eye(3)[i % 3].repeat(2) * 2 + rng.normal(scale=0.3, size=6)).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "guid string, label int, features array<double>")
    p = tr.init_mlp(6, 8, 3, seed=5).params
    first = [a.copy() for a in p]
    best, last, hist = tr.fit_full_batch(df, df, Head([(p[0], p[1]), (p[2], p[3])], [Block("img", 0, 3), Block("txt", 3, 6)]),
                                         epochs=8, lr=0.05)
    assert [h[0] for h in hist] == list(range(1, 9)) and hist[-1][1] < 0.5 * hist[0][1] and hist[-1][3] > 90
    assert best is not None and all((a == b).all() for a, b in zip(p, first, strict=True))  # the given head is left alone
