"""End-to-end file jobs: train -> predict -> ablation -> bad cases -> audit."""
import numpy as np
from pyspark.sql import functions as F

from test_images import bmp_bytes
from twinlens.plans import jobs

WORDS = {0: "awful terrible sad", 1: "table chair window", 2: "great happy lovely"}
COLORS = {0: (200, 10, 10), 1: (10, 200, 10), 2: (10, 10, 200)}
TAGS = {0: "negative", 1: "neutral", 2: "positive"}


def _corpus(d, n=90):
    rng = np.random.default_rng(5)
    train = ["guid,tag"]
    for i in range(1, n + 1):
        k = i % 3
        spelling = [str(i), f"{i}.0", f" {i} ", f"{i}e0"][i % 4]
        train.append(f"{spelling},{TAGS[k]}")
        if i % 11 != 0:
            with open(f"{d}/{i}.txt", "wb") as fh:
                fh.write(f" {WORDS[k]} 图 {rng.integers(100)}\n".encode("gb18030"))
        if i % 13 == 0:
            with open(f"{d}/{i}.jpg", "wb") as fh:
                fh.write(b"corrupt")
        elif i % 7 != 0:
            img = np.zeros((12, 10, 3), dtype=np.uint8) + np.asarray(COLORS[k], dtype=np.uint8)
            with open(f"{d}/{i}.jpg", "wb") as fh:
                fh.write(bmp_bytes(img))
    with open(f"{d}/train.txt", "w") as fh:
        fh.write("\n".join(train) + "\n")
    with open(f"{d}/test_without_label.txt", "w") as fh:
        fh.write("guid,tag\n" + "\n".join(f"{i},null" for i in (5, 3, 9, 1, 200)) + "\n")


def test_jobs_end_to_end(spark, tmpdir_path):
    d = tmpdir_path
    _corpus(d)
    spec = jobs.FeatureSpec(image_size=16)
    hist = jobs.train_job(spark, f"{d}/train.txt", d, f"{d}/out", spec, epochs=3, lr=0.01,
                          hidden=16).collect()
    assert [r.epoch for r in sorted(hist, key=lambda r: r.epoch)] == [1, 2, 3]
    split = spark.read.parquet(f"{d}/out/split")
    assert split.where(F.col("split") == "val").count() == 18 and split.count() == 90

    dist = jobs.predict_job(spark, f"{d}/test_without_label.txt", d, f"{d}/out/best_head",
                            f"{d}/pred", spec).collect()
    assert sum(r.n for r in dist) == 5
    pred = spark.read.option("header", True).csv(f"{d}/pred").collect()
    assert [r.guid for r in pred] == ["5", "3", "9", "1", "200"]   # manifest order kept

    rep = {r.mode: r for r in jobs.ablation_job(spark, f"{d}/out/split", d, f"{d}/out/best_head",
                                                spec).collect()}
    assert set(rep) == {"multimodal", "text_only", "image_only"}
    assert rep["multimodal"].total == 18

    n_bad, first = jobs.bad_case_job(spark, f"{d}/out/split", d, f"{d}/out/best_head",
                                     f"{d}/bad", spec)
    n = n_bad.collect()[0].n_bad
    assert n == 18 - round(rep["multimodal"].acc * 18 / 100)
    assert first.count() == min(5, n)
    from twinlens.sources.manifest import read_bad_cases
    rows_bad = read_bad_cases(spark, f"{d}/bad").collect()
    assert len(rows_bad) == n
    for r in rows_bad:                 # the stripped text, '' where the file is missing
        i = int(r.guid)
        if i % 11 == 0:
            assert not r.text
        else:
            assert r.text.startswith(WORDS[i % 3] + " 图 ")

    rows, summary = jobs.audit_job(spark, f"{d}/train.txt", d, labelled=True)
    s = summary.collect()[0]
    assert s.total == 90
    assert s.n_text == 90 - len([i for i in range(1, 91) if i % 11 == 0])
    assert s.n_image == len([i for i in range(1, 91) if i % 13 == 0 or i % 7 != 0])
    assert s.n_image_readable == len([i for i in range(1, 91) if i % 13 != 0 and i % 7 != 0])
    assert s.n_image_black == 0


def test_streaming_predictions(spark, tmpdir_path):
    import os
    import tempfile
    from twinlens.sources.model_io import load_head
    from twinlens.streaming.scoring import stream_predictions
    d = tmpdir_path
    _corpus(d, 30)
    out = tempfile.mkdtemp(prefix="twinlens-out-")
    spec = jobs.FeatureSpec(image_size=16)
    jobs.train_job(spark, f"{d}/train.txt", d, f"{out}/model", spec, epochs=1, lr=0.01, hidden=8)
    inbox = tempfile.mkdtemp(prefix="twinlens-inbox-")
    with open(f"{inbox}/a.csv", "w") as fh:
        fh.write("guid\n1\n2.0\n999\n")
    with open(f"{inbox}/b.csv", "w") as fh:
        fh.write("guid\n 3 \n")
    q = stream_predictions(spark, inbox, d, load_head(spark, f"{out}/model/best_head"),
                           f"{out}/pred", f"{out}/ckpt", spec)
    q.awaitTermination(120)
    rows = spark.read.parquet(f"{out}/pred").collect()
    assert sorted(r.guid for r in rows) == ["1", "2", "3", "999"]
    assert {r.tag for r in rows} <= {"negative", "neutral", "positive"}


def test_text_encoder_plugs_into_the_jobs(spark, tmpdir_path):
    def encoder():
        return lambda texts: np.asarray([[len(t), 1.0] for t in texts], dtype=float)
    for name, text in (("1", "abc"), ("2", "")):
        with open(f"{tmpdir_path}/{name}.txt", "wb") as fh:
            fh.write(text.encode("gb18030"))
    with open(f"{tmpdir_path}/1.jpg", "wb") as fh:
        fh.write(b"corrupt")
    spec = jobs.FeatureSpec(txt_dim=2, text_encoder=encoder, image_size=16)
    texts, imgs = jobs.blob_features(spark, tmpdir_path, spec)
    m = spark.createDataFrame([(0, "1"), (1, "2"), (2, "3")], "row_no long, guid string")
    rows = jobs.attach_features(m, texts, imgs, spec).orderBy("row_no").collect()
    assert [r.features[spec.img_dim:] for r in rows] == [[3.0, 1.0], [0.0, 1.0], [0.0, 1.0]]
    assert list(spec.empty_text_feature()) == [0.0, 1.0]


def test_own_transform_reaches_train_predict_and_ablation(spark, tmpdir_path):
    """A chain that keeps only how red an image is, and an encoder with nested output, through every job."""
    from twinlens.operators.image_steps import Normalize, Resize, Transform
    d = tmpdir_path
    _corpus(d, 45)

    def red_only(images, draws):
        return [x * np.array([1.0, 0.0, 0.0]) for x in images]

    def pooled():
        return lambda batch: batch.mean(axis=(2, 3)).reshape(len(batch), 3, 1, 1)

    chain = Transform((Resize(4, 4), red_only, Normalize((0.0,) * 3, (0.5,) * 3)))
    spec = jobs.FeatureSpec(img_dim=3, image_encoder=pooled, transform=chain)
    texts, imgs = jobs.blob_features(spark, d, spec)
    got = {int(r.guid): r.img_feat for r in imgs.collect()}
    for i, f in got.items():
        if i % 13 == 0:
            assert f is None
        else:
            assert np.allclose(f, [COLORS[i % 3][0] / 255 / 0.5, 0.0, 0.0])
    assert list(spec.black_feature()) == [0.0, 0.0, 0.0] and list(spec.masked_image_feature()) == [0.0, 0.0, 0.0]
    jobs.train_job(spark, f"{d}/train.txt", d, f"{d}/out", spec, epochs=3, lr=0.05, hidden=8).collect()
    dist = jobs.predict_job(spark, f"{d}/test_without_label.txt", d, f"{d}/out/best_head", f"{d}/pred", spec).collect()
    assert sum(r.n for r in dist) == 5
    rep = {r.mode: r.total for r in jobs.ablation_job(spark, f"{d}/out/split", d, f"{d}/out/best_head", spec).collect()}
    assert rep == dict.fromkeys(("multimodal", "text_only", "image_only"), 9)
