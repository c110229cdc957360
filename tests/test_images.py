import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinlens.operators import image_prep as ip
from twinlens.operators import image_steps as st
from twinlens.sources.blobs import read_image_blobs, read_text_blobs


def bmp_bytes(rgb: np.ndarray) -> bytes:
    """Minimal 24-bit BMP writer for test images (bottom-up, BGR, padded rows)."""
    h, w, _ = rgb.shape
    row = w * 3
    pad = (4 - row % 4) % 4
    data = b"".join(rgb[y, :, ::-1].astype(np.uint8).tobytes() + b"\0" * pad for y in range(h - 1, -1, -1))
    header = b"BM" + struct.pack("<IHHI", 54 + len(data), 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(data), 2835, 2835, 0, 0)
    return header + info + data


def test_resize_weights_and_closed_forms():
    for n_in, n_out in [(8, 5), (5, 8), (640, 224), (10, 224)]:
        w = ip.resize_weights(n_in, n_out)
        assert np.allclose(w.sum(axis=1), 1.0)
    const = np.full((13, 7, 3), 0.25)
    assert np.allclose(ip.resize_rgb(const, 224, 224), 0.25)
    ramp = np.tile(np.arange(8.0)[None, :, None], (8, 1, 3))
    out = ip.resize_rgb(ramp, 8, 16)
    assert np.all(np.diff(out[0, 1:-1, 0]) >= 0)


def test_flip_rotate_properties():
    img = np.random.default_rng(0).random((8, 8, 3))
    assert np.array_equal(ip.rotate_rgb(img, 0.0), img)
    assert np.array_equal(ip.rotate_rgb(img, 90.0), np.rot90(img))
    assert np.array_equal(img[:, ::-1][:, ::-1], img)


def test_grid_ops_match_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(f"g{i}", rng.random(64).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "guid string, px array<double>")
    flipped, out = ip.random_hflip_grid(F.col("px"), F.col("guid"), 8, 8, 1, 42)
    rot = ip.random_rotate_grid(df, "px", "guid", 8, 8, 1, 42, out_col="r")
    res = rot.select("guid", flipped.alias("f"), out.alias("o"), F.col("angle").alias("a"), "r",
                     ip.resize_grid(F.col("px"), 8, 8, 5, 5).alias("z")).collect()
    src = dict(rows)
    for r in res:
        g = np.asarray(src[r.guid]).reshape(8, 8)
        f = ip.draw_py(r.guid, 1, 42, "flip") < ip.flip_threshold(0.5)
        assert r.f == f
        assert np.allclose(np.asarray(r.o).reshape(8, 8), g[:, ::-1] if f else g)
        ang = ip.angle_of(ip.draw_py(r.guid, 1, 42, "rot"))
        assert math.isclose(r.a, ang)
        assert np.allclose(np.asarray(r.r).reshape(8, 8), ip.rotate_rgb(g[:, :, None], ang)[:, :, 0])
        assert np.allclose(np.asarray(r.z).reshape(5, 5), ip.resize_rgb(g[:, :, None], 5, 5)[:, :, 0])


def test_no_image_constants():
    black = np.zeros((4, 4, 3))
    x = ip.prepare_one(black, "g", False, 1, 42, size=4)
    assert np.allclose(x[:, 0, 0], [-2.1179039, -2.0357143, -1.8044444], atol=1e-6)
    feat = ip.black_image_feature(ip.grid_encoder(), size=8)
    assert feat.shape == (72,)


def test_image_source_decode_and_features(spark, tmpdir_path):
    rgb = np.zeros((3, 4, 3), dtype=np.uint8)
    rgb[..., 0], rgb[..., 1], rgb[..., 2] = 10, 20, 30
    with open(f"{tmpdir_path}/1.jpg", "wb") as fh:   # BMP bytes under a .jpg name decode fine
        fh.write(bmp_bytes(rgb))
    grey = np.zeros((5, 6, 3), dtype=np.uint8)
    with open(f"{tmpdir_path}/2.jpg", "wb") as fh:
        fh.write(bmp_bytes(grey))
    with open(f"{tmpdir_path}/3.jpg", "wb") as fh:
        fh.write(b"not an image")
    imgs = read_image_blobs(spark, tmpdir_path)
    got = {r.guid: r for r in imgs.collect()}
    assert got["1"].image_ok and not got["3"].image_ok
    im = got["1"].image
    assert (im.height, im.width) == (3, 4)
    assert ip.rgb_extrema(im.data, im.height, im.width, im.nChannels) == [(10, 10), (20, 20), (30, 30)]
    g2 = got["2"].image
    assert ip.rgb_extrema(g2.data, g2.height, g2.width, g2.nChannels) == [(0, 0)] * 3
    feats = {r.guid: r.img_feat for r in ip.image_features(imgs, size=16).collect()}
    assert feats["3"] is None and len(feats["1"]) == 72


def test_text_blobs_gb18030(spark, tmpdir_path):
    with open(f"{tmpdir_path}/7.txt", "wb") as fh:
        fh.write("  你好 world \r\n".encode("gb18030"))
    with open(f"{tmpdir_path}/8.txt", "wb") as fh:
        fh.write(b"ok\xff\xfe")
    got = {r.guid: r.text for r in read_text_blobs(spark, tmpdir_path).collect()}
    assert got == {"7": "你好 world", "8": b"ok\xff\xfe".decode("gb18030", "ignore").strip()}


def _structs(spark, n=6):
    rng = np.random.default_rng(9)
    rows = [(str(i), ("", 5, 4, 3, 16, bytes(rng.integers(0, 256, 60, dtype=np.uint8)))) for i in range(n)]
    rows += [("bad", ("", -1, -1, -1, -1, b"")), ("none", None)]
    return spark.createDataFrame(
        rows, "guid string, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")


def test_own_chain_and_nested_encoder(spark):
    seen = []

    def darker(images, draws):
        return [x * u for x, u in zip(images, draws.uniform("dark", 0.5, 1.0), strict=True)]

    darker.train_only = True
    chain = st.Transform((st.Resize(4, 6), darker))

    def pooled():
        return lambda batch: batch.mean(axis=(2, 3)).reshape(len(batch), 3, 1, 1)

    plain, train = ({r.guid: r.f for r in ip.image_features(_structs(spark), encoder_factory=pooled, dim=3, transform=chain,
                                                            train=t, epoch=2, out_col="f").collect()} for t in (False, True))
    assert plain["bad"] is None and plain["none"] is None and len(plain) == 8
    for g in map(str, range(6)):
        u = 0.5 + 0.5 * ip.draw_py(g, 2, 42, "dark") / 2 ** 32
        assert np.allclose(np.array(plain[g]) * u, train[g])
        seen.append(u)
    assert len(set(seen)) == 6
    assert chain.black().shape == (1, 3, 4, 6)


def test_draws_do_not_depend_on_batches(spark):
    chain = st.standard(6)
    one, many = ({r.guid: r.t for r in ip.image_tensors(_structs(spark).repartition(n), chain, train=True, epoch=3,
                                                        out_col="t", batch=b).collect()} for n, b in ((1, 32), (4, 1)))
    assert one == many and len(one["0"]) == 108


def test_wrong_shapes_are_told(spark):
    with pytest.raises(ValueError, match="shape"):
        st.flat_features(np.zeros((2, 5)), 2, 4)
    assert st.flat_features(np.zeros((2, 4, 1, 1)), 2, 4).shape == (2, 4)
    with pytest.raises(ValueError, match="several shapes"):
        st.Transform(())([np.zeros((2, 3, 3)), np.zeros((3, 3, 3))], ["a", "b"])
