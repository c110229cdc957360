import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from twinlens.functions.arrays import argmax, cross_entropy, softmax, relu, affine
from twinlens.functions.guid import normalize_guid
from twinlens.functions.labels import decode_label, encode_label
from twinlens.functions.text import decode_text, strip_ws


def py_guid(x):
    """The reference's repair rule."""
    if x is None or x == "":
        return "nan"
    try:
        return str(int(float(x)))
    except Exception:  # noqa: BLE001
        return str(x)


GOLDEN = [("8", "8"), ("8.0", "8"), (" 8 ", "8"), ("1e3", "1000"), ("-0.5", "0"),
          ("-3.7", "-3"), (".5", "0"), ("5.", "5"), ("9007199254740993", "9007199254740992"),
          ("1e20", "100000000000000000000"), ("8d", "8d"), ("abc", "abc"), ("nan", "nan"),
          ("", "nan"), (None, "nan"), ("1_000", "1000"), ("1e23", "99999999999999991611392"),
          ("-1e19", "-10000000000000000000"), ("inf", "inf"), ("　8　", "8")]


def test_guid_golden(spark):
    df = spark.createDataFrame([(a,) for a, _ in GOLDEN], "g string")
    got = [r[0] for r in df.select(normalize_guid("g")).collect()]
    assert got == [b for _, b in GOLDEN]
    # the golden table is the reference rule itself
    assert [py_guid(a) for a, _ in GOLDEN] == [b for _, b in GOLDEN]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(
    st.integers(-10**17, 10**17).map(str),
    st.floats(allow_nan=False, allow_infinity=False, min_value=-1e17, max_value=1e17).map(repr),
    st.text(alphabet="0123456789.eE+- _", max_size=6)), min_size=1, max_size=60))
def test_guid_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "g string")
    got = [r[0] for r in df.select(normalize_guid("g")).collect()]
    assert got == [py_guid(v) for v in values]


def test_large_guids_keep_every_digit(spark):
    values = ["1e38", "-1e40", "1e22", "1.7976931348623157e308", "9223372036854775808", "1e999", "-1e999",
              *[repr(float(2**k + 2**(k - 52))) for k in range(63, 1023, 37)],
              *[repr(float(2**k - 2**(k - 53))) for k in range(64, 1024, 41)]]
    df = spark.createDataFrame([(v,) for v in values], "g string")
    assert [r[0] for r in df.select(normalize_guid("g")).collect()] == [py_guid(v) for v in values]


def test_strip_unicode(spark):
    df = spark.createDataFrame([("　 \na b\n 　",), ("\x1c x \x1f",)], "t string")
    assert [r[0] for r in df.select(strip_ws("t")).collect()] == ["a b", "x"]


def test_gb18030_decode_drops_bad_bytes(spark):
    good = "图像 sentiment 很好".encode("gb18030")
    bad = good[:3] + b"\xff\xff" + good[3:]
    df = spark.createDataFrame([(bytearray(good),), (bytearray(bad),), (bytearray(b" \r\nx\r\n"),)],
                               "b binary")
    got = [r[0] for r in df.select(decode_text("b", "gb18030")).collect()]
    expect = [bytes(x).decode("gb18030", "ignore").replace("\r\n", "\n").strip()
              for x in (good, bad, b" \r\nx\r\n")]
    assert got == expect
    assert got[0] == "图像 sentiment 很好"
    assert got[1] != got[0] and got[1].endswith("sentiment 很好")


def test_labels_roundtrip_and_strict(spark):
    df = spark.createDataFrame([("negative",), ("neutral",), ("positive",)], "tag string")
    out = df.select(encode_label("tag").alias("y")).select("y", decode_label("y").alias("t")).collect()
    assert [(r.y, r.t) for r in out] == [(0, "negative"), (1, "neutral"), (2, "positive")]
    bad = spark.createDataFrame([("happy",)], "tag string")
    with pytest.raises(Exception):
        bad.select(encode_label("tag")).collect()
    assert bad.select(encode_label("tag", strict=False)).collect()[0][0] is None


def test_argmax_ties_softmax_xent(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], 2), ([1000.0, 999.0, 0.0], 0)], "z array<double>, y int")
    r = df.select(argmax("z").alias("a"), softmax("z").alias("p"), cross_entropy("z", "y").alias("l")).collect()
    assert r[0].a == 1 and r[1].a == 0
    for row, (z, y) in zip(r, [([1.0, 3.0, 3.0], 2), ([1000.0, 999.0, 0.0], 0)]):
        assert math.isclose(sum(row.p), 1.0, rel_tol=1e-12)
        zz = np.asarray(z)
        ref = np.log(np.exp(zz - zz.max()).sum()) + zz.max() - zz[y]
        assert math.isclose(row.l, ref, rel_tol=1e-12, abs_tol=1e-12)


def test_relu_affine_matches_numpy(spark):
    w = [[0.5, -1.0], [2.0, 0.25], [-1.0, -1.0]]
    b = [0.1, -0.2, 0.0]
    df = spark.createDataFrame([([1.0, 2.0],), ([-3.0, 0.5],)], "x array<double>")
    got = [r[0] for r in df.select(relu(affine("x", w, b))).collect()]
    for g, x in zip(got, ([1.0, 2.0], [-3.0, 0.5])):
        ref = np.maximum(np.asarray(w) @ np.asarray(x) + np.asarray(b), 0)
        assert np.allclose(g, ref)


def test_strip_ws_matches_python_for_every_whitespace_char(spark):
    ws = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    keep = ["​", "﻿", "x", "中"]            # not whitespace for str.strip()
    rows = [(w + "a" + k + w + w, ) for w in ws for k in keep] + [("".join(ws),), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(strip_ws("t")).collect()]
    assert got == [None if t is None else t.strip() for (t,) in rows]


def test_decode_report_tells_valid_bytes_from_others(spark):
    from twinlens.functions.text import decode_report
    rows = [("  图 ok\r\n".encode("gb18030"), "图 ok", True), (b"ab\xff\xffcd", "abcd", False), (b"tail\x81", "tail", False),
            (b"", "", True), (None, None, False)]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, b binary")
    got = df.select("i", decode_report("b").alias("r")).orderBy("i").select("r.*").collect()
    assert [tuple(r) for r in got] == [r[1:] for r in rows]
