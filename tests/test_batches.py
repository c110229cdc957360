"""Arrow batches of whole texts stay within a fixed size, however many rows a partition has."""
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinlens import session as ss
from twinlens.functions.text import decode_report, decode_text, encode_gb18030
from twinlens.operators.text_prep import build_vocab, encode_rows, text_features, text_features_with, wordpiece_encode

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@F.pandas_udf(T.LongType())
def batch_bytes(s: pd.Series) -> pd.Series:
    return pd.Series([int(s.str.len().sum())] * len(s))


@pytest.fixture
def texts(spark):
    spark.conf.set(KEY, "64m")
    yield spark.range(0, 64, 1, 1).select(F.col("id").cast("string").alias("guid"), F.repeat(F.lit("ab c"), 1 << 17).alias("text"))
    spark.conf.unset(KEY)


def largest(df):
    size = df.select(batch_bytes.asNondeterministic()(F.col("text")).alias("n"), *[c for c in df.columns if c != "text"])
    return size.agg(F.max("n"), *[F.count(c) for c in size.columns if c != "n"]).first()[0]


@pytest.mark.parametrize("step", [lambda: encode_gb18030(F.col("text")), lambda: decode_text(F.encode("text", "utf-8"), "gb18030"),
                                  lambda: decode_text(F.encode("text", "utf-8"), "big5"),
                                  lambda: decode_report(F.encode("text", "utf-8"))["text"]])
def test_batches_of_decoded_texts_are_small(texts, step):
    assert largest(texts.withColumn("out", F.length(step()))) <= ss.BATCH_BYTES + (1 << 20)


@pytest.mark.parametrize("step", [text_features, lambda df: text_features_with(
    df.coalesce(1), lambda: lambda ts: [[float(len(t))] for t in ts], 1)])
def test_batches_of_encoded_texts_are_small(texts, step):
    assert largest(step(texts)) <= ss.BATCH_BYTES + (1 << 20)


@pytest.mark.parametrize("encode", [encode_rows, wordpiece_encode])
def test_batches_of_tokenised_texts_are_small(texts, encode):
    assert largest(encode(texts, build_vocab(texts, 10), 8)) <= ss.BATCH_BYTES + (1 << 20)


def test_encoded_rows_by_hand(spark):
    rows = [("a", "b a b 你好 c"), ("n", None), ("e", ""), ("u", "zz [UNK] b"), ("x", "a\x00b B " * 9)]
    df = spark.createDataFrame(rows, "guid string, text string")
    vocab = spark.createDataFrame([("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3), ("b", 4), ("a", 5), ("你", 6)],
                                  "token string, token_id int")
    got = {r.guid: list(r.input_ids) for r in encode_rows(df, vocab, 8).collect()}
    assert got == {"a": [2, 4, 5, 4, 6, 1, 1, 3], "n": [2, 3], "e": [2, 3], "u": [2, 1, 1, 4, 3],
                   "x": [2, 5, 4, 4, 5, 4, 4, 3]}


@pytest.mark.parametrize("given, kept", [("1m", "1m"), ("4m", "4m"), ("300000", "300000"), ("5m", str(4 << 20)),
                                         ("1g", str(4 << 20)), ("67108864b", str(4 << 20))])
def test_a_smaller_limit_stays(spark, given, kept):
    spark.conf.set(KEY, given)
    ss.bounded_batches(spark)
    got = spark.conf.get(KEY)
    spark.conf.unset(KEY)
    assert got.removesuffix("b") == kept
