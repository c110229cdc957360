"""Text preparation.

* ``text_features``: the built-in text encoder, a hashed bag of words,
  L2-normalised. ``hashing='md5'`` (SQL-checkable buckets) runs as an Arrow
  batch UDF with ``np.bincount`` (O(tokens + dim) per row, no shuffle);
  ``hashing='murmur3'`` is Spark ML's ``HashingTF`` + ``Normalizer``, all JVM.
* ``build_vocab``: corpus vocabulary by a distributed word count; the top-k
  cut is a ``TakeOrderedAndProject`` (bounded by k).
* ``encode_words``: word-level ids by a broadcast join with the vocabulary
  (size bounded by k, checked), long form ``(guid, pos, token_id)``.
* ``wordpiece_encode``: BERT-style WordPiece ids in Arrow batches by the public
  ``tokenizers`` library, with a broadcast vocabulary.
* ``pad_batches``: batches of 16 inside hash buckets, padded to the batch's
  longest sequence, with the attention mask.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinlens.functions.udf import arrow_udf
from twinlens.operators.image_steps import flat_features
from twinlens.session import bounded_batches, materialize, spread

# Words are runs of Unicode letters and digits; each Han character is a word.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
_SPLIT_RE = regex.compile(TOKEN_SPLIT)
_HAN_RE = regex.compile(r"(\p{Han})")

# Special tokens of the BERT vocabulary layout used here.
PAD, UNK, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
SPECIALS = [PAD, UNK, CLS, SEP]

# Broadcast guard for vocabularies (entries).
MAX_BROADCAST_VOCAB = 2_000_000


def _spaced(col: Column) -> Column:
    """Lower-cased, a space around every Han character."""
    return F.regexp_replace(F.lower(col), r"(\p{IsHan})", " $1 ")


def word_tokens(c: Column | str) -> Column:
    """lower-case, split on runs of neither letters nor digits, drop empty tokens (native)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(_spaced(col), TOKEN_SPLIT), lambda w: w != "")


def md5_bucket(w: Column, dim: int) -> Column:
    return F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % F.lit(dim)


def _bow_md5_batch(texts: pd.Series, dim: int) -> pd.Series:
    cache: dict[str, int] = {}
    out = []
    for t in texts:
        if t is None:
            out.append(np.zeros(dim))
            continue
        ids = []
        for w in _SPLIT_RE.split(_HAN_RE.sub(r" \1 ", t.lower())):
            if not w:
                continue
            b = cache.get(w)
            if b is None:
                b = int(hashlib.md5(w.encode("utf-8")).hexdigest()[:8], 16) % dim
                cache[w] = b
            ids.append(b)
        counts = np.bincount(np.asarray(ids, dtype=np.int64), minlength=dim).astype(np.float64)
        ss = float((counts * counts).sum())
        out.append(counts / np.sqrt(ss) if ss > 0 else counts)
    return pd.Series(out)


def text_features(df: DataFrame, text_col: str = "text", dim: int = 32,
                  hashing: str = "md5", out_col: str = "txt_feat") -> DataFrame:
    """Hashed bag-of-words vector per row (T4 built-in encoder)."""
    df = spread(df)
    if hashing == "md5":
        bounded_batches(df.sparkSession)

        @arrow_udf(T.ArrayType(T.DoubleType()))
        def bow(texts: pd.Series) -> pd.Series:
            return _bow_md5_batch(texts, dim)
        return df.withColumn(out_col, bow(F.col(text_col)))
    if hashing == "murmur3":
        tok = RegexTokenizer(inputCol="_spaced", outputCol="_toks", pattern=TOKEN_SPLIT,
                             gaps=True, toLowercase=True, minTokenLength=1)
        tf = HashingTF(inputCol="_toks", outputCol="_tf", numFeatures=dim)
        norm = Normalizer(inputCol="_tf", outputCol="_nv", p=2.0)
        out = norm.transform(tf.transform(tok.transform(
            df.withColumn("_spaced", _spaced(F.coalesce(F.col(text_col), F.lit("")))))))
        return (out.withColumn(out_col, vector_to_array(F.col("_nv"), "float64"))
                .drop("_spaced", "_toks", "_tf", "_nv"))
    raise ValueError(f"unknown hashing {hashing!r}")


def text_features_with(df: DataFrame, encoder, dim: int, text_col: str = "text",
                       out_col: str = "txt_feat", batch_size: int = 64) -> DataFrame:
    """Pluggable encoder: ``encoder(list[str])`` returns n rows of ``dim`` values, nested or not.

    Runs once per Arrow batch through ``predict_batch_udf``; the encoder is
    built once per Python worker by the factory ``encoder``.
    """
    from pyspark.ml.functions import predict_batch_udf

    def make_fn():
        fn = encoder()

        def predict(texts: np.ndarray) -> np.ndarray:
            return flat_features(fn([str(t) for t in texts]), len(texts), dim)
        return predict

    bounded_batches(df.sparkSession)
    # nondeterministic: the encoder runs once per row (see functions.udf)
    udf = predict_batch_udf(make_fn, return_type=T.ArrayType(T.DoubleType()),
                            batch_size=batch_size, input_tensor_shapes=None).asNondeterministic()
    return df.withColumn(out_col, udf(F.coalesce(F.col(text_col), F.lit(""))))


def build_vocab(df: DataFrame, size: int, text_col: str = "text") -> DataFrame:
    """Corpus vocabulary (T1): ``(token, cnt, token_id)``, specials first.

    Word count is a partial + final aggregate; the top-``size`` cut keeps the
    most frequent tokens, ties by token, and only ``size`` rows ever leave a task.
    """
    counts = (spread(df).select(F.explode(word_tokens(text_col)).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("cnt")))
    top = counts.orderBy(F.desc("cnt"), F.asc("token")).limit(size)
    # ids follow the frequency order; ranking `size` rows is bounded work
    ranked = top.withColumn("token_id", (F.row_number().over(
        Window.orderBy(F.desc("cnt"), F.asc("token"))) + len(SPECIALS) - 1).cast("int"))
    spark = df.sparkSession
    specials = spark.createDataFrame(
        [(t, None, i) for i, t in enumerate(SPECIALS)], "token string, cnt bigint, token_id int")
    # a fitted artefact (<= size rows): materialise once in the shared folder
    return materialize(specials.unionByName(ranked).coalesce(1), "vocab")


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A published one-token-per-line ``vocab.txt`` as ``(token, cnt, token_id)``."""
    lines = spark.read.text(path)
    return (lines.select(F.col("value").alias("token"),
                         (F.monotonically_increasing_id()).alias("_mid"))
            .withColumn("token_id", (F.row_number().over(Window.orderBy("_mid")) - 1).cast("int"))
            .select("token", F.lit(None).cast("bigint").alias("cnt"), "token_id"))


def _checked_broadcast(vocab: DataFrame, limit: int = MAX_BROADCAST_VOCAB) -> DataFrame:
    n = vocab.count()
    if n > limit:
        return vocab
    return F.broadcast(vocab)


def encode_words(df: DataFrame, vocab: DataFrame, max_len: int = 128,
                 guid_col: str = "guid", text_col: str = "text") -> DataFrame:
    """Word-level encoding in long form ``(guid, pos, token_id)``.

    ``[CLS]`` at pos 0, content truncated to ``max_len - 2`` words, ``[SEP]``
    last; out-of-vocabulary words map to ``[UNK]``. One posexplode of the framed
    token list and one join with the vocabulary: broadcast when its size is
    within the guard, else a shuffle join.
    """
    unk = vocab.where(F.col("token") == UNK).select("token_id").collect()[0][0]
    framed = F.concat(F.array(F.lit(CLS)), F.slice(word_tokens(text_col), 1, max_len - 2),
                      F.array(F.lit(SEP)))
    toks = spread(df).select(F.col(guid_col).alias("guid"), F.posexplode(framed).alias("pos", "token"))
    return (toks.join(_checked_broadcast(vocab.select("token", "token_id")), "token", "left")
            .select("guid", "pos", F.coalesce(F.col("token_id"), F.lit(unk)).alias("token_id")))


# ---------------------------------------------------------------- WordPiece

def wordpiece_encode(df: DataFrame, vocab: DataFrame, max_len: int = 128,
                     text_col: str = "text", out_col: str = "input_ids") -> DataFrame:
    """BERT-style ids ``[CLS] … [SEP]`` truncated to ``max_len`` (T2), by the public ``tokenizers`` library.

    The vocabulary (bounded, checked) is broadcast once; every worker builds the
    tokenizer once and encodes Arrow batches. A null text counts as empty.
    """
    rows = vocab.select("token", "token_id").limit(MAX_BROADCAST_VOCAB + 1).collect()
    if len(rows) > MAX_BROADCAST_VOCAB:
        raise ValueError("vocabulary exceeds the broadcast guard")
    known = df.sparkSession.sparkContext.broadcast({r.token: int(r.token_id) for r in rows})

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, processors
        v = known.value
        tok = Tokenizer(models.WordPiece(v, unk_token=UNK, max_input_chars_per_word=100))
        tok.normalizer = normalizers.BertNormalizer()
        tok.pre_tokenizer = pre_tokenizers.BertPreTokenizer()
        tok.post_processor = processors.BertProcessing((SEP, v[SEP]), (CLS, v[CLS]))
        tok.enable_truncation(max_len)
        for texts in batches:
            yield pd.Series([e.ids for e in tok.encode_batch([t or "" for t in texts])], dtype=object)

    bounded_batches(df.sparkSession)
    return spread(df).withColumn(out_col, enc.asNondeterministic()(F.col(text_col)))


# ---------------------------------------------------------------- batches

def number_rows(df: DataFrame, order_col: str = "row_no", out_col: str = "row_index") -> DataFrame:
    """Position of every row in the order of the unique ``order_col``, 0 first, with no single-task sort.

    Rows are range-partitioned, sorted and written out with partition and
    position; one count per partition gives the partition's first number.
    """
    at = materialize(df.repartitionByRange(F.col(order_col)).sortWithinPartitions(order_col)
                     .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    at = at.withColumn("_p", F.shiftright("_at", 33))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = at.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return at.join(parts, "_p").withColumn(out_col, place).drop("_p", "_at", "_base")


def assign_batches(df: DataFrame, batch_size: int = 16, order_col: str = "row_no") -> DataFrame:
    """``batch_id`` of consecutive rows in the order of ``order_col`` (E2); only the last batch may be short."""
    out = number_rows(df, order_col, "_i")
    return out.withColumn("batch_id", F.floor(F.col("_i") / batch_size).cast("bigint")).drop("_i")


def encode_rows(df: DataFrame, vocab: DataFrame, max_len: int = 128, text_col: str = "text",
                out_col: str = "input_ids") -> DataFrame:
    """``[CLS]``, the ids of the first ``max_len - 2`` words, ``[SEP]``, without leaving the row.

    ``vocab`` is ``build_vocab``'s: its k tokens are broadcast, checked against
    ``MAX_BROADCAST_VOCAB``. Words stay in Arrow's buffers: no Python object is made for one.
    """
    rows = vocab.select("token", "token_id").limit(MAX_BROADCAST_VOCAB + 1).collect()
    if len(rows) > MAX_BROADCAST_VOCAB:
        raise ValueError("vocabulary exceeds the broadcast guard")
    known = df.sparkSession.sparkContext.broadcast({r.token: r.token_id for r in rows})

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def enc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = known.value
        tokens, ids = pa.array(list(v), pa.string()), pa.array(list(v.values()), pa.int32())
        for words in batches:
            found = ids.take(pc.index_in(words.flatten(), value_set=tokens)).fill_null(v[UNK])
            ends = np.cumsum(words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) + 2, dtype=np.int32)
            starts = np.concatenate([np.zeros(1, np.int32), ends])
            framed, inner = np.empty(starts[-1], np.int32), np.ones(starts[-1], bool)
            framed[starts[:-1]], framed[ends - 1] = v[CLS], v[SEP]
            inner[starts[:-1]] = inner[ends - 1] = False
            framed[inner] = found.to_numpy(zero_copy_only=False)
            yield pa.ListArray.from_arrays(pa.array(starts), pa.array(framed))

    bounded_batches(df.sparkSession)
    return df.withColumn(out_col, enc.asNondeterministic()(F.slice(word_tokens(text_col), 1, max_len - 2)))


def pad_batches(df: DataFrame, ids_col: str = "input_ids", mode: str = "longest",
                max_len: int = 128) -> DataFrame:
    """Pad ids to the batch's longest (or to ``max_len``) and add the mask."""
    size = F.size(F.col(ids_col))
    if mode == "longest":
        target = F.max(size).over(Window.partitionBy("batch_id"))
    elif mode == "max_length":
        target = F.lit(max_len)
    else:
        raise ValueError(mode)
    df = df.withColumn("padded_len", target).withColumn("seq_len", size)
    n = F.col("seq_len")            # the unpadded length, fixed before ids are replaced
    padded = F.concat(F.col(ids_col), F.array_repeat(F.lit(0), F.col("padded_len") - n))
    mask = F.transform(F.sequence(F.lit(0), F.col("padded_len") - 1),
                       lambda i: F.when(i < n, 1).otherwise(0))
    return df.withColumn(ids_col, padded).withColumn("attention_mask", mask)
