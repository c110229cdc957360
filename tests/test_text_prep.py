import numpy as np
from pyspark.sql import functions as F

from twinlens.operators import text_prep as tp


def _vocab(spark, tokens):
    rows = [(t, None, i) for i, t in enumerate(tp.SPECIALS + tokens)]
    return spark.createDataFrame(rows, "token string, cnt bigint, token_id int")


def test_wordpiece_greedy_longest_match(spark):
    toks = ["un", "##aff", "##able", "hello", ",", "world", "图", "cafe"]
    v = _vocab(spark, toks)
    df = spark.createDataFrame([("UnAffable, hello  World!",), ("图像 Café",), ("",)], "text string")
    got = [r.ids for r in tp.wordpiece_encode(df, v, max_len=6, out_col="ids").collect()]
    ids = {t: i for i, t in enumerate(tp.SPECIALS + toks)}
    assert got[0] == [2, ids["un"], ids["##aff"], ids["##able"], ids[","], 3]      # truncated to 6
    assert got[1] == [2, ids["图"], 1, ids["cafe"], 3]                             # 像 unknown, accent stripped
    assert got[2] == [2, 3]


def test_wordpiece_word_rules(spark):
    toks = ["hello", ",", "world", "中", "文", "x", "##x"]
    ids = {t: i for i, t in enumerate(tp.SPECIALS + toks)}
    df = spark.createDataFrame([("Héllo,WORLD\x00 中文",), ("x" * 101,), ("xxx",), (None,)], "text string")
    got = [r.ids for r in tp.wordpiece_encode(df, _vocab(spark, toks), out_col="ids").collect()]
    assert got[0] == [2, *[ids[t] for t in ("hello", ",", "world", "中", "文")], 3]
    assert got[1:] == [[2, 1, 3], [2, ids["x"], ids["##x"], ids["##x"], 3], [2, 3]]


def test_load_vocab_order(spark, tmpdir_path):
    with open(f"{tmpdir_path}/vocab.txt", "w") as fh:
        fh.write("[PAD]\n[UNK]\n[CLS]\n[SEP]\nthe\nof\n")
    v = tp.load_vocab(spark, f"{tmpdir_path}/vocab.txt").orderBy("token_id").collect()
    assert [(r.token, r.token_id) for r in v] == [("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2),
                                                  ("[SEP]", 3), ("the", 4), ("of", 5)]


def test_murmur3_features_normalised(spark):
    df = spark.createDataFrame([("a b b",), (None,)], "text string")
    out = [r.txt_feat for r in tp.text_features(df, dim=16, hashing="murmur3").collect()]
    assert abs(np.linalg.norm(out[0]) - 1.0) < 1e-12 and sum(1 for x in out[0] if x) == 2
    assert not any(out[1])


def test_pluggable_text_encoder(spark):
    def factory():
        return lambda texts: np.asarray([[len(t), t.count("a")] for t in texts], dtype=float)
    df = spark.createDataFrame([("banana",), (None,)], "text string")
    out = [r.txt_feat for r in tp.text_features_with(df, factory, 2).collect()]
    assert out == [[6.0, 3.0], [0.0, 0.0]]


def test_batches_follow_the_row_order(spark):
    keys = [(7 * i) % 1000 for i in range(1000)]
    df = spark.createDataFrame([(k,) for k in keys], "row_no long").repartition(5)
    out = {r.row_no: r.batch_id for r in tp.assign_batches(df, batch_size=16).collect()}
    assert out == {k: i // 16 for i, k in enumerate(sorted(keys))}
    assert tp.assign_batches(df.limit(0)).count() == 0


def test_pad_batches_longest_and_mask(spark):
    df = spark.createDataFrame([(0, [2, 5, 3]), (1, [2, 3]), (2, [2, 7, 8, 9, 3])],
                               "row_no long, input_ids array<int>")
    b = tp.assign_batches(df, batch_size=2)
    out = {r.row_no: r for r in tp.pad_batches(b).collect()}
    assert out[0].padded_len == 3 and out[1].input_ids == [2, 3, 0]
    assert out[1].attention_mask == [1, 1, 0]
    assert out[2].padded_len == 5 and out[2].seq_len == 5


def test_words_of_any_script_count(spark):
    from twinlens.operators.text_prep import text_features, word_tokens
    df = spark.createDataFrame([("été über",), ("图像很好",), ("a1-b",), (None,)], "text string")
    toks = [r.w for r in df.select(word_tokens("text").alias("w")).collect()]
    assert toks[:3] == [["été", "über"], list("图像很好"), ["a1", "b"]]
    for hashing in ("md5", "murmur3"):
        vecs = [r.txt_feat for r in text_features(df, hashing=hashing).orderBy(F.col("text").isNull()).collect()]
        assert all(any(v) for v in vecs[:3])
