"""Registered queries through files: what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinlens.functions.text import decode_report
from twinlens.operators.evaluate import bad_cases
from twinlens.operators.modality import attach_text
from twinlens.operators.text_prep import build_vocab, encode_rows, number_rows, pad_batches
from twinlens.operators.training import epoch_order_key
from twinlens.plans import pipeline as pl
from twinlens.plans.fixtures import fx_edge_blob, fx_manifest, fx_text, with_ctes
from twinlens.plans.registry import (MAX_LEN, VOCAB_SIZE, _BAD_SQL, _strip_sql, _tok_query, register)
from twinlens.session import materialize, scratch_path, spread
from twinlens.sources.manifest import (read_bad_cases, read_manifest, read_split, write_bad_cases, write_predictions,
                                       write_split)

#: Files of the written manifest; each holds about four times the rows of the one before.
FILES = 6


def _manifest_lines(spark, sf):
    """``(at, k, line)``: the manifest's lines in order, after some of them a line with too few or too many fields."""
    m = fx_manifest(spark, sf)
    short = F.concat(F.lit("broken-"), F.col("row_no").cast("string"))
    long = F.concat(F.col("row_no").cast("string"), F.lit(",neutral,left,over"))
    lines = F.array(F.struct(F.lit(0).alias("k"), F.concat_ws(",", "guid", "tag").alias("line")),
                    F.struct(F.lit(1).alias("k"), F.when(F.col("row_no") % 11 == 3, short).alias("line")),
                    F.struct(F.lit(2).alias("k"), F.when(F.col("row_no") % 13 == 5, long).alias("line")))
    return m.select(F.col("row_no").alias("at"), F.explode(lines).alias("l")).select("at", "l.*").where("line is not null")


@register("manifest_roundtrip", with_ctes("""
SELECT row_number() OVER (ORDER BY spot, k) - 1 AS row_no, guid, tag, corrupt FROM (
  SELECT row_no AS spot, 0 AS k, guid, tag, CAST(NULL AS VARCHAR) AS corrupt FROM fx_manifest
  UNION ALL SELECT row_no, 1, 'broken-' || row_no, NULL, 'broken-' || row_no FROM fx_manifest WHERE row_no % 11 = 3
  UNION ALL SELECT row_no, 2, CAST(row_no AS VARCHAR), 'neutral', row_no || ',neutral,left,over'
  FROM fx_manifest WHERE row_no % 13 = 5) x""", "fx_manifest"))
def q_manifest_roundtrip(spark, sf):
    """The manifest as CSV files of very different size, with malformed lines, read back and numbered in file order."""
    path = scratch_path(spark, "manifest-csv")
    part = F.least(F.lit(FILES - 1), F.floor(F.log2(F.col("at") + 1) / 2)).cast("int")
    (_manifest_lines(spark, sf).repartitionById(FILES, part).sortWithinPartitions("at", "k")
     .select("line").write.text(path))
    rows = read_manifest(spark, path, header=False, corrupt=True)
    return rows.select("row_no", "guid", "tag", F.col("_corrupt").alias("corrupt"))


@register("split_store", with_ctes("SELECT row_no, guid, tag, split FROM split WHERE split = 'val'", "split"))
def q_split_store(spark, sf):
    """The validation rows of the stored split; only their folder is read."""
    path = scratch_path(spark, "split-store")
    write_split(pl.split_fixture(spark, sf).select("row_no", "guid", "tag", "split"), path)
    return read_split(spark, path, "val").select("row_no", "guid", "tag", "split")


@register("prediction_file", with_ctes(
    "SELECT row_number() OVER (ORDER BY row_no) - 1 AS row_no, guid, tag FROM test_pred", "test_pred"))
def q_prediction_file(spark, sf):
    """Predictions written as CSV in manifest order and read back in file order."""
    path = scratch_path(spark, "predictions-csv")
    write_predictions(pl.predict_fixture(spark, sf), path)
    return read_manifest(spark, path)


@register("bad_case_file", with_ctes(_BAD_SQL, "val_pred", "fx_text"))
def q_bad_case_file(spark, sf):
    """Misclassified rows with their whole texts through the quoted CSV file."""
    path = scratch_path(spark, "bad-cases-csv")
    s = pl.scored_val(spark, sf)
    wrong = materialize(s.where(F.col("pred") != F.col("label")).select("row_no", "guid", "label", "pred"), "wrong")
    write_bad_cases(bad_cases(attach_text(wrong, pl.manifest_texts(spark, sf, wrong))), path)
    return read_bad_cases(spark, path)


@register("text_readability", with_ctes(f"""
SELECT guid, {_strip_sql("replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))")} AS text,
       CAST(guid AS BIGINT) % 10 NOT IN (1, 4, 7) AS readable
FROM fx_edge_text""", "fx_edge_text"))
def q_text_readability(spark, sf):
    """Texts decoded from bytes of which some are malformed, and whether all of them were valid."""
    r = spread(fx_edge_blob(spark, sf)).select("guid", decode_report("blob").alias("r"))
    return r.select("guid", "r.text", F.col("r.ok").alias("readable"))


@register("pad_max_length", _tok_query(f"""
SELECT guid, CAST(least(len(ws), {MAX_LEN - 2}) + 2 AS INTEGER) AS seq_len, {MAX_LEN} AS padded_len,
       CAST(least(len(ws), {MAX_LEN - 2}) + 2 AS INTEGER) AS n_mask, {MAX_LEN} AS n_ids,
       CASE WHEN len(ws) < {MAX_LEN - 2} THEN 0 ELSE 3 END AS last_id
FROM tok"""))
def q_pad_max_length(spark, sf):
    """Every text padded to the fixed length, whatever its batch."""
    t = fx_text(spark, sf)
    p = pad_batches(encode_rows(spread(t), build_vocab(t, VOCAB_SIZE), MAX_LEN), "input_ids", "max_length", MAX_LEN)
    n_mask = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return p.select("guid", "seq_len", "padded_len", n_mask.alias("n_mask"), F.size("input_ids").alias("n_ids"),
                    F.element_at("input_ids", -1).alias("last_id"))


@register("epoch_order", with_ctes("""
SELECT epoch, guid, row_number() OVER (PARTITION BY epoch ORDER BY md5(guid || '|' || epoch || '|42'), row_no) - 1 AS place
FROM split, (VALUES (1), (2)) e(epoch) WHERE split = 'train'""", "split"))
def q_epoch_order(spark, sf):
    """Each training row's place in two epochs, numbered without a sort in one task."""
    train = pl.split_fixture(spark, sf).where(F.col("split") == "train").select("guid", "row_no")
    out = None
    for epoch in (1, 2):
        keyed = train.withColumn("key", F.struct(epoch_order_key("guid", epoch, 42), "row_no"))
        one = number_rows(keyed, "key", "place").select(F.lit(epoch).alias("epoch"), "guid", "place")
        out = one if out is None else out.union(one)
    return out
