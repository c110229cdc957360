from pyspark.sql import functions as F

from twinlens.sources import manifest as mf
from twinlens.operators.modality import prepare_manifest
from twinlens.operators.fusion import Block, Head
from twinlens.sources.model_io import load_head, save_head
import numpy as np


def test_read_manifest_na_and_order(spark, tmpdir_path):
    p = f"{tmpdir_path}/train.txt"
    with open(p, "w") as fh:
        fh.write("guid,tag,extra\n8.0,positive,x\nNA,neutral,y\n 12 ,negative,z\n,positive,w\n")
    m = prepare_manifest(mf.read_manifest(spark, p))
    rows = m.orderBy("row_no").collect()
    assert [r.guid for r in rows] == ["8", "nan", "12", "nan"]
    assert [r.label for r in rows] == [2, 1, 0, 2]


def test_headerless_manifest(spark, tmpdir_path):
    p = f"{tmpdir_path}/test.txt"
    with open(p, "w") as fh:
        fh.write("5\n6.0\n")
    m = mf.read_manifest(spark, p, labelled=False, header=False)
    assert [r.guid for r in m.orderBy("row_no").collect()] == ["5", "6.0"]


def test_predictions_and_bad_cases_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([(i, str(i), "positive") for i in range(50, 0, -1)], "row_no long, guid string, tag string")
    mf.write_predictions(df.repartition(4), f"{tmpdir_path}/pred")
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/pred")
    assert back.count() == 50
    bad = spark.createDataFrame([("1", 'say "hi"\nnext line', "negative", "positive")],
                                "guid string, text string, true_label string, pred_label string")
    mf.write_bad_cases(bad, f"{tmpdir_path}/bad")
    r = mf.read_bad_cases(spark, f"{tmpdir_path}/bad").collect()[0]
    assert r.text == 'say "hi"\nnext line'


def test_split_partition_pruning(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", "val"), (2, "b", "train")], "row_no long, guid string, split string")
    mf.write_split(df, f"{tmpdir_path}/split")
    v = mf.read_split(spark, f"{tmpdir_path}/split", "val")
    assert [r.guid for r in v.collect()] == ["a"]
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan


def test_head_save_load(spark, tmpdir_path):
    rng = np.random.default_rng(0)
    head = Head([(rng.normal(size=(4, 6)), rng.normal(size=4)), (rng.normal(size=(3, 4)), np.zeros(3))],
                [Block("img", 0, 3), Block("txt", 3, 6)], {"img": np.ones(4)}, "mlp")
    save_head(spark, head, f"{tmpdir_path}/head")
    h2 = load_head(spark, f"{tmpdir_path}/head")
    x = rng.normal(size=(5, 6))
    assert np.allclose(h2.forward(x), head.forward(x)) and h2.blocks == head.blocks


def test_manifest_keys_cut_blobs_before_decoding(spark, tmpdir_path, monkeypatch):
    from twinlens.sources import blobs
    d = tmpdir_path
    for g in ("1", "2", "3"):
        with open(f"{d}/{g}.txt", "wb") as fh:
            fh.write(f"text {g}".encode("gb18030"))
    m = spark.createDataFrame([("2",), ("2",), ("9",)], "guid string")
    keys = blobs.manifest_keys(m)
    t = blobs.read_text_blobs(spark, d, guids=keys)
    assert [(r.guid, r.text) for r in t.collect()] == [("2", "text 2")]
    assert "LeftSemi" in t._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(blobs, "MAX_SEMI_KEYS", 1)
    assert blobs.manifest_keys(m) is None                       # 2 distinct guids > 1
    assert sorted(r.guid for r in blobs.read_text_blobs(spark, d, guids=None).collect()) == ["1", "2", "3"]


def test_split_manifest_scan_keeps_file_order(spark, tmpdir_path):
    from twinlens.sources.manifest import read_manifest
    path = f"{tmpdir_path}/m.csv"
    with open(path, "w") as fh:
        fh.write("guid,tag\n" + "".join(f"{i * 7919 % 100003},positive\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        m = read_manifest(spark, path)
        assert m.rdd.getNumPartitions() > 4                     # the file is split
        got = [r.guid for r in m.orderBy("row_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [str(i * 7919 % 100003) for i in range(20000)]


def test_manifest_order_over_files_of_different_size(spark, tmpdir_path):
    for name, n in (("a", 3), ("b", 2000), ("c", 7)):
        with open(f"{tmpdir_path}/{name}.csv", "w") as fh:
            fh.write("guid,tag\n" + "".join(f"{name}{i},neutral\n" for i in range(n)))
    rows = mf.read_manifest(spark, tmpdir_path).orderBy("row_no").collect()
    assert [r.guid for r in rows] == [f"{name}{i}" for name, n in (("a", 3), ("b", 2000), ("c", 7)) for i in range(n)]
    assert [r.row_no for r in rows] == list(range(2010))


def test_corrupt_manifest_lines_are_reported(spark, tmpdir_path):
    with open(f"{tmpdir_path}/m.csv", "w") as fh:
        fh.write("guid,tag\n1,neutral\n2\n3,positive,x,y\n")
    rows = mf.read_manifest(spark, tmpdir_path, corrupt=True).orderBy("row_no").collect()
    assert [r.guid for r in rows] == ["1", "2", "3"]
    assert [r["_corrupt"] for r in rows] == [None, "2", "3,positive,x,y"]


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest
    from twinlens.session import checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf={}))


def test_registered_split_reads_one_folder(spark):
    import __spark_entry__ as se
    df = se.queries()["split_store"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]", 1)[0]
    assert "split" in filters and "val" in filters
    assert {f.rsplit("/", 2)[-2] for f in df.inputFiles()} >= {"split=val"}


def test_written_manifest_has_files_of_different_size(spark):
    from twinlens.plans import file_queries as fq
    part = F.least(F.lit(fq.FILES - 1), F.floor(F.log2(F.col("at") + 1) / 2)).cast("int")
    sizes = [r["count"] for r in fq._manifest_lines(spark, "/root/testdata/sf0.01").groupBy(part).count().collect()]
    assert len(sizes) >= 5 and max(sizes) > 20 * min(sizes)


def test_empty_text_survives_the_bad_case_file(spark, tmpdir_path):
    bad = spark.createDataFrame([("1", "", "negative", "positive"), ("2", '""', "neutral", "positive")],
                                "guid string, text string, true_label string, pred_label string")
    mf.write_bad_cases(bad, f"{tmpdir_path}/bad")
    assert {r.guid: r.text for r in mf.read_bad_cases(spark, f"{tmpdir_path}/bad").collect()} == {"1": "", "2": '""'}


def test_no_listing_of_input_files_in_the_package():
    import pathlib
    root = pathlib.Path(__file__).resolve().parent.parent / "twinlens"
    assert [p for p in root.rglob("*.py") if "inputFiles(" in p.read_text()] == []


def test_spread_deals_small_inputs_only(spark, tmpdir_path, monkeypatch):
    from twinlens import session as ss
    spark.range(1000).coalesce(1).write.parquet(f"{tmpdir_path}/one")
    df = spark.read.parquet(f"{tmpdir_path}/one")
    assert ss.spread(df, 5).rdd.getNumPartitions() == 5
    monkeypatch.setattr(ss, "SPREAD_BYTES", 10)
    assert ss.spread(df, 5).rdd.getNumPartitions() == df.rdd.getNumPartitions()
