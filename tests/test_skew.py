"""A hot guid (a third of the manifest) in the modality join."""

from pyspark.sql import functions as F

from twinlens.operators.modality import attach_text

_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "32",
    # thresholds scaled down to test size (defaults: factor 5, 256 MB)
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


def test_hot_guid_left_join_is_split_and_keeps_rows(spark):
    old = {k: spark.conf.get(k, None) for k in _CONF}
    try:
        for k, v in _CONF.items():
            spark.conf.set(k, v)
        n = 60_000
        m = spark.range(n).select(
            F.col("id").alias("row_no"),
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .otherwise((F.col("id") % 5000).cast("string")).alias("guid"))
        t = (spark.range(5000).select(F.col("id").cast("string").alias("guid"),
                                      F.repeat(F.lit("x"), 50).alias("text"))
             .union(spark.createDataFrame([("hot", "hot text")], "guid string, text string")))
        j = attach_text(m, t)
        rows = j.collect()
        assert len(rows) == n and len({r.row_no for r in rows}) == n
        hot = [r for r in rows if r.guid == "hot"]
        assert len(hot) == 20_000 and all(r.has_text and r.text == "hot text" for r in hot)
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_guid_is_salted_when_aqe_skew_split_is_off(spark, monkeypatch):
    from twinlens.operators import modality
    conf = dict(_CONF, **{"spark.sql.adaptive.skewJoin.enabled": "false"})
    old = {k: spark.conf.get(k, None) for k in conf}
    monkeypatch.setattr(modality, "HOT_GUID_ROWS", 1000)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30_000
        m = spark.range(n).select(
            F.col("id").alias("row_no"),
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .otherwise((F.col("id") % 5000).cast("string")).alias("guid"))
        t = (spark.range(5000).select(F.col("id").cast("string").alias("guid"),
                                      F.lit("cold text").alias("text"))
             .union(spark.createDataFrame([("hot", "hot text")], "guid string, text string")))
        j = attach_text(m, t)
        rows = j.collect()
        assert len(rows) == n and len({r.row_no for r in rows}) == n
        assert all(r.has_text for r in rows)
        assert sorted({(r.guid == "hot", r.text) for r in rows}) == [(False, "cold text"),
                                                                    (True, "hot text")]
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan and "SortMergeJoin(skew=true)" not in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_lookup_join_on_a_stream_skips_the_hot_key_pass(spark, tmpdir_path):
    from twinlens.operators.modality import lookup_join
    old = spark.conf.get("spark.sql.adaptive.skewJoin.enabled", None)
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        with open(f"{tmpdir_path}/a.csv", "w") as fh:
            fh.write("guid\n1\n2\n")
        m = spark.readStream.schema("guid string").option("header", True).csv(tmpdir_path)
        side = spark.createDataFrame([("1", "x")], "guid string, text string")
        j = lookup_join(m, side)                       # no collect on the stream
        assert j.isStreaming
    finally:
        if old is None:
            spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
        else:
            spark.conf.set("spark.sql.adaptive.skewJoin.enabled", old)


def test_hot_guid_is_split_with_both_modalities_and_in_the_audit(spark):
    from twinlens.operators.audit import audit_rows
    from twinlens.operators.modality import attach_modalities
    old = {k: spark.conf.get(k, None) for k in _CONF}
    try:
        for k, v in _CONF.items():
            spark.conf.set(k, v)
        n = 60_000
        m = spark.range(n).select(
            F.col("id").alias("row_no"),
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .otherwise((F.col("id") % 5000).cast("string")).alias("guid"))
        keys = spark.range(4000).select(F.col("id").cast("string").alias("guid")).union(
            spark.createDataFrame([("hot",)], "guid string"))
        # the sides are aggregates, as the file jobs' are
        t = keys.groupBy("guid").agg(F.first(F.lit("text")).alias("text"))
        i = keys.where("guid != '7'").groupBy("guid").agg(F.first(F.array(F.lit(0.5))).alias("img_feat"))
        for j in (attach_modalities(m, t, i, extra=("text",)), audit_rows(m, t, i, px_col=None)):
            rows = j.collect()
            assert len(rows) == n and len({r.row_no for r in rows}) == n
            assert "SortMergeJoin(skew=true)" in j._jdf.queryExecution().executedPlan().toString()
        both = attach_modalities(m, t, i, extra=("text",)).where("guid in ('7', 'hot', '4500')")
        assert {(r.guid, r.has_text, r.has_image) for r in both.collect()} == {
            ("7", True, False), ("hot", True, True), ("4500", False, False)}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
