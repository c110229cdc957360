"""Incremental prediction of arriving manifests (M9 on a stream).

The reference has no streaming; this applies the batch prediction job to
manifest files as they land in a folder. Blob features are materialised once
(a static table); each micro-batch of manifest rows is joined to them
(stream-static left joins keep every row), scored with the broadcast head, and
appended to a parquet sink. The checkpoint makes the query restartable and the
sink exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinlens.functions.labels import decode_label
from twinlens.operators.fusion import Head, score
from twinlens.operators.modality import prepare_manifest
from twinlens.plans.jobs import FeatureSpec, attach_features, blob_features
from twinlens.session import materialize


def stream_predictions(spark: SparkSession, manifest_dir: str, data_dir: str, head: Head,
                       out_path: str, checkpoint_location: str,
                       spec: FeatureSpec | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the query; ``available_now`` processes what is there, then stops."""
    spec = spec or FeatureSpec()
    texts, imgs = blob_features(spark, data_dir, spec)
    texts = materialize(texts, "stream-text-features")
    imgs = materialize(imgs, "stream-image-features")
    raw = (spark.readStream.schema("guid string, tag string").option("header", True)
           .option("maxFilesPerTrigger", 100).csv(manifest_dir))
    m = prepare_manifest(raw.withColumn("row_no", F.lit(None).cast("bigint")), labelled=False)
    fe = attach_features(m, texts, imgs, spec)
    out = score(fe, head).select("guid", decode_label("pred").alias("tag"))
    w = out.writeStream.format("parquet").option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_path)


def read_predictions(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path)
