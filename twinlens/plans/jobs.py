"""File-based jobs: the reference's scripts as Spark jobs.

Inputs are a CSV manifest (``guid,tag`` or ``guid``) and a folder of
``{guid}.txt`` (GB18030) and ``{guid}.jpg`` files. Each job reads lazily,
joins blobs to the manifest once, computes features once, and writes tables:

* ``train_job``      split (A5) -> features (M6) -> head (M3/M7/M8) -> save (A9)
* ``predict_job``    manifest (A1) -> features -> score (A10, M2) -> CSV (A7), distribution (D4)
* ``ablation_job``   validation split (A6) -> one pass over three modes (M10)
* ``bad_case_job``   misclassified validation rows (M11) -> CSV (A8), count, first five
* ``audit_job``      corpus audit (M12) over every manifest row
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinlens.functions.labels import decode_label
from twinlens.functions.text import is_blank, preview
from twinlens.operators import evaluate as ev
from twinlens.operators.audit import audit_rows, audit_summary
from twinlens.operators.fusion import Block, fuse_features, score, score_modes
from twinlens.operators.image_prep import SIZE, all_black, black_image_feature, grid_encoder, image_features
from twinlens.operators.image_steps import Transform, flat_features, standard
from twinlens.operators.modality import attach_modalities, attach_text, prepare_manifest
from twinlens.operators.split import split_manifest, split_order_key
from twinlens.operators.text_prep import text_features, text_features_with
from twinlens.operators.training import fit_fusion_head, history_frame, mark_improvements
from twinlens.sources.blobs import (first_per_guid, manifest_keys, read_image_blobs,
                                    read_text_blobs)
from twinlens.sources.manifest import (read_manifest, read_split, write_bad_cases,
                                       write_predictions, write_split)
from twinlens.sources.model_io import load_head, save_head
from twinlens.session import lifetime, materialize, settled


@dataclass
class FeatureSpec:
    """Encoders and sizes; the defaults are the built-in encoders."""
    txt_dim: int = 32
    img_dim: int = 72
    image_size: int = SIZE
    encoding: str = "gb18030"
    image_encoder: object = grid_encoder
    text_encoder: object = None   # factory of list[str] -> array[n, txt_dim]; None: hashed bag of words
    transform: Transform | None = None   # image steps; None: the standard chain at image_size

    def blocks(self) -> list[Block]:
        return [Block("img", 0, self.img_dim), Block("txt", self.img_dim, self.img_dim + self.txt_dim)]

    def chain(self) -> Transform:
        """The image transform."""
        return self.transform or standard(self.image_size)

    def black_feature(self) -> np.ndarray:
        """Image feature of the default black image (missing/undecodable)."""
        return black_image_feature(self.image_encoder(), transform=self.chain())

    def encode_texts(self, texts: DataFrame) -> DataFrame:
        """Adds ``txt_feat`` by the text encoder."""
        if self.text_encoder is None:
            return text_features(texts, "text", self.txt_dim)
        return text_features_with(texts, self.text_encoder, self.txt_dim)

    def empty_text_feature(self) -> np.ndarray:
        """Text feature of the empty text: missing texts and the image-only mode."""
        if self.text_encoder is None:
            return np.zeros(self.txt_dim)
        return flat_features(self.text_encoder()([""]), 1, self.txt_dim)[0]

    def masked_image_feature(self) -> np.ndarray:
        """Image feature of an all-zero tensor after normalisation (text-only mode)."""
        return flat_features(self.image_encoder()(np.zeros_like(self.chain().black())), 1, self.img_dim)[0]


def blob_features(spark: SparkSession, data_dir: str, spec: FeatureSpec | None = None,
                  train: bool = False, epoch: int = 1, seed: int = 42,
                  guids: DataFrame | None = None):
    """Per-guid text and image features, encoded where the blobs are read.

    Returns ``(texts, images)``: ``(guid, txt_feat)`` and
    ``(guid, image_ok, img_feat)``, one row per guid. Encoding happens before
    deduplication, so the shuffles carry vectors, not texts, rasters or raw
    bytes (reports that print text fetch it for their own rows).
    ``guids`` (``manifest_keys``) restricts the work to the manifest's blobs.
    """
    spec = spec or FeatureSpec()
    texts = spec.encode_texts(read_text_blobs(spark, data_dir, spec.encoding, dedupe=False, guids=guids))
    texts = first_per_guid(texts.select("guid", "path", "txt_feat"), "path")
    imgs = image_features(read_image_blobs(spark, data_dir, dedupe=False, guids=guids),
                          "image", "guid", spec.image_encoder, spec.img_dim, train, epoch, seed,
                          transform=spec.chain())
    imgs = first_per_guid(imgs.select("guid", "origin", "image_ok", "img_feat"), "origin")
    return texts, imgs


def attach_features(manifest: DataFrame, texts: DataFrame, imgs: DataFrame,
                    spec: FeatureSpec | None = None) -> DataFrame:
    """Manifest ⟕ (text features ⟗ image features) -> ``features`` (image block first).

    Missing text gets the encoding of ``''``; a missing or undecodable image gets the encoder's output for the black image: one
    constant, never a per-row default raster.
    """
    spec = spec or FeatureSpec()
    j = attach_modalities(manifest, texts, imgs, extra=("txt_feat",), ok_col="image_ok")
    black = F.array(*[F.lit(float(v)) for v in spec.black_feature()])
    empty = F.array(*[F.lit(float(v)) for v in spec.empty_text_feature()])
    return fuse_features(j, "img_feat", "txt_feat", spec.img_dim, spec.txt_dim, img_missing=black, txt_missing=empty)


def build_features(spark: SparkSession, manifest: DataFrame, data_dir: str,
                   spec: FeatureSpec | None = None, train: bool = False, epoch: int = 1,
                   seed: int = 42) -> DataFrame:
    """Blob features for a manifest (see ``blob_features`` / ``attach_features``).

    Only the manifest's blobs are decoded and encoded when its guids fit the
    broadcast bound (a folder usually holds train and test blobs together).
    """
    texts, imgs = blob_features(spark, data_dir, spec, train, epoch, seed,
                                guids=manifest_keys(manifest))
    return attach_features(manifest, texts, imgs, spec)


def train_job(spark: SparkSession, train_file: str, data_dir: str, out_dir: str,
              spec: FeatureSpec | None = None, epochs: int = 5, lr: float = 2e-5,
              batch_size: int = 16, hidden: int = 512, seed: int = 42) -> DataFrame:
    """Split, train on features augmented anew each epoch, keep the best head; returns the history.

    Texts are encoded once. Training images are flipped and rotated by draws
    keyed on guid, epoch and seed; validation images are not (I6).
    """
    spec = spec or FeatureSpec()
    with lifetime(spark):
        m = prepare_manifest(read_manifest(spark, train_file))
        s = materialize(split_manifest(m, 0.2, seed), "split-manifest")
        write_split(s.select("row_no", "guid", "tag", "split"), f"{out_dir}/split")
        own, held = s.where(F.col("split") == "train"), s.where(F.col("split") == "val")
        texts = materialize(blob_features(spark, data_dir, spec, guids=manifest_keys(s))[0], "text-features")

        def features(rows: DataFrame, train: bool, epoch: int = 1) -> DataFrame:
            with lifetime(spark) as step:
                imgs = blob_features(spark, data_dir, spec, train, epoch, seed, guids=manifest_keys(rows))[1]
                fe = attach_features(rows, texts, imgs, spec)
                return step.keep(materialize(fe.select("row_no", "guid", "label", "features"), "train-features"))

        best, last, hist = fit_fusion_head(lambda epoch: features(own, True, epoch), features(held, False),
                                           spec.blocks(), hidden=hidden, epochs=epochs, lr=lr,
                                           batch_size=batch_size, seed=seed)
        if best is not None:  # only an epoch that improved leaves a head
            save_head(spark, best, f"{out_dir}/best_head")
    return mark_improvements(history_frame(spark, hist))


def predict_job(spark: SparkSession, test_file: str, data_dir: str, head_path: str,
                out_path: str, spec: FeatureSpec | None = None) -> DataFrame:
    """Predict an unlabelled manifest; writes ``guid,tag`` CSV in manifest order.

    Returns the class distribution (most frequent first).
    """
    head = load_head(spark, head_path)
    with lifetime(spark):
        m = prepare_manifest(read_manifest(spark, test_file, labelled=False), labelled=False)
        fe = build_features(spark, m, data_dir, spec)
        pred = score(fe, head).select("row_no", "guid", decode_label("pred").alias("tag"))
        pred = materialize(pred, "predictions")
        write_predictions(pred, out_path)
        return settled(ev.class_distribution(pred, "tag"))


def _val_features(spark, split_path, data_dir, spec):
    val = read_split(spark, split_path, "val")
    m = prepare_manifest(val.select("row_no", "guid", "tag"))
    return build_features(spark, m, data_dir, spec)


def ablation_job(spark: SparkSession, split_path: str, data_dir: str, head_path: str,
                 spec: FeatureSpec | None = None) -> DataFrame:
    """Accuracy for multimodal / text_only / image_only in one pass.

    text_only replaces the image block by the encoder output of a zero tensor;
    image_only replaces the text block by the encoding of the empty text.
    """
    spec = spec or FeatureSpec()
    head = load_head(spark, head_path)
    consts = {"img": spec.masked_image_feature()[None, :], "txt": spec.empty_text_feature()[None, :]}
    with lifetime(spark):
        fe = _val_features(spark, split_path, data_dir, spec)
        return settled(ev.ablation_report(score_modes(fe, head, consts=consts)))


def bad_case_job(spark: SparkSession, split_path: str, data_dir: str, head_path: str,
                 out_path: str, spec: FeatureSpec | None = None):
    """Misclassified validation rows -> CSV; returns (count, first five) frames.

    Features carry no text; the text is read for the misclassified rows only.
    """
    spec = spec or FeatureSpec()
    head = load_head(spark, head_path)
    with lifetime(spark):
        fe = _val_features(spark, split_path, data_dir, spec)
        wrong = materialize(score(fe, head).where(F.col("pred") != F.col("label"))
                            .select("row_no", "guid", "label", "pred"), "misclassified")
        texts = read_text_blobs(spark, data_dir, spec.encoding, guids=manifest_keys(wrong))
        bad = ev.bad_cases(attach_text(wrong, texts), keep=("row_no",))
        bad = bad.withColumn("order_key", split_order_key("guid"))
        bad = materialize(bad, "bad-cases")
        write_bad_cases(bad, out_path)
        first = ev.head_rows(bad, [F.col("order_key"), F.col("guid"), F.col("row_no")], 5)
        return settled(ev.bad_case_count(bad)), settled(first.drop("order_key"))


def audit_job(spark: SparkSession, manifest_file: str, data_dir: str, labelled: bool = False,
              spec: FeatureSpec | None = None, out_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Audit every manifest row: files present/readable, empty text, size, all black.

    Image flags are computed where the image is decoded; only flags are shuffled.
    Rows and summary; with ``out_path`` the rows are a table there, else they
    live as long as the caller's ``lifetime`` or the session.
    """
    with lifetime(spark) as own:
        rows = _audited(spark, manifest_file, data_dir, labelled, spec or FeatureSpec())
        if out_path is None:
            rows = own.keep(materialize(rows, "audit"))
        else:
            rows.write.mode("overwrite").parquet(out_path)
            rows = spark.read.parquet(out_path)
        return rows, settled(audit_summary(rows))


def _audited(spark: SparkSession, manifest_file: str, data_dir: str, labelled: bool, spec: FeatureSpec) -> DataFrame:
    m = prepare_manifest(read_manifest(spark, manifest_file, labelled=labelled), labelled=labelled)
    keys = manifest_keys(m)
    # reduce each text to its flags where it is read: dedupe and join shuffle no text
    raw_t = read_text_blobs(spark, data_dir, spec.encoding, dedupe=False, guids=keys)
    texts = first_per_guid(raw_t.select("guid", "path", "text_ok",
                                        is_blank("text").alias("text_empty"),
                                        preview("text").alias("text_preview")), "path")
    raw = read_image_blobs(spark, data_dir, dedupe=False, guids=keys)
    flags = raw.select("guid", "origin", "image_ok", F.col("image.width").alias("width"),
                       F.col("image.height").alias("height"),
                       all_black(F.col("image.data"), F.col("image.nChannels")).alias("image_black"))
    return audit_rows(m, texts, first_per_guid(flags, "origin"), px_col=None)
