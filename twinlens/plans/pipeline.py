"""End-to-end jobs over the fixture views: split, fuse, fit, score, ablate.

``labelled_features`` is the minimum slice of the build plan: manifest repair,
modality joins with defaults, seeded split, text features, fusion and
materialisation. Every report below reads its output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinlens.operators.evaluate import ablation_report, bad_cases
from twinlens.operators.fusion import (Head, default_blocks, fit_centroid_head, fuse_features,
                                       score, score_modes)
from twinlens.operators.modality import attach_modalities, attach_text, prepare_manifest
from twinlens.operators.split import split_manifest
from twinlens.operators.text_prep import text_features
from twinlens.session import materialize
from twinlens.sources.blobs import manifest_keys
from twinlens.plans.fixtures import (IMG_DIM, TXT_DIM, fx_image_vec, fx_manifest,
                                     fx_test_manifest, fx_text)


def split_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised, label-encoded manifest with its seeded 80/20 split."""
    return split_manifest(prepare_manifest(fx_manifest(spark, sf_dir)), 0.2, 42)


def manifest_texts(spark: SparkSession, sf_dir: str, m: DataFrame) -> DataFrame:
    """The text table cut to the manifest's guids when they fit the broadcast bound."""
    t = fx_text(spark, sf_dir)
    keys = manifest_keys(m)
    return t if keys is None else t.join(keys, "guid", "left_semi")


def attach_features(spark: SparkSession, sf_dir: str, m: DataFrame) -> DataFrame:
    """Manifest ⟕ (text features ⟗ image vectors), then fusion.

    Texts are encoded where they are read (only the manifest's, see
    ``manifest_texts``), so the join carries 32-dim vectors, never whole texts.
    """
    t = text_features(manifest_texts(spark, sf_dir, m), "text", TXT_DIM, hashing="md5")
    j = attach_modalities(m, t, fx_image_vec(spark, sf_dir), extra=("txt_feat",))
    return fuse_features(j, "img_feat", "txt_feat", IMG_DIM, TXT_DIM)


def labelled_features(spark: SparkSession, sf_dir: str, persist: bool = True) -> DataFrame:
    fe = attach_features(spark, sf_dir, split_fixture(spark, sf_dir))
    fe = fe.select("row_no", "guid", "tag", "label", "split", "has_text", "has_image", "features")
    return materialize(fe, "labelled-features") if persist else fe


@dataclass
class Fitted:
    features: DataFrame
    head: Head

    @property
    def train(self) -> DataFrame:
        return self.features.where(F.col("split") == "train")

    @property
    def val(self) -> DataFrame:
        return self.features.where(F.col("split") == "val")


def fit_fixture(spark: SparkSession, sf_dir: str) -> Fitted:
    fe = labelled_features(spark, sf_dir)
    head = fit_centroid_head(fe.where(F.col("split") == "train"), default_blocks(IMG_DIM, TXT_DIM),
                             "features", "label")
    return Fitted(fe, head)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ablation report: accuracy per modality mode on the validation split."""
    fit = fit_fixture(spark, sf_dir)
    return ablation_report(score_modes(fit.val, fit.head, "features"), "preds", "label")


def scored_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = fit_fixture(spark, sf_dir)
    return score(fit.val, fit.head, "features")


def misclassified(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bad cases of the validation split (B9, M11) with their text.

    The text is fetched for the misclassified rows only.
    """
    s = scored_val(spark, sf_dir)
    wrong = s.where(F.col("pred") != F.col("label")).select("row_no", "guid", "label", "pred")
    wrong = materialize(wrong, "misclassified")
    return bad_cases(attach_text(wrong, manifest_texts(spark, sf_dir, wrong)), keep=keep)


def predict_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch prediction of the unlabelled manifest (M9): ``(row_no, guid, tag)``."""
    from twinlens.functions.labels import decode_label
    fit = fit_fixture(spark, sf_dir)
    m = prepare_manifest(fx_test_manifest(spark, sf_dir), labelled=False)
    fe = attach_features(spark, sf_dir, m)
    return (score(fe, fit.head, "features")
            .select("row_no", "guid", decode_label("pred").alias("tag")))
