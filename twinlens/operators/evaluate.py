"""Evaluation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinlens.functions.labels import decode_label
from twinlens.operators.fusion import MODES


def pct(correct: Column, total: Column, decimals: int = 2) -> Column:
    """``100 * correct / total``; NULL for an empty input."""
    return F.round(F.lit(100.0) * F.try_divide(correct.cast("double"), total.cast("double")),
                   decimals)


def accuracy(df: DataFrame, pred_col: str = "pred", label_col: str = "label",
             by: tuple[str, ...] = ()) -> DataFrame:
    """``(total, correct, accuracy)`` overall or per group.

    Partial aggregation per task, final on the group key (or one row).
    """
    hit = F.when(F.col(pred_col) == F.col(label_col), 1).otherwise(0)
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"),
                              F.sum(hit).cast("bigint").alias("correct"))
    return agg.withColumn("accuracy", pct(F.col("correct"), F.col("total")))


def ablation_report(df: DataFrame, preds_col: str = "preds", label_col: str = "label",
                    modes: tuple[str, ...] = MODES) -> DataFrame:
    """Accuracy per modality mode from one pass over the rows.

    All modes are counted by a single global aggregate (one row per task goes
    to the final step); the one result row is then unpivoted to one per mode.
    """
    sums = [F.sum(F.when(F.col(preds_col)[i] == F.col(label_col), 1).otherwise(0))
            .cast("bigint").alias(f"_c{i}") for i in range(len(modes))]
    agg = df.agg(F.count(F.lit(1)).alias("total"), *sums)
    rows = F.array(*[F.struct(F.lit(m).alias("mode"), F.col("total").alias("total"),
                              F.col(f"_c{i}").alias("correct")) for i, m in enumerate(modes)])
    out = agg.select(F.inline(rows))
    return out.withColumn("acc", pct(F.col("correct"), F.col("total")))


def bad_cases(df: DataFrame, pred_col: str = "pred", label_col: str = "label",
              guid_col: str = "guid", text_col: str = "text",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Misclassified rows as ``(guid, text, true_label, pred_label)``.

    Prediction and truth sit on the same row, so no join pairs them.
    """
    return (df.where(F.col(pred_col) != F.col(label_col))
            .select(F.col(guid_col).alias("guid"), F.col(text_col).alias("text"),
                    decode_label(label_col).alias("true_label"),
                    decode_label(pred_col).alias("pred_label"), *keep))


def bad_case_count(df: DataFrame) -> DataFrame:
    """Number of misclassified rows."""
    return df.agg(F.count(F.lit(1)).alias("n_bad"))


def head_rows(df: DataFrame, order: list[Column | str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order: a top-k, not a global sort."""
    return df.orderBy(*order).limit(n)


def class_distribution(df: DataFrame, tag_col: str = "tag") -> DataFrame:
    """Rows per predicted tag, most frequent first."""
    return (df.groupBy(F.col(tag_col).alias("tag")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("tag")))
