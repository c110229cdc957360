"""Manifest and result files.

A manifest is ``(row_no BIGINT, guid STRING[, tag STRING])``. ``row_no`` is an
order-preserving unique key assigned at the scan, so every later sink can put
rows back in manifest order with a distributed sort instead of a driver list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinlens.session import materialize

# Strings pandas' CSV reader treats as missing by default.
NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
              "n/a", "nan", "null"]


def _na_to_null(c: str):
    col = F.col(c)
    return F.when(col.isin(NA_STRINGS), F.lit(None).cast("string")).otherwise(col)


def _numbered(raw: DataFrame, cols: list[str]) -> DataFrame:
    """``cols`` of a file scan with ``row_no``, 0 to n - 1 in the order of file path, block and line.

    Scans pack files into tasks by size, so a task's number says nothing about
    file order. Rows are written out with their file, block and position; one
    row per block then gives the block's first number.
    """
    at = raw.select(*cols, F.col("_metadata.file_path").alias("_file"),
                    F.col("_metadata.file_block_start").alias("_block"))
    at = materialize(at.withColumn("_at", F.monotonically_increasing_id()), "manifest")
    blocks = at.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return at.join(blocks, ["_file", "_block"]).select(
        (F.col("_base") + F.col("_at") - F.col("_first")).alias("row_no"), *cols)


def read_manifest(spark: SparkSession, path: str, labelled: bool = True,
                  header: bool = True, mode: str = "PERMISSIVE",
                  multi_line: bool = False, corrupt: bool = False) -> DataFrame:
    """CSV manifest with an explicit string schema (A1).

    ``mode='PERMISSIVE'`` keeps malformed lines with NULL fields; ``corrupt``
    adds ``_corrupt``, the raw text of such lines (A2). ``header=False`` reads a
    headerless file as ``guid[, tag]``. Columns beyond ``guid``/``tag`` are
    ignored. Large files are split across tasks; ``multi_line=True`` accepts
    quoted newlines inside fields, at the price of one task per file.
    """
    cols = ["guid", "tag"] if labelled else ["guid"]
    reader = (spark.read.option("header", header).option("mode", mode)
              .option("multiLine", multi_line).option("escape", '"'))
    names = cols
    if header:
        # by header name, whatever else the file holds
        names = reader.option("inferSchema", False).csv(path).columns
        missing = [c for c in cols if c not in names]
        if missing:
            raise ValueError(f"manifest {path} lacks column(s) {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_corrupt"]])
    raw = reader.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    kept = [*cols, "_corrupt"] if corrupt else cols
    df = _numbered(raw, kept)
    return df.select("row_no", *[_na_to_null(c).alias(c) for c in cols], *kept[len(cols):])


def write_split(df: DataFrame, path: str) -> None:
    """Persist a split manifest partitioned by ``split`` (A5)."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Re-read one split; the filter prunes to one partition folder."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def write_predictions(df: DataFrame, path: str) -> None:
    """``guid,tag`` CSV in manifest order.

    ``orderBy`` range-partitions on ``row_no``: part files are written in
    order, each sorted, with no single-partition step.
    """
    (df.orderBy("row_no").select("guid", "tag")
       .write.mode("overwrite").option("header", True).csv(path))


def write_bad_cases(df: DataFrame, path: str) -> None:
    """``guid,text,true_label,pred_label`` CSV; texts may hold quotes/newlines."""
    out = df.orderBy("order_key") if "order_key" in df.columns else df
    (out.select("guid", "text", "true_label", "pred_label")
        .write.mode("overwrite").option("header", True).option("quoteAll", True)
        .option("escape", '"').csv(path))


def read_bad_cases(spark: SparkSession, path: str) -> DataFrame:
    """The file of ``write_bad_cases``; an empty text stays one (the CSV reader would make it NULL)."""
    raw = (spark.read.option("header", True).option("multiLine", True)
           .option("escape", '"')
           .schema("guid string, text string, true_label string, pred_label string")
           .csv(path))
    return raw.withColumn("text", F.coalesce("text", F.lit("")))
