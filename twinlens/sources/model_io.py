"""Head parameters as a table.

One row per layer matrix row: ``(layer, part, row, values ARRAY<DOUBLE>)``
with ``part`` in {W, b, block:<name>}, plus the block layout. Written with
``mode('overwrite')``; loading collects the rows (bounded by the head size).
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from twinlens.operators.fusion import Block, Head

_SCHEMA = "layer int, part string, row int, values array<double>"


def save_head(spark: SparkSession, head: Head, path: str) -> None:
    rows = []
    for li, (w, b) in enumerate(head.layers):
        rows += [(li, "W", r, w[r].astype(float).tolist()) for r in range(w.shape[0])]
        rows.append((li, "b", 0, b.astype(float).tolist()))
    for name, bb in head.block_bias.items():
        rows.append((0, f"block:{name}", 0, bb.astype(float).tolist()))
    meta = json.dumps({"kind": head.kind, "blocks": [[b.name, b.start, b.stop] for b in head.blocks]})
    rows.append((-1, "meta:" + meta, 0, []))
    spark.createDataFrame(rows, _SCHEMA).write.mode("overwrite").parquet(path)


def load_head(spark: SparkSession, path: str) -> Head:
    rows = spark.read.parquet(path).orderBy("layer", "part", "row").collect()
    meta = next(r for r in rows if r["part"].startswith("meta:"))
    info = json.loads(meta["part"][len("meta:"):])
    n_layers = max(r["layer"] for r in rows) + 1
    layers = []
    for li in range(n_layers):
        w = np.asarray([r["values"] for r in rows if r["layer"] == li and r["part"] == "W"])
        b = np.asarray(next(r["values"] for r in rows if r["layer"] == li and r["part"] == "b"))
        layers.append((w, b))
    bb = {r["part"][len("block:"):]: np.asarray(r["values"]) for r in rows
          if r["part"].startswith("block:")}
    blocks = [Block(n, s, e) for n, s, e in info["blocks"]]
    return Head(layers=layers, blocks=blocks, block_bias=bb, kind=info["kind"])


def head_table(spark: SparkSession, path: str):
    """The stored parameters as a DataFrame (for inspection / SQL)."""
    return spark.read.parquet(path).where(F.col("layer") >= 0)
