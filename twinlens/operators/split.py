"""Seeded exact-count train/validation split.

Validation = the first ``ceil(fraction * n)`` rows ordered by
``(md5(guid || '|seed'), guid, row_no)``; train is the complement.

A global ``row_number()`` would plan an ``Exchange SinglePartition``. Instead
the k-th key is found by radix refinement: histograms over 16-bit digits of the
md5 prefix (each a partial + final aggregate of at most 65 536 groups) narrow
the boundary to one bucket, and only a bucket of bounded size is ranked. A hot
guid (many rows with one key) is refined further on ``row_no`` digits, so no
step ever ranks an unbounded group. The split itself is then a per-row
comparison against the boundary key: no join, no shuffle of the manifest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest candidate set ranked in one task at the end of the refinement.
RANK_LIMIT = 200_000


def _key_cols(guid_col: str, seed: int) -> list[Column]:
    h = F.md5(F.concat(F.col(guid_col), F.lit(f"|{seed}")))
    prefix = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    return [h.alias("_h"), prefix.alias("_p")]


def _digits() -> list[list[Column]]:
    p = F.col("_p")
    # flip the sign bit so unsigned 16-bit digits follow signed order
    r = F.col("_row").bitwiseXOR(F.lit(-(1 << 63)))
    return [
        [F.shiftright(p, 16)],
        [F.col("_p").bitwiseAND(0xFFFF)],
        [F.col("_h"), F.col("_guid")],
        [F.shiftright(r, 48).bitwiseAND(0xFFFF)],
        [F.shiftright(r, 32).bitwiseAND(0xFFFF)],
        [F.shiftright(r, 16).bitwiseAND(0xFFFF)],
        [r.bitwiseAND(0xFFFF)],
    ]


def _histogram(keyed: DataFrame, cond: Column, level: list[Column]):
    names = [f"_d{i}" for i in range(len(level))]
    hist = (keyed.where(cond).groupBy(*[c.alias(n) for c, n in zip(level, names)])
            .count().collect())                      # <= 65 536 groups per level
    hist.sort(key=lambda r: tuple(r[n] for n in names))
    return names, hist


def _kth_key(keyed: DataFrame, fraction: float):
    """Exact k-th smallest ``(_h, _guid, _row)`` with ``k = ceil(fraction * n)``.

    Returns ``(n, k, key)``; ``key`` is None when k is 0 or n.
    """
    levels = _digits()
    names, hist = _histogram(keyed, F.lit(True), levels[0])
    n = sum(r["count"] for r in hist)
    # sklearn's contract: ceil(test_size * n_samples) in float arithmetic
    k = math.ceil(fraction * n)
    if k <= 0 or k >= n:
        return n, k, None
    cond, remaining = F.lit(True), k
    for i, level in enumerate(levels):
        if i > 0:
            names, hist = _histogram(keyed, cond, level)
        acc = 0
        for row in hist:
            if acc + row["count"] >= remaining:
                remaining -= acc
                cand_n = row["count"]
                for c, nm in zip(level, names):
                    cond = cond & (c == F.lit(row[nm]))
                break
            acc += row["count"]
        if cand_n <= RANK_LIMIT:
            break
    # bounded candidate set: rank it on the driver (string order = UTF-8 byte order)
    cand = keyed.where(cond).select("_h", "_guid", "_row").collect()
    cand.sort(key=lambda r: (r["_h"], r["_guid"], r["_row"]))
    hit = cand[remaining - 1]
    return n, k, (hit["_h"], hit["_guid"], hit["_row"])


def _le_key(h: Column, g: Column, r: Column, b) -> Column:
    bh, bg, br = F.lit(b[0]), F.lit(b[1]), F.lit(b[2])
    return (h < bh) | ((h == bh) & ((g < bg) | ((g == bg) & (r <= br))))


def split_manifest(df: DataFrame, val_fraction: float = 0.2, seed: int = 42,
                   guid_col: str = "guid", order_col: str = "row_no",
                   approx: bool = False) -> DataFrame:
    """Add ``split`` ('train' / 'val') to a manifest.

    ``approx=True`` keeps rows whose 32-bit md5 prefix falls under
    ``fraction * 2**32``: no extra job, about (not exactly) the fraction.
    """
    h = F.md5(F.concat(F.col(guid_col), F.lit(f"|{seed}")))
    if approx:
        prefix = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
        cut = int(val_fraction * (1 << 32))
        return df.withColumn("split", F.when(prefix < F.lit(cut), "val").otherwise("train"))

    keyed = df.select(*_key_cols(guid_col, seed), F.col(guid_col).alias("_guid"),
                      F.col(order_col).alias("_row"))
    n, k, bound = _kth_key(keyed, val_fraction)
    if k <= 0:
        return df.withColumn("split", F.lit("train"))
    if k >= n:
        return df.withColumn("split", F.lit("val"))
    is_val = _le_key(h, F.col(guid_col), F.col(order_col), bound)
    return df.withColumn("split", F.when(is_val, "val").otherwise("train"))


def split_order_key(guid_col: str = "guid", seed: int = 42) -> Column:
    """The split's row order (the order of the written split files)."""
    return F.md5(F.concat(F.col(guid_col), F.lit(f"|{seed}")))


def split_counts(df: DataFrame, by: tuple[str, ...] = ("split",)) -> DataFrame:
    """Row counts per split."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
