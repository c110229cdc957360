"""Label dictionary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label domain, in class-index order.
LABELS = ["negative", "neutral", "positive"]
NUM_CLASSES = len(LABELS)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_label(c: Column | str, strict: bool = True) -> Column:
    """tag -> class index (INT). Unknown tags raise when ``strict``."""
    tag = _col(c)
    pairs = []
    for i, name in enumerate(LABELS):
        pairs += [F.lit(name), F.lit(i)]
    looked_up = F.element_at(F.create_map(*pairs), tag)
    if not strict:
        return looked_up
    return F.coalesce(
        looked_up,
        F.raise_error(F.concat(F.lit("unknown tag: "), F.coalesce(tag, F.lit("NULL")))).cast("int"),
    )


def decode_label(c: Column | str) -> Column:
    """class index -> tag."""
    return F.element_at(F.array(*[F.lit(x) for x in LABELS]), _col(c).cast("int") + 1)
