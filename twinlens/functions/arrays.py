"""Array math as native higher-order functions.

These run inside the JVM on ARRAY<DOUBLE> columns. Large matrix products
(the scoring head) use numpy in Arrow batches instead, see operators.fusion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(c: Column | str) -> Column:
    """Index of the largest element; the first one on ties."""
    a = _col(c)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def softmax(c: Column | str) -> Column:
    """Max-shifted softmax."""
    a = _col(c)
    m = F.array_max(a)
    ex = F.transform(a, lambda x: F.exp(x - m))
    s = F.aggregate(ex, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / s)


def log_sum_exp(c: Column | str) -> Column:
    a = _col(c)
    m = F.array_max(a)
    s = F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x - m))
    return F.log(s) + m


def cross_entropy(logits: Column | str, label: Column | str) -> Column:
    """-log softmax(z)[label]."""
    z = _col(logits)
    return log_sum_exp(z) - F.element_at(z, _col(label).cast("int") + 1)


def fuse(*cols: Column | str) -> Column:
    """Late fusion: concatenate blocks in the given order."""
    return F.concat(*[_col(c) for c in cols])


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("double"), n)


def zeros_like(c: Column | str) -> Column:
    """Mask a block."""
    return F.transform(_col(c), lambda x: F.lit(0.0).cast("double"))


def relu(c: Column | str) -> Column:
    """max(0, x) elementwise."""
    return F.transform(_col(c), lambda x: F.greatest(x, F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x)


def affine(c: Column | str, weight: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """``W x + b`` for a small constant matrix.

    Rows of ``W`` become literal arrays (constant-folded); use the Arrow
    scoring path for anything wider than a few dozen outputs.
    """
    x = _col(c)
    outs = []
    for row, b in zip(weight, bias):
        w = F.array(*[F.lit(float(v)) for v in row])
        outs.append(dot(x, w) + F.lit(float(b)))
    return F.array(*outs)
