"""Guid repair (B1, G5) as one native Column expression.

Semantics: ``str(int(float(x)))`` when ``x`` parses as a Python float,
otherwise the raw text; a missing guid becomes ``'nan'``. Integers above
2**53 keep the precision loss of the float step, exactly as Python prints it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinlens.functions.text import strip_ws

# Python float() syntax: digits with single underscores between digits,
# optional fraction and exponent, optional sign. nan/inf are not integers.
_DIGITS = "[0-9](?:_?[0-9])*"
FLOAT_RE = (f"^[+-]?(?:{_DIGITS}(?:[.](?:{_DIGITS})?)?|[.]{_DIGITS})"
            f"(?:[eE][+-]?{_DIGITS})?$")

_BIGINT_SAFE = 9.2e18   # below this a double -> bigint cast is exact
_LIMB = 10**9           # digits of larger integers are kept nine at a time
_SHIFT = 29             # bits multiplied in at once: limb * 2**29 fits a bigint


def _exact_big_integer(x: Column) -> Column:
    """Exact decimal digits of an integral double of 2**63 or more.

    The double is m * 2**e with m < 2**55; m is split into limbs (least first)
    and multiplied by 2**e in steps, so no digit is lost.
    """
    def times(limbs: Column, factor: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("carry"))

        def step(acc: Column, limb: Column) -> Column:
            v = limb * factor + acc["carry"]
            return F.struct(F.concat(acc["out"], F.array(v % _LIMB)).alias("out"),
                            F.call_function("div", v, F.lit(_LIMB)).alias("carry"))

        return F.aggregate(limbs, start, step, lambda acc: F.when(
            acc["carry"] > 0, F.concat(acc["out"], F.array(acc["carry"]))).otherwise(acc["out"]))

    e = F.floor(F.log2(x)).cast("int") - F.lit(53)
    m = (x / F.pow(F.lit(2.0), e)).cast("bigint")
    first = F.array(m % _LIMB, F.call_function("div", m, F.lit(_LIMB)))
    steps = F.sequence(F.lit(0), F.floor((e - 1) / _SHIFT).cast("int"))
    limbs = F.aggregate(steps, first, lambda acc, i: times(
        acc, F.pow(F.lit(2.0), F.least(F.lit(_SHIFT), e - i * _SHIFT)).cast("bigint")))
    return F.concat_ws("", F.transform(F.reverse(limbs), lambda v, i: F.when(i == 0, v.cast("string")).otherwise(
        F.lpad(v.cast("string"), 9, "0"))))


def normalize_guid(c: Column | str) -> Column:
    raw = F.col(c) if isinstance(c, str) else c
    t = strip_ws(raw)
    num = F.regexp_replace(t, "_", "").try_cast("double")
    as_int = (
        F.when(F.abs(num) < F.lit(_BIGINT_SAFE), num.cast("bigint").cast("string"))
        .when(F.abs(num) < F.lit(float("inf")),
              F.when(num < 0, F.concat(F.lit("-"), _exact_big_integer(-num)))
              .otherwise(_exact_big_integer(num)))
    )
    return (
        F.when(raw.isNull() | (raw == ""), F.lit("nan"))
        .when(t.rlike(FLOAT_RE), F.coalesce(as_int, raw))
        .otherwise(raw)
    )
