"""Arrow-batch UDFs that run once per row."""

from __future__ import annotations

from pyspark.sql import functions as F


def arrow_udf(return_type):
    """``pandas_udf`` decorator whose Python work runs once per row.

    Catalyst treats a deterministic UDF like any expression: it copies the call
    into filters it pushes down (``pred != label`` over an argmax of the UDF)
    or infers (``size(x) > 0`` below an explode), and each copy is a separate
    Python evaluation, sometimes on the wrong side of an exchange. Marking the
    UDF nondeterministic keeps it where it is written. Filters that should reach
    the scan are applied before the UDF.
    """
    def deco(fn):
        return F.pandas_udf(fn, return_type).asNondeterministic()
    return deco
