"""Vector expressions over ``array<float|double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def l2_norm(v) -> Column:
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def unit(acc: Column, sq: Column) -> Column:
    """``acc / sqrt(sq)`` elementwise, zero vector unchanged."""
    n = F.sqrt(sq)
    return F.transform(acc, lambda x: F.when(n > 0, x.cast("double") / n)
                       .otherwise(x.cast("double")))


def l2_normalize(v) -> Column:
    """Unit length; a zero vector stays zero.  Result is ``array<double>``.

    The squared norm is the accumulator of one ``aggregate`` and the division
    happens in its finish function, so the norm is computed once per row
    (expressions are not shared inside lambdas)."""
    v = _col(v)
    return F.aggregate(v, F.lit(0.0).cast("double"),
                       lambda s, x: s + x.cast("double") * x.cast("double"),
                       lambda s: unit(v, s))


def similarity_from_d2(d2) -> Column:
    """``1 - d2/2``: cosine similarity when both vectors have unit length."""
    return F.lit(1.0) - _col(d2) / F.lit(2.0)
