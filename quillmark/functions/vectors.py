"""Vector and distribution functions as column expressions over arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is 0."""
    n = norm(a) * norm(b)
    return F.when(n == 0, 0.0).otherwise(dot(a, b) / F.when(n != 0, n))


def kl_bits(p: Column, q: Column) -> Column:
    """Kullback-Leibler divergence in bits; a zero of q counts as 0.0001."""
    term = lambda x, y: F.when(x > 0, x * F.log2(x / F.when(y == 0, 0.0001).otherwise(y))).otherwise(0.0)
    return _sum(F.zip_with(p, q, term))


def js_bits(p: Column, q: Column) -> Column:
    m = F.zip_with(p, q, lambda x, y: (x + y) / 2)
    return 0.5 * kl_bits(p, m) + 0.5 * kl_bits(q, m)


def js_similarity(p: Column, q: Column) -> Column:
    return F.greatest(1 - js_bits(p, q), F.lit(0.0))


def normalised(a: Column) -> Column:
    return F.transform(a, lambda x: x / _sum(a))


def is_distribution(a: Column) -> Column:
    return F.abs(_sum(a) - 1) < 1e-4
