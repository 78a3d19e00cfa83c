"""Column expressions on vectors stored as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparquill.functions.text import once


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def normalize(v: Column) -> Column:
    """Vector of length 1; a zero vector stays as it is."""
    return once(norm(v), lambda n: F.transform(v, lambda x: F.coalesce(F.try_divide(x.cast("double"), n), x.cast("double"))))


def minkowski(a: Column, b: Column, p: float = 3.0) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: F.pow(F.abs(x.cast("double") - y.cast("double")), F.lit(float(p))))
    return F.pow(_sum(gaps), F.lit(1.0 / p))


def distance(a: Column, b: Column, metric: str = "euclidean", p: float = 3.0) -> Column:
    """Distance by metric; the inner product is returned as it is (larger is nearer)."""
    if metric == "euclidean":
        return minkowski(a, b, 2.0)
    if metric == "minkowski":
        return minkowski(a, b, p)
    if metric == "dot_product":
        return dot(a, b)
    if metric == "cosine":
        return 1 - F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
    raise ValueError(f"unknown metric {metric!r}")
