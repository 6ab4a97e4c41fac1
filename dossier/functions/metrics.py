"""Aggregate expressions and vector similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: smallest norm product in the cosine denominator.
COSINE_FLOOR = 1e-8


def mse(a: Column, b: Column) -> Column:
    """Mean squared error."""
    return F.avg(F.pow(a - b, F.lit(2.0)))


def mae(a: Column, b: Column) -> Column:
    """Mean absolute error."""
    return F.avg(F.abs(a - b))


def pearson(a: Column, b: Column) -> Column:
    """Linear correlation; null for constant input or a single row.

    The built-in ``corr`` divides by zero there, which ANSI mode turns into an error.
    """
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two equally long vectors, in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; tiny norms are held at the floor."""
    return dot(a, b) / F.greatest(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(COSINE_FLOOR))
