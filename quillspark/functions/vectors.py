"""Vectors as array columns: dot products, norms and unit vectors, summed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import col


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(a: str | Column) -> Column:
    """The vector over its length; a zero vector stays as it is."""
    n = norm(a)
    return F.transform(col(a), lambda x: F.when(n == 0, x.cast("double")).otherwise(x.cast("double") / n))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity, 0 if either vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b) / scale)


def is_finite(a: str | Column) -> Column:
    return F.forall(col(a), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


def top_mean(scores: str | Column, k: int) -> Column:
    """Mean of the k largest of an array of scores (of all if there are fewer; at least one)."""
    best = F.slice(F.sort_array(col(scores), asc=False), 1, max(1, k))
    return F.aggregate(best, F.lit(0.0), lambda s, x: s + x) / F.size(best)
