"""Similarity of word sets and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import as_col


def jaccard(left: Column | str, right: Column | str) -> Column:
    """Overlap of two arrays seen as sets; null if both are empty."""
    left, right = F.array_distinct(as_col(left)), F.array_distinct(as_col(right))
    shared = F.size(F.array_intersect(left, right))
    return F.try_divide(shared.cast("double"), (F.size(left) + F.size(right) - shared).cast("double"))


def cosine(left: Column | str, right: Column | str) -> Column:
    """Cosine of two vectors in double precision; null for a zero vector or unequal lengths."""
    left, right = as_col(left), as_col(right)

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(F.size(left) == F.size(right), F.try_divide(dot(left, right), norms))
