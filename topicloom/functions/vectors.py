"""Expressions on ``array<double>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_vector(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def squared_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalise(v: Column) -> Column:
    """Scale to unit length; an all-zero vector stays zero."""
    scaled = F.transform(
        F.arrays_zip(v.alias("x"), F.array_repeat(F.greatest(norm(v), F.lit(1e-12)), F.size(v)).alias("n")),
        lambda e: e["x"] / e["n"],
    )
    return scaled


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-12))


def xy(v: Column) -> list[Column]:
    """First two components as columns ``x`` and ``y``."""
    return [F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(1)).alias("y")]


def mean_pool(token_vectors: Column, mask: Column) -> Column:
    """Mean of the unmasked token vectors; the divisor is at least 1e-9.

    One running vector sum: the fold's state is the vector, each token adds its
    masked vector to it, so the plan holds no array per output dimension.
    """
    kept = F.aggregate(mask, F.lit(0.0), lambda acc, m: acc + m)
    zero = F.array_repeat(F.lit(0.0), F.size(F.get(token_vectors, F.lit(0))))
    rows = F.arrays_zip(token_vectors.alias("t"), mask.alias("m"))
    total = F.aggregate(rows, zero, lambda acc, e: F.zip_with(acc, e["t"], lambda a, x: a + x * e["m"]))
    return F.transform(total, lambda x: x / F.greatest(kept, F.lit(1e-9)))
