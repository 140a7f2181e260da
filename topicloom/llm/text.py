"""Helpers shared by the training-data operators: words, folds, bound lambdas, input columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space is exactly these characters, in Java, in RE2 and for Python's bytes.split().
SPACE = r"\x20\x09-\x0D"
SPACES = f"[{SPACE}]+"


def words_of(text: Column) -> Column:
    """Array of the maximal runs of non-space characters; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also when a lambda inside uses it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; null keys fall in fold -1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(-1))


def inputs(df: DataFrame, **columns: str) -> DataFrame:
    """The needed columns under internal names (``_name=column``), other columns left out.

    Extra columns of the caller's table, whatever their names, can then not clash.
    """
    return df.select(*[F.col(f"`{column}`").alias(name) for name, column in columns.items()])
