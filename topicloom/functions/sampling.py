"""Reproducible random order: rows are ordered by a hash of (seed, key)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_key(seed: int | str, *keys: Column) -> Column:
    """Hex digest that orders rows at random, the same way on every run and cluster."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def sampled(seed: int | str, fraction: float, *keys: Column) -> Column:
    """True for about ``fraction`` of the rows: the first 8 hex digits as a share of 2**32."""
    digits = F.conv(F.substring(shuffle_key(seed, *keys), 1, 8), 16, 10).cast("double")
    return digits < fraction * float(2**32)
