"""Fuzzy neighbour graph: local distance scales and symmetric membership strengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS = 64


def _bandwidths(gaps: np.ndarray, target: float) -> np.ndarray:
    """Per row, sigma with sum(exp(-gap / sigma)) = target, by bisection."""
    lo, hi, mid = np.zeros(len(gaps)), np.full(len(gaps), np.inf), np.ones(len(gaps))
    for _ in range(STEPS):
        high = np.exp(-gaps / mid[:, None]).sum(1) > target
        hi, lo = np.where(high, mid, hi), np.where(high, lo, mid)
        mid = np.where(np.isinf(hi), mid * 2, (lo + hi) / 2)
    return mid


def local_scales(knn: DataFrame, n_neighbors: int) -> DataFrame:
    """(id, rho, sigma, dsts, dists): nearest positive distance and bandwidth per point.

    The neighbour list of a point has at most ``n_neighbors`` entries, so it is
    handled as one array and the bisection runs on whole Arrow batches.
    """
    near = knn.where((F.col("rank") <= n_neighbors) & (F.col("src") != F.col("dst")))
    listed = F.sort_array(F.collect_list(F.struct("rank", F.sqrt("dist").alias("d"), "dst")))
    rows = near.groupBy(F.col("src").alias("id")).agg(listed.alias("l")).select(
        "id", F.col("l.dst").alias("dsts"), F.col("l.d").alias("dists")
    )
    positive = F.filter("dists", lambda d: d > 0)
    rows = rows.withColumn("rho", F.coalesce(F.array_min(positive), F.lit(0.0)))
    rows = rows.withColumn(
        "gaps", F.transform("dists", lambda d: F.greatest(d - F.col("rho"), F.lit(0.0)))
    )
    target = float(np.log2(n_neighbors))

    @F.pandas_udf("double")
    def sigma(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for gaps in batches:
            if len(gaps) == 0:
                yield pd.Series([], dtype=float)
                continue
            lengths = gaps.str.len().to_numpy()
            padded = np.full((len(gaps), lengths.max()), np.inf)  # exp(-inf) = 0
            padded[np.arange(lengths.max()) < lengths[:, None]] = np.concatenate(gaps.to_numpy())
            yield pd.Series(_bandwidths(padded, target))

    return rows.select("id", "rho", sigma("gaps").alias("sigma"), "dsts", "dists")


def fuzzy_graph(knn: DataFrame, n_neighbors: int = 15) -> DataFrame:
    """(lo, hi, weight): a + b - a*b of the two directed strengths of each pair."""
    scales = local_scales(knn, n_neighbors)
    pair = F.explode(F.arrays_zip("dsts", "dists")).alias("p")
    directed = scales.select("id", "rho", "sigma", pair).select(
        F.col("id").alias("src"),
        F.col("p.dsts").alias("dst"),
        F.exp(-F.greatest(F.col("p.dists") - F.col("rho"), F.lit(0.0)) / F.col("sigma")).alias("v"),
    )
    both = F.when(F.count("*") == 2, F.min("v") * F.max("v")).otherwise(0.0)
    return directed.groupBy(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi")).agg(
        (F.sum("v") - both).alias("weight")
    )
