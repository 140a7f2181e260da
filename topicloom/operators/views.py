"""Two-dimensional views: crop box, density grid, cluster view table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.vectors import xy


def crop(rows: DataFrame, box: Sequence[float] = (-20, 20, -20, 20), vector_col: str = "umap") -> DataFrame:
    """Rows strictly inside the box (x_min, x_max, y_min, y_max), with ``x`` and ``y`` added."""
    if len(box) != 4:
        raise ValueError("a crop box needs four coordinates")
    placed = rows.select("*", *xy(F.col(vector_col)))
    x, y = F.col("x"), F.col("y")
    return placed.where((x > box[0]) & (x < box[1]) & (y > box[2]) & (y < box[3]))


def density_grid(rows: DataFrame, vector_col: str = "umap", cell: float = 1.0, limit: float = 20.0) -> DataFrame:
    """(gx, gy, cnt): points per grid cell within ``limit``; vectors must have two dimensions."""
    size = F.size(vector_col)
    message = F.lit("only two-dimensional vectors can be shown")
    flat = F.when(size <= 2, F.col(vector_col)).otherwise(
        F.raise_error(message).cast("array<double>")
    )
    placed = rows.select(flat.alias("v")).select(*xy(F.col("v")))
    inside = F.col("x").between(-limit, limit) & F.col("y").between(-limit, limit)
    return placed.where(inside).groupBy(
        F.floor(F.col("x") / cell).alias("gx"), F.floor(F.col("y") / cell).alias("gy")
    ).agg(F.count("*").alias("cnt"))


def cluster_view(docs: DataFrame, info: DataFrame, topic_col: str = "topics") -> DataFrame:
    """Documents with the columns of their topic's row (null where it has none)."""
    return docs.join(info, docs[topic_col] == info["Topic"], "left")
