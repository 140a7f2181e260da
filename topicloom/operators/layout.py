"""Low-dimensional layout of a fuzzy graph.

Every epoch moves all points at once: neighbours attract by edge weight, and a few
points picked by hash repel.  Each epoch is two equi-joins on the point number and
one aggregation, and its result is written, so the lineage does not grow.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.workspace import drop_kept, global_index, keep


def curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """a, b of 1 / (1 + a x^(2b)) fitted to the target closeness curve (Gauss-Newton)."""
    x = np.linspace(0, spread * 3, 300)[1:]
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    a, b, damping = 1.0, 1.0, 1e-3

    def model(a, b):
        return 1.0 / (1.0 + a * x ** (2 * b))

    for _ in range(200):
        f = model(a, b)
        grad = np.stack([-f * f * x ** (2 * b), -f * f * a * x ** (2 * b) * 2 * np.log(x)], 1)
        step = np.linalg.solve(grad.T @ grad + damping * np.eye(2), grad.T @ (y - f))
        if ((y - model(a + step[0], b + step[1])) ** 2).sum() < ((y - f) ** 2).sum():
            a, b, damping = a + step[0], b + step[1], damping / 2
        else:
            damping *= 4
    return float(a), float(b)


def initial_layout(points: DataFrame, n_components: int) -> DataFrame:
    """(i, id, y0, y1, ...): principal components, scaled to at most 10."""
    vectors = points.select("id", array_to_vector("vec").alias("features"))
    model = PCA(k=n_components, inputCol="features", outputCol="pc").fit(vectors)
    parts = model.transform(vectors).select("id", vector_to_array("pc").alias("pc"))
    placed = keep(parts, "pca")
    widest = placed.agg(F.max(F.array_max(F.transform("pc", lambda v: F.abs(v))))).first()[0] or 1.0
    coordinates = [(F.get("pc", F.lit(c)) * (10.0 / widest)).alias(f"y{c}") for c in range(n_components)]
    numbered = global_index(placed, [F.col("id")], "i")
    return numbered.select("i", "id", *coordinates)


def layout(
    points: DataFrame,
    graph: DataFrame,
    n_components: int = 2,
    n_epochs: int = 50,
    min_dist: float = 0.0,
    negatives: int = 5,
    learning_rate: float = 1.0,
    id_col: str = "id",
    vector_col: str = "vec",
) -> DataFrame:
    """(id, umap): layout of the points of a fuzzy graph (lo, hi, weight)."""
    points = points.select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec")
    )
    a, b = curve(min_dist)
    dims = [f"y{c}" for c in range(n_components)]
    start = keep(initial_layout(points, n_components), "layout-start")
    n = start.count()
    ids = start.select("i", "id")

    lo, hi = (ids.select(F.col("i").alias(f"i_{e}"), F.col("id").alias(e)) for e in ("lo", "hi"))
    pair = F.explode(
        F.array(
            F.struct(F.col("i_lo").alias("s"), F.col("i_hi").alias("t")),
            F.struct(F.col("i_hi").alias("s"), F.col("i_lo").alias("t")),
        )
    ).alias("p")
    edges = keep(
        graph.join(lo, "lo").join(hi, "hi").select(pair, "weight").select("p.s", "p.t", "weight"),
        "layout-edges",
    )
    position = start.select("i", *dims)
    written = None
    for epoch in range(n_epochs):
        alpha = learning_rate * (1.0 - epoch / n_epochs)
        pick = F.explode(F.sequence(F.lit(0), F.lit(negatives - 1))).alias("m")
        repel = position.select(F.col("i").alias("s"), pick).select(
            "s",
            F.pmod(F.xxhash64("s", "m", F.lit(epoch)), F.lit(n)).alias("t"),
            F.lit(-1.0 / negatives).alias("weight"),  # negative marks repulsion
        )
        at = position.select(F.col("i").alias("t"), *[F.col(d).alias(f"t{d}") for d in dims])
        own = position.withColumnRenamed("i", "s")
        forces = edges.unionByName(repel.where(F.col("s") != F.col("t")))
        # Without the hint each epoch would broadcast the places of all points, by way of the driver.
        forces = forces.join(at.hint("merge"), "t").join(own.hint("merge"), "s")
        d2 = sum(((F.col(d) - F.col(f"t{d}")) ** 2 for d in dims), F.lit(0.0))
        forces = forces.withColumn("d2", d2)
        pull = F.when(
            F.col("d2") > 0,
            -2.0 * a * b * F.pow("d2", b - 1.0) / (1.0 + a * F.pow("d2", b)),
        ).otherwise(0.0)
        push = 2.0 * b / ((0.001 + F.col("d2")) * (1.0 + a * F.pow("d2", b)))
        attract = F.col("weight") > 0
        forces = forces.withColumn("g", F.when(attract, pull).otherwise(push))
        moves = forces.groupBy("s").agg(
            F.sum(F.when(attract, F.col("weight"))).alias("degree"),
            *[
                F.sum(
                    F.abs("weight")
                    * F.greatest(
                        F.lit(-4.0), F.least(F.lit(4.0), F.col("g") * (F.col(d) - F.col(f"t{d}")))
                    )
                ).alias(f"m{d}")
                for d in dims
            ],
        )
        scale = alpha / F.greatest(F.coalesce("degree", F.lit(1.0)), F.lit(1.0))
        following = keep(
            position.join(moves.withColumnRenamed("s", "i").hint("merge"), "i", "left").select(
                "i", *[(F.col(d) + F.coalesce(F.col(f"m{d}") * scale, F.lit(0.0))).alias(d) for d in dims]
            ),
            "layout",
        )
        drop_kept(written)
        position = written = following
    return ids.join(position, "i").select("id", F.array(*dims).alias("umap"))
