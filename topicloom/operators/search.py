"""Random search over clustering parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions.sampling import sampled, shuffle_key
from topicloom.operators.density import cluster_labels, clustering_metrics
from topicloom.operators.dendrogram import merge_tree
from topicloom.operators.neighbours import knn_exact
from topicloom.operators.spanning import spanning_tree
from topicloom.workspace import keep

PARAMETERS = ("min_samples", "min_cluster_size", "cluster_selection_epsilon")


def parameter_grid(spark: SparkSession, params: dict[str, list]) -> DataFrame:
    """All combinations of the value lists (each list is exploded once)."""
    grid = spark.range(1)
    for name, values in params.items():
        grid = grid.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return grid.drop("id")


def random_parameters(grid: DataFrame, n: int, seed: int = 123) -> DataFrame:
    """``n`` different rows of the grid in hash order; more than it has is an error."""
    total = grid.count()
    if n > total:
        raise ValueError(f"cannot take {n} of {total} parameter combinations")
    key = shuffle_key(seed, *[F.col(c) for c in grid.columns])
    return grid.orderBy(key, *grid.columns).limit(n)


def sample_rows(rows: DataFrame, fraction: float, seed: int = 123, id_col: str = "id") -> DataFrame:
    """A reproducible fraction of the rows; all of them from 1.0 up."""
    return rows if fraction >= 1 else rows.where(sampled(seed, fraction, F.col(id_col)))


def parameter_search(
    points: DataFrame,
    params: dict[str, list],
    n: int,
    random_seed: int = 123,
    sample_frac: float = 1.0,
    id_col: str = "id",
    vector_col: str = "vec",
) -> DataFrame:
    """One row per sampled combination: validity, topic_count, coverage and parameters.

    Neighbours are computed once for the largest ``min_samples``; trials that share
    ``min_samples`` share the spanning tree and its merge tree.
    """
    spark = points.sparkSession
    trials = random_parameters(parameter_grid(spark, params), n, random_seed).collect()  # n rows
    rows = sample_rows(
        points.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec")),
        sample_frac,
        random_seed,
    )
    rows = keep(rows, "search-points")
    most = max(t["min_samples"] for t in trials)
    knn = keep(knn_exact(rows, rows, k=2 * most + 5, exclude_self=True), "search-knn")
    trees: dict[int, tuple] = {}
    results = []
    for trial in trials:
        samples = trial["min_samples"]
        if samples not in trees:
            tree = keep(spanning_tree(rows, samples, knn=knn), "search-tree")
            trees[samples] = (tree, merge_tree(tree))
        tree, merges = trees[samples]
        labels = cluster_labels(
            merges, trial["min_cluster_size"], trial["cluster_selection_epsilon"]
        )
        metrics = clustering_metrics(keep(labels, "search-labels"), tree)
        results.append(metrics.select("*", *[F.lit(trial[p]).alias(p) for p in PARAMETERS]))
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out
