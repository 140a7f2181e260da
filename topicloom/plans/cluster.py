"""Reduce vectors and cluster them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from topicloom.operators.dedupe import dedupe_map, undo_dedupe, unique_rows
from topicloom.operators.density import hdbscan
from topicloom.operators.fuzzy import fuzzy_graph
from topicloom.operators.layout import layout
from topicloom.operators.neighbours import knn_exact, knn_lists
from topicloom.operators.views import crop
from topicloom.workspace import keep


def reduce_vectors(
    docs: DataFrame,
    n_components: int = 2,
    n_neighbors: int = 15,
    min_dist: float = 0.0,
    n_epochs: int = 50,
    dedupe: bool = True,
    approximate: bool = False,
    knn: DataFrame | None = None,
    id_col: str = "id",
    vector_col: str = "embeddings",
    copies: DataFrame | None = None,
    save_knn: str | None = None,
    **list_options,
) -> DataFrame:
    """(id, umap): dedupe, neighbours (or a given table), fuzzy graph, layout, undo dedupe.

    ``copies`` is a saved (id, rep_id) map to use instead of computing one; ``save_knn`` a
    path to keep the neighbours at.  ``approximate`` searches inverted lists with
    ``list_options`` (n_lists, n_probe, centres).
    """
    rows = docs.select(docs[id_col].alias("id"), docs[vector_col].cast("array<double>").alias("vec"))
    if copies is not None or dedupe:
        copies = keep(dedupe_map(rows, "vec") if copies is None else copies, "dedupe")
        rows = unique_rows(rows, copies)
    rows = keep(rows, "reduce")
    if knn is None:
        find = knn_lists if approximate else knn_exact
        knn = find(rows, rows, k=n_neighbors, **list_options)
    if save_knn is not None:
        knn.write.parquet(save_knn)
        knn = rows.sparkSession.read.parquet(save_knn)
    graph = keep(fuzzy_graph(knn, n_neighbors), "fuzzy")
    placed = layout(rows, graph, n_components, n_epochs, min_dist)
    return placed if copies is None else undo_dedupe(placed, copies)


def cluster_documents(
    docs: DataFrame,
    min_cluster_size: int = 50,
    min_samples: int = 50,
    cluster_selection_epsilon: float = 0.0,
    crop_box: Sequence[float] | None = (-20, 20, -20, 20),
    id_col: str = "id",
    vector_col: str = "umap_5dim_15n",
    flat_col: str = "umap_2dim_15n",
) -> DataFrame:
    """(id, hdbscan_labels) of the documents whose two-dimensional place is in the box."""
    rows = docs if crop_box is None else crop(docs, crop_box, flat_col)
    points = keep(
        rows.select(docs[id_col].alias("id"), docs[vector_col].cast("array<double>").alias("vec")),
        "cluster-points",
    )
    labels = hdbscan(points, min_cluster_size, min_samples, cluster_selection_epsilon)
    return labels.withColumnRenamed("label", "hdbscan_labels")
