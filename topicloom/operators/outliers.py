"""Reassigning outlier documents to topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.vectors import as_vector, normalise
from topicloom.operators.dedupe import dedupe_map, undo_dedupe, unique_rows
from topicloom.operators.neighbours import BLOCK_ROWS, knn_exact, knn_lists
from topicloom.operators.topics import OUTLIER, centroids
from topicloom.workspace import keep


def majority_topic(edges: DataFrame, topics: DataFrame) -> DataFrame:
    """(src, topic): most frequent topic among the neighbours; a tie goes to the nearest."""
    named = edges.join(topics.select(F.col("id").alias("dst"), "topic"), "dst")
    votes = named.groupBy("src", "topic").agg(
        F.count("*").alias("votes"), F.min("rank").alias("nearest")
    )
    order = F.struct(F.col("votes"), -F.col("nearest"))
    return votes.groupBy("src").agg(F.max_by("topic", order).alias("topic"))


def reassign_by_neighbours(
    docs: DataFrame,
    threshold: float = 0.85,
    k: int = 10,
    id_col: str = "id",
    vector_col: str = "vec",
    topic_col: str = "topic",
    dedupe: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    approximate: bool = False,
    **list_options,
) -> DataFrame:
    """(id, topic): outliers take the majority topic of their near neighbours.

    ``approximate`` searches inverted lists with ``list_options`` (n_lists, n_probe, centres).

    Only neighbours with squared distance <= 1 - threshold count; without any the
    document stays an outlier.  Copies of a vector all take the topic of the first.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), as_vector(vector_col).alias("vec"), F.col(topic_col).alias("topic")
    )
    if dedupe is None:
        dedupe = dedupe_map(rows, "vec")
    dedupe = keep(dedupe, "dedupe")
    unique = keep(unique_rows(rows, dedupe), "unique")
    topics = unique.select("id", "topic")
    lost, settled = unique.where(F.col("topic") == OUTLIER), unique.where(F.col("topic") != OUTLIER)
    find = knn_lists if approximate else knn_exact
    edges = find(lost, settled, k, max_dist=1.0 - threshold, block_rows=block_rows, **list_options)
    votes = majority_topic(edges, topics).select(F.col("src").alias("id"), F.col("topic").alias("voted"))
    final = topics.join(votes, "id", "left").select("id", F.coalesce("voted", "topic").alias("topic"))
    return undo_dedupe(final, dedupe)


def reassign_by_centroid(
    docs: DataFrame,
    threshold: float = 0.85,
    id_col: str = "id",
    vector_col: str = "vec",
    topic_col: str = "topic",
) -> DataFrame:
    """(id, topic): outliers take the topic whose mean vector is most similar.

    The cosine must reach the threshold.  On unit vectors the nearest centroid is
    the most similar one (squared distance = 2 - 2 cos), so this is a 1-nearest join.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), as_vector(vector_col).alias("vec"), F.col(topic_col).alias("topic")
    )
    settled = rows.where(F.col("topic") != OUTLIER)
    means = centroids(settled, "vec").select(
        F.col("topic").cast("long").alias("id"), normalise(F.col("centroid")).alias("vec")
    )
    # A zero vector has no direction: it is similar to nothing, and so is a zero mean.
    some = F.exists("vec", lambda x: x != 0)
    lost = rows.where((F.col("topic") == OUTLIER) & some).select("id", normalise(F.col("vec")).alias("vec"))
    near = knn_exact(lost, keep(means.where(some), "centroids"), k=1, max_dist=2.0 - 2.0 * threshold)
    found = near.select(F.col("src").alias("id"), F.col("dst").cast("int").alias("found"))
    return rows.select("id", "topic").join(found, "id", "left").select(
        "id", F.coalesce("found", "topic").alias("topic")
    )
