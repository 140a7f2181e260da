"""Topic model of clustered documents, labels and hierarchy; splitting a cluster."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.operators.hierarchy import build_hierarchy, label_parents, with_parents
from topicloom.operators.labels import LabelFn, first_keywords, label_topics
from topicloom.operators.outliers import reassign_by_centroid, reassign_by_neighbours
from topicloom.operators.refine import offset_topics, remap_clusters
from topicloom.operators.topics import describe, describe_counts, fit_topics, move_counts, size_ranks, topic_counts
from topicloom.workspace import keep, small


def reduce_outliers(docs: DataFrame, strategy: str = "knn", threshold: float = 0.85, **options) -> DataFrame:
    """Documents with ``topics_ored`` next to ``topic``."""
    by = {"knn": reassign_by_neighbours, "centroid": reassign_by_centroid}[strategy]
    new = by(docs, threshold, **options)
    return docs.join(new.withColumnRenamed("topic", "topics_ored"), "id")


def model_topics(
    docs: DataFrame, cluster_col: str = "cluster", outliers: bool = False, threshold: float = 0.85, **options
) -> dict[str, DataFrame]:
    """Topic model tables: doc_topics, topic_info, ctfidf (and updated ones after
    outlier reduction)."""
    assigned, info, weights = fit_topics(docs, cluster_col, **options)
    if outliers:
        assigned = keep(reduce_outliers(keep(assigned, "assigned"), threshold=threshold), "reassigned")
        info, weights = describe(assigned, "topics_ored", **options)
    return {"doc_topics": assigned, "topic_info": info, "ctfidf": weights}


def label_model(
    model: dict[str, DataFrame],
    label_fn: LabelFn = first_keywords,
    threshold: float = 0.5,
    levels: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """Labelled topic table with parents, and the labelled hierarchy."""
    titled = model["doc_topics"].select("id", "title", "topic")
    labelled = keep(label_topics(model["topic_info"], titled, label_fn), "labelled-topics")
    names = labelled.select(F.col("topic").cast("string").alias("topic_id"), F.col("llm_topic").alias("name"))
    hierarchy = keep(label_parents(build_hierarchy(model["ctfidf"], names), names, label_fn), "hierarchy")
    info = labelled.withColumnsRenamed(
        {"topic": "Topic", "cnt": "Count", "name": "Name", "representation": "Representation"}
    )
    return with_parents(info, hierarchy, threshold, levels), hierarchy


def split_cluster(
    docs: DataFrame,
    cluster: int,
    cluster_fn: Callable[[DataFrame], DataFrame],
    cluster_col: str = "cluster",
    offset: int = 1000,
    outlier_threshold: float | None = None,
) -> DataFrame:
    """Documents with one cluster split: its members get sub-topic ids from ``offset`` up.

    ``cluster_fn`` maps the members to (id, label).  Sub-topics are numbered by size,
    outliers among them stay -1 unless ``outlier_threshold`` asks to reassign them.
    """
    from topicloom.operators.topics import renumber

    part = docs.where(F.col(cluster_col) == cluster)
    labels = cluster_fn(part).select("id", F.col("label").alias("_sub"))
    sub = renumber(part.join(labels, "id"), "_sub", "topic")
    if outlier_threshold is not None:
        sub = reassign_by_neighbours(keep(sub, "sub"), outlier_threshold)
    moved = offset_topics(sub, "topic", offset).select("id", F.col("topic").alias("cluster"))
    return remap_clusters(docs, keep(moved, "split"), cluster_col, keep_unmapped=True)


def split_and_refit(
    docs: DataFrame,
    counts: DataFrame,
    cluster: int,
    cluster_fn: Callable[[DataFrame], DataFrame],
    cluster_col: str = "cluster",
    text_col: str = "abstract",
    offset: int = 1000,
    outlier_threshold: float | None = None,
    stop_words=None,
    min_df: float = 0.1,
    n_terms: int = 10,
) -> dict[str, DataFrame]:
    """The whole split recipe: cluster the members of one cluster anew, number their
    sub-topics by size from ``offset`` (outliers -1, or reassigned with
    ``outlier_threshold``), write them back, and refit the topic model.

    ``counts`` are the term counts (topic, term, n) of ``docs`` under
    ``cluster_col`` as the earlier fit left them.  The refit does not tokenise the
    corpus again: only moved documents are counted, their terms leave the old
    cluster and join the new one (``move_counts``); the clusters are then
    renumbered by size and c-TF-IDF is computed from the updated counts.  The
    result equals a fit from scratch of the documents with their new clusters.

    Returns ``doc_topics`` (docs with the new ``cluster_col`` and ``topic``),
    ``topic_info``, ``ctfidf`` and ``counts`` (per new cluster id, for a later
    split).
    """
    split = keep(split_cluster(docs, cluster, cluster_fn, cluster_col, offset, outlier_threshold), "split-docs")
    before = docs.select("id", F.col(cluster_col).alias("_old"), text_col)
    after = split.select("id", F.col(cluster_col).alias("_new"))
    moved = before.join(after, "id").where(~F.col("_old").eqNullSafe(F.col("_new")))
    new_counts = keep(move_counts(counts, moved, "_old", "_new", text_col, stop_words), "split-counts")
    ranks = small(size_ranks(split, cluster_col))  # one row per cluster
    assigned = split.join(
        ranks.select(F.col("old").alias(cluster_col), F.col("new").alias("topic")), cluster_col, "left"
    )
    topic_terms = new_counts.join(ranks, new_counts["topic"] == ranks["old"]).select(
        F.col("new").alias("topic"), "term", "n"
    )
    info, weights = describe_counts(topic_terms, topic_counts(assigned, "topic"), min_df, n_terms=n_terms)
    return {"doc_topics": assigned, "topic_info": info, "ctfidf": weights, "counts": new_counts}
