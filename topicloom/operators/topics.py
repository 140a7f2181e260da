"""Topic representations: class-based TF-IDF, top terms, renumbering, centroids."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.text import tokens
from topicloom.workspace import global_index, keep

OUTLIER = -1


def term_counts(
    docs: DataFrame,
    topic_col: str = "topic",
    text_col: str = "abstract",
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """(topic, term, n).  Counts are combined map-side, so a hot topic is no problem.

    Stop words default to Spark's English list.
    """
    if stop_words is None:
        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    terms = docs.select(F.col(topic_col).alias("topic"), F.explode(tokens(F.col(text_col))).alias("term"))
    return (
        terms.where(~F.col("term").isin(list(stop_words)))
        .groupBy("topic", "term")
        .agg(F.count("*").alias("n"))
    )


def class_tfidf(
    counts: DataFrame,
    n_topics: int,
    min_df: float = 0.1,
    reduce_frequent_words: bool = True,
) -> DataFrame:
    """(topic, term, n, weight) for the terms found in at least ``min_df`` of the topics.

    weight = tf * ln(1 + A / f): tf is the term's share of the topic's kept terms
    (its square root with ``reduce_frequent_words``), f its count over all topics,
    A the whole part of the mean number of kept terms per topic.
    """
    per_term = Window.partitionBy("term")  # at most one row per topic
    kept = (
        counts.withColumn("f", F.sum("n").over(per_term))
        .withColumn("df", F.count("*").over(per_term))
        .where(F.col("df") >= min_df * n_topics)
    )
    per_topic = kept.groupBy("topic").agg(F.sum("n").alias("total"))
    # one row: the mean over the topics that are being described
    mean = per_topic.agg(F.floor(F.sum("total") / F.lit(n_topics)).alias("a"))
    tf = F.col("n") / F.col("total")
    if reduce_frequent_words:
        tf = F.sqrt(tf)
    return (
        kept.join(per_topic, "topic")
        .withColumn("weight", tf * F.log(1 + mean.scalar() / F.col("f")))
        .select("topic", "term", "n", "weight")
    )


def move_counts(
    counts: DataFrame,
    moved: DataFrame,
    old_col: str,
    new_col: str,
    text_col: str = "abstract",
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """(topic, term, n) after documents changed topic, without tokenising the others again.

    ``moved`` holds only the documents whose topic changed, with their old and new
    topic.  Each of their terms is counted once with -1 for the old topic and +1
    for the new; the deltas are summed map-side together with ``counts`` and rows
    that fall to zero are dropped, so the result equals ``term_counts`` of the
    whole corpus under its new topics.
    """
    if stop_words is None:
        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    terms = moved.select(
        F.col(old_col).alias("_old"), F.col(new_col).alias("_new"), F.explode(tokens(F.col(text_col))).alias("term")
    ).where(~F.col("term").isin(list(stop_words)))
    sides = F.array(
        F.struct(F.col("_old").alias("topic"), F.lit(-1).cast("long").alias("n")),
        F.struct(F.col("_new").alias("topic"), F.lit(1).cast("long").alias("n")),
    )
    delta = terms.select("term", F.explode(sides).alias("_d")).select("_d.topic", "term", "_d.n")
    return (
        counts.select("topic", "term", F.col("n").cast("long"))
        .unionByName(delta)
        .groupBy("topic", "term")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > 0)
    )


def describe_counts(
    counts: DataFrame,
    sizes: DataFrame,
    min_df: float = 0.1,
    weight_fn: Callable[[DataFrame, int], DataFrame] | None = None,
    n_terms: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Topic table and term weights from term counts (topic, term, n) and sizes (topic, cnt)."""
    n_topics = sizes.count()
    weights = weight_fn(counts, n_topics) if weight_fn else class_tfidf(counts, n_topics, min_df)
    info = sizes.join(top_terms(weights, n_terms), "topic", "left").select(
        "topic",
        "cnt",
        topic_name(),
        F.coalesce("representation", F.array().cast("array<string>")).alias("representation"),
    )
    return info, weights


def top_terms(weights: DataFrame, n: int = 10) -> DataFrame:
    """(topic, representation): the heaviest terms of each topic, best first."""
    order = [F.round("weight", 9).desc(), F.col("term")]
    ranked = weights.withColumn(
        "rank", F.row_number().over(Window.partitionBy("topic").orderBy(*order))
    ).where(F.col("rank") <= n)
    listed = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy("topic").agg(listed["term"].alias("representation"))


def topic_counts(docs: DataFrame, topic_col: str = "topic") -> DataFrame:
    return docs.groupBy(F.col(topic_col).alias("topic")).agg(F.count("*").alias("cnt"))


def describe(
    docs: DataFrame,
    topic_col: str = "topic",
    text_col: str = "abstract",
    stop_words: Iterable[str] | None = None,
    min_df: float = 0.1,
    tokenize_fn: Callable[[DataFrame], DataFrame] | None = None,
    weight_fn: Callable[[DataFrame, int], DataFrame] | None = None,
    n_terms: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Topic table and term weights for topics as they are numbered.

    ``tokenize_fn`` may replace the term counting (documents -> topic, term, n) and
    ``weight_fn`` the weighting (counts, number of topics -> topic, term, n, weight).
    """
    if tokenize_fn is None:
        counts = term_counts(docs, topic_col, text_col, stop_words)
    else:
        counts = tokenize_fn(docs)
    # Read three times below; kept so that the texts are tokenised once.
    counts = keep(counts, "term-counts")
    return describe_counts(counts, topic_counts(docs, topic_col), min_df, weight_fn, n_terms)


def topic_name(n: int = 4):
    """``<topic>_<term>_<term>_...`` from the first terms of the representation."""
    head = F.slice("representation", 1, n)
    return F.concat_ws("_", F.col("topic").cast("string"), head).alias("name")


def size_ranks(docs: DataFrame, topic_col: str) -> DataFrame:
    """(old, new): topics renumbered from 0 by falling size, the outlier topic kept."""
    sizes = topic_counts(docs, topic_col).where(F.col("topic") != OUTLIER)
    ranked = global_index(sizes, [F.col("cnt").desc(), F.col("topic")], "rank")
    ranks = ranked.select(F.col("topic").alias("old"), F.col("rank").cast("int").alias("new"))
    fixed = ranks.sparkSession.range(1).select(
        F.lit(OUTLIER).alias("old"), F.lit(OUTLIER).alias("new")
    )
    return ranks.unionByName(fixed)


def renumber(docs: DataFrame, cluster_col: str, topic_col: str = "topic") -> DataFrame:
    """Add ``topic_col``: the size rank of the row's cluster."""
    ranks = size_ranks(docs, cluster_col)
    return docs.join(
        ranks.select(F.col("old").alias(cluster_col), F.col("new").alias(topic_col)),
        cluster_col,
        "left",
    )


def fit_topics(
    docs: DataFrame,
    cluster_col: str = "cluster",
    text_col: str = "abstract",
    reduce_fn: Callable[[DataFrame], DataFrame] | None = None,
    cluster_fn: Callable[[DataFrame], DataFrame] | None = None,
    **describe_options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with a ``topic`` column, the topic table and the term weights.

    ``reduce_fn`` and ``cluster_fn`` may compute vectors and clusters first; left
    out, the clusters already in ``cluster_col`` are used.  A missing cluster means outlier.
    """
    for step in (reduce_fn, cluster_fn):
        if step is not None:
            docs = step(docs)
    docs = docs.withColumn(cluster_col, F.coalesce(cluster_col, F.lit(OUTLIER)))
    assigned = renumber(docs, cluster_col)
    info, weights = describe(assigned, "topic", text_col, **describe_options)
    return assigned, info, weights


def centroids(docs: DataFrame, vector_col: str, topic_col: str = "topic") -> DataFrame:
    """(topic, centroid): mean vector of each topic, partial sums formed map-side."""
    rows = docs.where(F.col(vector_col).isNotNull()).select(
        F.col(topic_col).alias("topic"), array_to_vector(vector_col).alias("v")
    )
    return rows.groupBy("topic").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("centroid"))
