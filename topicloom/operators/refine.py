"""Manual topic changes: subset, remove, offset, remap, merge."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.operators.topics import OUTLIER
from topicloom.workspace import small

# Lists up to this length become literals in the plan; longer ones a table that is joined.
LITERAL_IDS = 1_000


def _id_table(docs: DataFrame, ids, name: str) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).alias(name))
    rows = [(v,) for v in dict.fromkeys(ids)]
    kind = docs.schema[name].dataType.simpleString() if name in docs.columns else "bigint"
    return docs.sparkSession.createDataFrame(rows, f"{name} {kind}")


def only_clusters(docs: DataFrame, ids, cluster_col: str = "cluster") -> DataFrame:
    """Rows whose cluster is one of ``ids``: a short list, a long list or a one-column table.

    Short lists are literals (``isin``); a long list or a table is a left semi join,
    broadcast when the table is counted small and shuffled otherwise.  Nulls match
    nothing; repeated ids do not repeat rows.
    """
    if not isinstance(ids, DataFrame):
        ids = list(ids)
        if len(ids) <= LITERAL_IDS:
            return docs.where(F.col(cluster_col).isin(ids))
    table = _id_table(docs, ids, cluster_col).where(F.col(cluster_col).isNotNull())
    return docs.join(small(table), cluster_col, "left_semi")


def fill_outliers(docs: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """A missing cluster means outlier."""
    return docs.withColumn(cluster_col, F.coalesce(cluster_col, F.lit(OUTLIER)))


def to_outlier(docs: DataFrame, topics: Iterable[int], topic_col: str = "topic") -> DataFrame:
    """Set the listed topics to outlier; fit the topics again afterwards."""
    gone = F.col(topic_col).isin(list(topics))
    return docs.withColumn(topic_col, F.when(gone, OUTLIER).otherwise(F.col(topic_col)))


def offset_topics(docs: DataFrame, topic_col: str = "topic", offset: int = 1000) -> DataFrame:
    """Shift sub-topic ids out of the way of the existing ones; outliers stay -1."""
    shifted = F.when(F.col(topic_col) == OUTLIER, OUTLIER).otherwise(F.col(topic_col) + offset)
    return docs.withColumn(topic_col, shifted)


def remap_clusters(
    docs: DataFrame, id_map: DataFrame, cluster_col: str = "cluster", id_col: str = "id", keep_unmapped: bool = False
) -> DataFrame:
    """Replace clusters by an (id, cluster) map; unmapped ids become null or keep theirs.

    Of several clusters for one id the largest counts.
    """
    new = id_map.groupBy(F.col("id").alias(id_col)).agg(F.max("cluster").alias("_new"))
    joined = docs.join(new, id_col, "left")
    value = F.coalesce("_new", cluster_col) if keep_unmapped else F.col("_new")
    return joined.withColumn(cluster_col, value).drop("_new")


def merge_topics(docs: DataFrame, groups, topic_col: str = "topic") -> DataFrame:
    """Collapse each listed group into its first id; accepts one list, a list of lists, or a
    mapping table (old, new) whose first two columns say where each old id goes.

    The groups become a mapping table that is joined (broadcast when counted small), so the
    number of merged ids is not bounded by the plan.  An id listed in two groups follows the
    later one; in a table, an old id with several targets goes to the smallest.
    """
    if isinstance(groups, DataFrame):
        old, new = groups.columns[:2]
        mapping = groups.groupBy(F.col(old).alias("_old")).agg(F.min(new).alias("_new"))
    else:
        if groups and not isinstance(groups[0], (list, tuple)):
            groups = [groups]
        pairs = {old: group[0] for group in groups for old in group[1:]}
        if not pairs:
            return docs
        kind = docs.schema[topic_col].dataType.simpleString()
        mapping = docs.sparkSession.createDataFrame(list(pairs.items()), f"_old {kind}, _new {kind}")
    mapping = mapping.where(F.col("_old").isNotNull())
    joined = docs.join(small(mapping), docs[topic_col] == mapping["_old"], "left")
    return joined.withColumn(topic_col, F.coalesce(F.col("_new"), F.col(topic_col))).drop("_old", "_new")