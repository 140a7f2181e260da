"""Bounded labelled samples to fit classifiers on, and the rows to score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.text import fold, inputs
from topicloom.workspace import keep


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    size: int,
    parts: int,
    held_out: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """At most ``size`` labelled documents outside the held-out fold: ``_id``, ``_text``, ``_y``.

    The ids come in the order of a hash, so the same rows are drawn whatever the partitions.
    Rows with a null id or label do not count; an id labelled twice takes the larger label, a
    repeated document the smallest text.  Only ids and labels are ordered and broadcast (at
    most ``size`` of them); the texts stay on the executors, in a written table.
    """
    known = inputs(labels, _id=id_col, _y=label_col)
    known = known.where(F.col("_id").isNotNull() & F.col("_y").isNotNull())
    known = known.where(fold(F.col("_id"), parts) != held_out)
    known = known.groupBy("_id").agg(F.max("_y").cast("double").alias("_y"))
    drawn = known.orderBy(F.xxhash64("_id"), "_id").limit(size)
    texts = inputs(docs, _id=id_col, _text=text_col).join(F.broadcast(drawn), "_id")
    return keep(texts.groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_y").alias("_y")), "labelled")
