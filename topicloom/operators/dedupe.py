"""Exact vector dedupe and its inverse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_digest(rows: DataFrame, vector_col: str) -> DataFrame:
    """Add a 128-bit ``digest`` of the vector: two hashes from different seeds.

    Shuffles then carry 16 bytes per row instead of the whole vector.
    """
    return rows.withColumn(
        "digest", F.struct(F.xxhash64(vector_col), F.xxhash64(F.lit(1), vector_col))
    )


def dedupe_map(rows: DataFrame, vector_col: str, id_col: str = "id") -> DataFrame:
    """(id, rep_id): each row's first row with the same vector.

    The group-by combines copies map-side, and the join's right side has one row
    per vector, so a vector shared by very many rows only makes the left side of
    the join uneven, which adaptive execution splits.  Vectors that occur once do
    not enter the right side at all.
    """
    digests = with_digest(rows.select(id_col, vector_col), vector_col).select(id_col, "digest")
    copies = (
        digests.groupBy("digest")
        .agg(F.min(id_col).alias("rep_id"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )
    return digests.join(copies.drop("n"), "digest", "left").select(
        F.col(id_col).alias("id"), F.coalesce("rep_id", id_col).alias("rep_id")
    )


def unique_rows(rows: DataFrame, dedupe: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows that represent their group of copies (first occurrences)."""
    reps = dedupe.where(F.col("id") == F.col("rep_id")).select(F.col("id").alias(id_col))
    return rows.join(reps, id_col, "left_semi")


def undo_dedupe(values: DataFrame, dedupe: DataFrame, id_col: str = "id") -> DataFrame:
    """Give every document the value computed for its representative."""
    by_rep = values.withColumnRenamed(id_col, "rep_id")
    return dedupe.join(by_rep, "rep_id").drop("rep_id").withColumnRenamed("id", id_col)
