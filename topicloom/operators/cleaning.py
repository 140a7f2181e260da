"""Document cleaning: drop unusable rows, count words, build the text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import word_count


def drop_blank(docs: DataFrame) -> DataFrame:
    """Drop rows with neither title nor abstract, and rows where one of them is empty.

    A null on one side only is kept here (an empty string is not).
    """
    return docs.na.drop("all", subset=["title", "abstract"]).where(
        ~F.col("abstract").eqNullSafe("") & ~F.col("title").eqNullSafe("")
    )


def with_length(docs: DataFrame) -> DataFrame:
    """``length`` = words of abstract and title together; null if either is null."""
    return docs.withColumn(
        "length", word_count(F.col("abstract")) + word_count(F.col("title"))
    )


def with_text(docs: DataFrame) -> DataFrame:
    """Nulls become empty strings; ``text`` = title and abstract with a blank between."""
    title = F.coalesce("title", F.lit(""))
    abstract = F.coalesce("abstract", F.lit(""))
    return docs.withColumns(
        {"title": title, "abstract": abstract, "text": F.concat_ws(" ", title, abstract)}
    )


def long_enough(docs: DataFrame, min_words: int = 20) -> DataFrame:
    return docs.where(F.col("length") >= min_words)


def clean_documents(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """All cleaning steps in order: one pass over the rows, without a shuffle.

    The words are counted once: the count leaves an array only where it is large enough, so
    that the optimizer cannot put a second copy of it into a filter.
    """
    words = word_count(F.col("abstract")) + word_count(F.col("title"))
    enough = F.filter(F.array(words), lambda n: n >= min_words)
    return with_text(drop_blank(docs).withColumn("length", F.explode(enough)))
