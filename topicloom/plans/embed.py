"""Clean, filter and embed documents, written by year."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators.cleaning import clean_documents
from topicloom.operators.embedding import embed_with_model, hashed_vector
from topicloom.operators.language import language_filter
from topicloom.sources.documents import read_years, write_years


def embed_years(
    spark: SparkSession,
    source: str,
    target: str,
    start: int,
    end: int,
    profiles: DataFrame | None = None,
    make_predict_fn: Callable | None = None,
    text_col: str = "abstract",
    dim: int = 64,
) -> None:
    """Years [start, end) of ``source``, cleaned and embedded, to ``target``.

    With language ``profiles`` only English documents are kept; without a model the
    hashed bag of words is used.  One stage without an exchange.
    """
    docs = clean_documents(read_years(spark, source, start, end))
    if profiles is not None:
        docs = language_filter(docs, profiles)
    if make_predict_fn is not None:
        embedded = embed_with_model(docs, make_predict_fn, text_col)
    else:
        embedded = docs.withColumn("embeddings", hashed_vector(F.col(text_col), dim))
    write_years(embedded, target)
