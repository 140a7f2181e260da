"""Text embedding: a hashed bag of words, or a model of the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import regex
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.text import TOKEN_PATTERN
from topicloom.functions.vectors import normalise


_BUCKETS: dict[int, dict[str, int]] = {}
# Words remembered per worker; when full, the table is started anew.
KNOWN_WORDS = 200_000
# Characters whose words are held at a time.
PIECE_CHARS = 1_000_000


def hashed_vector(text: Column, dim: int = 64) -> Column:
    """Unit vector of word counts in ``dim`` hash buckets; without a word, all zero.

    Row-local, in Arrow batches: no shuffle, however many buckets.  Each Python worker
    keeps the buckets of a bounded number of words; a batch is worked off in pieces of a
    bounded length, each counted at once with one ``bincount`` over (row, bucket).
    """
    pattern = regex.compile(TOKEN_PATTERN)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def embed(texts: pd.Series) -> pd.Series:
        known = _BUCKETS.setdefault(dim, {})  # kept by the Python worker across batches
        values = [value or "" for value in texts]
        counts = np.concatenate(
            [count_words(values[a:b], pattern, known, dim) for a, b in pieces(values)] or [np.zeros((0, dim))]
        )
        norms = np.maximum(np.sqrt((counts.astype(float) ** 2).sum(axis=1)), 1e-12)
        return pd.Series(list(counts / norms[:, None]))

    return embed(text)


def pieces(values: list[str]) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts with at most ``PIECE_CHARS`` characters, or a single one."""
    start, held = 0, 0
    for i, value in enumerate(values):
        if i > start and held + len(value) > PIECE_CHARS:
            yield start, i
            start, held = i, 0
        held += len(value)
    if start < len(values):
        yield start, len(values)


def count_words(values: list[str], pattern: regex.Pattern, known: dict[str, int], dim: int) -> np.ndarray:
    """Word counts per text and bucket; ``known`` gains the new words' buckets."""
    words = [pattern.findall(value.lower()) for value in values]
    if len(known) > KNOWN_WORDS:
        known.clear()
    for term in {t for terms in words for t in terms} - known.keys():
        known[term] = int(md5(term.encode()).hexdigest()[:8], 16) % dim
    rows = np.repeat(np.arange(len(words)), [len(terms) for terms in words])
    buckets = np.fromiter((known[t] for terms in words for t in terms), dtype=np.int64, count=len(rows))
    return np.bincount(rows * dim + buckets, minlength=len(words) * dim).reshape(len(words), dim)


def hashed_embedding(docs: DataFrame, dim: int = 64, text_col: str = "abstract", id_col: str = "id") -> DataFrame:
    """(id, embedding) of every row, see ``hashed_vector``."""
    return docs.select(id_col, hashed_vector(F.col(text_col), dim).alias("embedding"))


def embed_with_model(
    docs: DataFrame,
    make_predict_fn: Callable,
    text_col: str = "abstract",
    batch_size: int = 400,
    output_col: str = "embeddings",
) -> DataFrame:
    """Add unit vectors from a batch model.

    ``make_predict_fn`` loads the model once per Python worker and returns a function
    from a batch of texts to a (rows, dims) array.
    """
    predict = predict_batch_udf(
        make_predict_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size
    )
    return docs.withColumn(output_col, predict(F.col(text_col))).withColumn(
        output_col, normalise(F.col(output_col))
    )
