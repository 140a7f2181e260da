"""Language identification from character trigram profiles.

A profile holds the most frequent trigrams per language with the log of their share.
The profile has a fixed number of rows per language and is held in every task; scoring
a document is local to its row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.workspace import keep

# Added to the log share so that every listed trigram counts as evidence.
FLOOR = 15.0


def trigrams(text):
    """Overlapping trigrams of the letters, words padded by one blank; linear in the text."""
    letters = F.concat(
        F.lit(" "), F.lower(F.regexp_replace(text, r"[^\p{L}]+", " ")), F.lit(" ")
    )
    return F.regexp_extract_all(letters, F.lit("(?=(.{3}))"), F.lit(1))


def train_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = 300) -> DataFrame:
    """(lang, gram, weight) for the ``top`` trigrams of each language."""
    grams = docs.select(F.col(lang_col).alias("lang"), F.explode(trigrams(F.col(text_col))).alias("gram"))
    counts = grams.groupBy("lang", "gram").agg(F.count("*").alias("n"))
    counts = keep(counts, "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    weight = F.log(F.col("n") / F.col("total")) + FLOOR
    return keep(
        ranked.join(totals, "lang").select("lang", "gram", weight.alias("weight")), "profiles"
    )


def _code(points: np.ndarray) -> np.ndarray:
    """Integer code of every trigram of a code-point array (21 bits a code point)."""
    if len(points) < 3:
        return np.zeros(0, dtype=np.uint64)
    return (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]


def detected(text: Column, profiles: DataFrame) -> Column:
    """Struct of ``language`` and ``score``: the language with the largest summed weight.

    Row-local, in Arrow batches; a tie goes to the first language by name.  A text without
    any listed trigram has a null language.  The profiles have a fixed number of rows per
    language, so they are held in every task, as sorted integer trigram codes: a text
    becomes a code-point array, its trigrams integer codes, counted by ``np.unique`` and
    looked up by one ``searchsorted``, without a Python loop over characters.
    """
    languages = sorted(r["lang"] for r in profiles.select("lang").distinct().collect())
    # A fixed number of rows per language.  Grams are UTF-16 triples in the JVM; one with a
    # character beyond the basic plane is not three code points and can match no text here.
    rows = [r for r in profiles.collect() if len(r["gram"]) == 3]
    grams = sorted({r["gram"] for r in rows})
    weights = np.zeros((len(grams), len(languages)))
    where = {g: i for i, g in enumerate(grams)}
    for row in rows:
        weights[where[row["gram"]], languages.index(row["lang"])] = row["weight"]
    codes = np.array([_code(np.array([ord(c) for c in g], dtype=np.uint64))[0] for g in grams], dtype=np.uint64)
    order = np.argsort(codes)
    shared = profiles.sparkSession.sparkContext.broadcast((codes[order], weights[order]))
    other = regex.compile(r"[^\p{L}]+")

    @F.pandas_udf("language string, score double")
    def best(texts: pd.Series) -> pd.DataFrame:
        keys, table = shared.value
        out = []
        for value in texts:
            letters = f" {other.sub(' ', value or '').lower()} "
            points = np.frombuffer(letters.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
            found, n = np.unique(_code(points), return_counts=True)
            at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
            hit = keys[at] == found if len(keys) else np.zeros(len(found), dtype=bool)
            if not hit.any():
                out.append((None, None))
                continue
            w, k = table[at[hit]], n[hit][:, None]
            total = (w * k).sum(axis=0)
            # A weight of zero means the language does not list the trigram.
            listed = ((w != 0) * k).sum(axis=0) > 0
            total = np.where(listed, total, -np.inf)
            out.append((languages[int(total.argmax())], float(total.max())))
        return pd.DataFrame(out, columns=["language", "score"])

    return best(text)


def detect_language(docs: DataFrame, profiles: DataFrame, text_col: str = "text", id_col: str = "id") -> DataFrame:
    """(id, language, score) of every row, see ``detected``."""
    found = docs.select(id_col, detected(F.col(text_col), profiles).alias("_found"))
    return found.select(id_col, "_found.language", "_found.score")


def language_filter(
    docs: DataFrame, profiles: DataFrame, language: str = "en", text_col: str = "abstract", id_col: str = "id"
) -> DataFrame:
    """Documents in ``language``, with the ``language`` column added; no shuffle."""
    found = detected(F.col(text_col), profiles)["language"]
    return docs.withColumn("language", found).where(F.col("language") == language)
