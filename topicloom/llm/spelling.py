"""Spelling variant grouping by search schemes over FM-indexes of the vocabulary.

Two words are near when one edit (insert, delete or replace one code point)
turns one into the other.  For such a pair ``u``, ``v`` with
``m = |u| <= |v| <= m + 1`` the edit lies in one half of ``u``, so the other
half matches exactly (pigeonhole): either ``u[:m//2]`` is a prefix of ``v`` or
``u[m - ceil(m/2):]`` is a suffix of ``v``.  That gives two search schemes:

* R: match the right half exactly, then extend leftwards across the left half
  allowing one error;
* L: match the left half exactly, then extend rightwards across the right half
  allowing one error.

Backward search on an FM-index extends a match to the left, so scheme R runs
on the index of the words and scheme L on the index of the reversed words: the
two directions of a bidirectional index.  The index is built over the
*delimited* vocabulary ``$w1$w2$...$wk$`` (suffix array by prefix doubling,
BWT, count and rank tables), and a match of ``$ pattern $`` is a whole word.
The extension with one error branches, at every pattern position, into all
characters whose suffix-rank interval is not empty (replacement) and into an
extra character (insertion into the target); deletions are the insertions
seen from the shorter word.  All queries of a group advance together, one
numpy step per pattern position.

On Spark, the vocabulary is counted by a grouped aggregation with map-side
combine.  Each word then goes to the groups (scheme, length band, first or
last ``KEY_CHARS`` of the exact half) where it can be a query or a target; a group larger than ``SHARD_CHARS``
characters splits its index into shards and every query of the group searches
each shard, so no task holds more than one shard's index.  Found pairs are
made symmetric and distinct, forms are chosen by one aggregation, and roots
by pointer jumping over written tables (at most log2 of the chain length
rounds, chains double their n at every step).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.text import inputs
from topicloom.workspace import drop_kept, keep

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
DROP_MODULUS = 97
MIN_LENGTH = 5
MIN_COUNT = 3
FORM_FACTOR = 2
# Parameters: characters of one index shard (bounds a task's index memory), and characters of
# the exact half that place a word in a group (the half is at least 2 long from 5 code points on;
# the index itself matches the rest of the half).
SHARD_CHARS = 200_000
KEY_CHARS = 2

SEP, END = 1, 0  # codes of the word delimiter and of the text end


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling: sort by (rank, rank k ahead) until ranks are distinct."""
    n = len(codes)
    rank = codes.astype(np.int64)
    k = 1
    while True:
        ahead = np.full(n, -1, dtype=np.int64)
        ahead[: n - k] = rank[k:] if k < n else ahead[:0]
        sa = np.lexsort((ahead, rank))
        step = np.empty(n, dtype=np.int64)
        step[0] = 0
        step[1:] = (rank[sa[1:]] != rank[sa[:-1]]) | (ahead[sa[1:]] != ahead[sa[:-1]])
        rank = np.empty(n, dtype=np.int64)
        rank[sa] = np.cumsum(step)
        if rank[sa[-1]] == n - 1 or k >= n:
            return sa
        k *= 2


class FMIndex:
    """FM-index of ``$w1$w2$...$wk$`` over dense character codes."""

    def __init__(self, words: list[str], alphabet: dict[str, int]):
        self.words = words
        parts = [SEP]
        starts = []
        for w in words:
            starts.append(len(parts))
            parts.extend(alphabet[c] for c in w)
            parts.append(SEP)
        parts.append(END)
        text = np.array(parts, dtype=np.int64)
        self.starts = np.array(starts, dtype=np.int64)
        self.sa = suffix_array(text)
        bwt = text[(self.sa - 1) % len(text)]
        sigma = len(alphabet) + 2
        counts = np.bincount(text, minlength=sigma)
        self.first = np.concatenate(([0], np.cumsum(counts)[:-1]))  # C: codes smaller than c
        occ = np.zeros((len(text) + 1, sigma), dtype=np.int32)
        occ[np.arange(1, len(text) + 1), bwt] = 1
        self.occ = np.cumsum(occ, axis=0, dtype=np.int32)  # rank of c before position i
        self.n = len(text)

    def extend(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray):
        """Intervals of ``c + match`` from intervals of ``match`` (vectorised backward step)."""
        return self.first[c] + self.occ[lo, c], self.first[c] + self.occ[hi, c]

    def word_at(self, lo: np.ndarray) -> np.ndarray:
        """Word index of the suffix at rank ``lo`` (which starts at a delimiter)."""
        return np.searchsorted(self.starts, self.sa[lo] + 1)


def one_error_matches(index: FMIndex, queries: list[str], exact: int, alphabet: dict[str, int]):
    """Pairs (query index, word index) where ``$word$`` is ``$query$`` with exactly one
    replacement or one inserted character within the first ``len(q) - exact`` positions
    (and the insertion also right after them); all queries have one length."""
    if not queries or not index.words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    m = len(queries[0])
    pattern = np.array([[SEP, *(alphabet[c] for c in q), SEP] for q in queries], dtype=np.int64)
    letters = np.arange(2, len(alphabet) + 2, dtype=np.int64)
    q = np.arange(len(queries))
    lo = np.zeros(len(queries), dtype=np.int64)
    hi = np.full(len(queries), index.n, dtype=np.int64)
    err = np.zeros(len(queries), dtype=np.int8)
    for k in range(m + 1, -1, -1):
        if k <= m - exact:
            base = err == 0
            bq, blo, bhi = q[base], lo[base], hi[base]
            # Insertion into the target before pattern position k is consumed.
            iq = np.repeat(bq, len(letters))
            ilo, ihi = index.extend(np.repeat(blo, len(letters)), np.repeat(bhi, len(letters)), np.tile(letters, len(bq)))
            live = ilo < ihi
            iq, ilo, ihi = iq[live], ilo[live], ihi[live]
            # Replacement of pattern position k (letters only; delimiters stay).
            if k >= 1:
                rq = np.repeat(bq, len(letters))
                rc = np.tile(letters, len(bq))
                rlo, rhi = index.extend(np.repeat(blo, len(letters)), np.repeat(bhi, len(letters)), rc)
                live = (rlo < rhi) & (rc != pattern[rq, k])
                rq, rlo, rhi = rq[live], rlo[live], rhi[live]
            else:
                rq = rlo = rhi = np.zeros(0, dtype=np.int64)
            q = np.concatenate((q, iq))
            lo = np.concatenate((lo, ilo))
            hi = np.concatenate((hi, ihi))
            err = np.concatenate((err, np.ones(len(iq), dtype=np.int8)))
        else:
            rq = rlo = rhi = np.zeros(0, dtype=np.int64)
        lo, hi = index.extend(lo, hi, pattern[q, k])
        live = lo < hi
        q, lo, hi, err = q[live], lo[live], hi[live], err[live]
        q = np.concatenate((q, rq))
        lo = np.concatenate((lo, rlo))
        hi = np.concatenate((hi, rhi))
        err = np.concatenate((err, np.ones(len(rq), dtype=np.int8)))
    found = err == 1
    q, lo, hi = q[found], lo[found], hi[found]
    # Words are distinct, so every interval of a whole delimited word holds one suffix.
    sizes = hi - lo
    q = np.repeat(q, sizes)
    ranks = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)]) if len(lo) else lo
    return q, index.word_at(ranks)


def _search(key, pdf):
    scheme, band = key[0], int(key[1])
    members = sorted(set(pdf.loc[pdf["_i"], "_w"]))
    queries = sorted(set(pdf.loc[pdf["_q"], "_w"]))
    if scheme == "L":  # backward search extends leftwards: reverse for the left-half scheme
        members = [w[::-1] for w in members]
        queries = [w[::-1] for w in queries]
        exact = band // 2
    else:
        exact = band - band // 2
    alphabet = {c: i + 2 for i, c in enumerate(sorted(set("".join(members)) | set("".join(queries))))}
    index = FMIndex(members, alphabet)
    qi, wi = one_error_matches(index, queries, exact, alphabet)
    a = [queries[i] for i in qi]
    b = [members[i] for i in wi]
    if scheme == "L":
        a = [w[::-1] for w in a]
        b = [w[::-1] for w in b]
    # Typed columns: an empty result must still convert as strings.
    return pd.DataFrame({"word": pd.Series(a, dtype=object), "other": pd.Series(b, dtype=object)})


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): lower-cased runs after the contract's pseudo-random deletion, counted corpus-wide,
    of at least MIN_LENGTH code points and MIN_COUNT occurrences."""
    rows = inputs(docs, _id=id_col, _text=text_col)
    runs = rows.select(
        F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit(RUN), 0)).alias("_r"),
    ).select("_id", F.translate("_r", UPPER, LOWER).alias("_r"))
    h = F.crc32(F.concat_ws(":", "_id", "_r").cast("binary"))
    cut = (h % F.length("_r")).cast("int")
    word = F.when(
        h % DROP_MODULUS == 0,
        F.concat(F.col("_r").substr(F.lit(1), cut), F.col("_r").substr(cut + 2, F.length("_r"))),
    ).otherwise(F.col("_r"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def near_pairs(vocab: DataFrame) -> DataFrame:
    """Symmetric distinct pairs (word, other) of vocabulary words one edit apart."""
    length = F.length("word")
    # A word is a query and target of its own band and a target of the band one shorter.
    placed = vocab.select(
        "word",
        F.explode(F.array(
            F.struct(length.alias("_m"), F.lit(True).alias("_q")),
            F.struct((length - 1).alias("_m"), F.lit(False).alias("_q")),
        )).alias("_p"),
    ).select("word", "_p._m", "_p._q").where(F.col("_m") >= MIN_LENGTH)
    keyed = placed.select(
        "word", "_m", "_q",
        F.explode(F.array(
            F.struct(F.lit("L").alias("_s"), F.col("word").substr(1, KEY_CHARS).alias("_k")),
            F.struct(F.lit("R").alias("_s"), F.expr(f"substring(word, -{KEY_CHARS})").alias("_k")),
        )).alias("_g"),
    ).select("word", "_m", "_q", "_g._s", "_g._k")
    group = ["_s", "_m", "_k"]
    sizes = keyed.groupBy(*group).agg(
        F.ceil(F.sum(F.length("word") + 1) / SHARD_CHARS).cast("int").alias("_shards")
    )
    # A query searches every shard of its group; a word is an index member of its own shard only.
    own = F.pmod(F.xxhash64("word"), F.col("_shards")).cast("int")
    rows = keyed.join(sizes, group).select(
        F.col("word").alias("_w"), "_q", *group, own.alias("_own"),
        F.explode(F.when(F.col("_q"), F.sequence(F.lit(0), F.col("_shards") - 1)).otherwise(F.array(own))).alias("_shard"),
    ).withColumn("_i", F.col("_shard") == F.col("_own"))
    found = rows.groupBy("_s", "_m", "_k", "_shard").applyInPandas(_search, "word string, other string")
    return found.unionByName(found.select(F.col("other").alias("word"), F.col("word").alias("other"))).distinct()


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spelling variants of the corpus vocabulary with their forms and roots.

    Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of every whole text
    (null: none), A-Z lower-cased; a run whose unsigned crc32 of
    ``<id>:<run>`` (a null id as empty) is divisible by 97 loses its code
    point ``h % length``.  Kept are distinct results of at least 5 code points
    met at least 3 times (``n``).  A word's form is its near word (one edit)
    of largest ``n``, ties by smallest word, if that ``n`` is at least twice
    its own; its root follows forms to the end (itself without a form).

    Returns word, form, root (strings), n, n_near, form_n (long; form_n null
    without a form).  Empty tables, texts without runs and very long runs give
    no rows or long words, each searched whole; repeated rows count their runs
    again; other input columns are left out.
    """
    vocab = keep(vocabulary(docs, id_col, text_col), "spelling-vocab")
    pairs = near_pairs(vocab)
    scored = pairs.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("_on")), "other")
    best = scored.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("_on")).alias("neg"), F.col("other").alias("w"))).alias("_b"),
    )
    words = vocab.join(best, "word", "left").select(
        "word", "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("_b.neg") >= FORM_FACTOR * F.col("n"), F.col("_b.w")).alias("form"),
        F.when(-F.col("_b.neg") >= FORM_FACTOR * F.col("n"), -F.col("_b.neg")).cast("long").alias("form_n"),
    )
    words = keep(words.withColumn("root", F.coalesce("form", "word")), "spelling-forms")
    # Pointer jumping: root <- root's root until no root has a form; n doubles per form step.
    while True:
        step = words.alias("a").join(
            words.select(F.col("word").alias("_r"), F.col("root").alias("_rr")), F.col("root") == F.col("_r"), "left"
        )
        moved = step.where(F.col("_rr") != F.col("root"))
        if moved.limit(1).count() == 0:
            break
        nxt = keep(step.select("word", "n", "n_near", "form", "form_n", F.coalesce("_rr", "root").alias("root")), "spelling-roots")
        drop_kept(words)
        words = nxt
    return words.select("word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", "form_n")
