"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities (per word) of a lexicon given by hand and of one learned
from labelled texts, the nearness of lexicon words to second-person words, and the rates of
capitals, punctuation and obfuscated spellings.  The lexicon comes from one part
of at most ``sample`` labelled documents, trees and calibration from another, in numpy on the
driver; documents are scored in Arrow batches, whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.bpe_automaton import slices
from topicloom.llm.samples import labelled_sample
from topicloom.llm.text import fold, inputs, words_of

SAMPLE = 20_000
LEXICON = 150
TREES = 80
DEPTH = 3
BINS = 32
RATE = 0.2
# Common insults and second-person words of the four languages.
INSULTS = (
    "idiot idiots stupid moron morons scum trash garbage loser losers pathetic disgusting worthless "
    "clown fool dumb imbecile jerk vermin filth creep dummkopf trottel abschaum versager widerlich "
    "imbécile crétin ordure minable débile estúpido idiota basura imbécil asqueroso"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr tu toi ton ta tes vous votre usted tú tuyo ustedes".split()
_LEET = str.maketrans("013457@$!", "oieastasi")
_EDGE = re.compile(r"^[^\w@$*]+|[^\w@$*]+$")
_RUN = re.compile(r"(.)\1{2,}")
_MASKED = re.compile(r"\w[*@$#!_.\-]+\w")
# Bits of a word's code.
_LEARNED, _GIVEN, _PERSON, _CAPS, _PUNCT, _OBFUSCATED, _STRONG = (1 << i for i in range(7))


def plain(word: str) -> str:
    """A word in lower case without punctuation at its ends."""
    return _EDGE.sub("", word.lower())


class Features:
    """Dense features of a text; the code of each word is remembered per task."""

    NAMES = (
        "learned", "strong", "given", "person", "caps", "punct", "obfuscated", "near_person",
        "learned_count", "given_count", "strong_count", "length", "exclamations",
    )

    def __init__(self, lexicon: dict[str, float]):
        self.learned = lexicon
        self.strong = {w for w, odds in lexicon.items() if odds >= 3.0}
        self.given, self.person = set(INSULTS), set(SECOND_PERSON)
        self._known: dict[str, int] = {}

    def _code(self, word: str) -> int:
        base = plain(word)
        code = 0
        forms = {base}
        if _MASKED.search(base) or base.translate(_LEET) != base or _RUN.search(base):
            joined = re.sub(r"[*#_.\-]", "", base)
            forms |= {base.translate(_LEET), joined.translate(_LEET), _RUN.sub(r"\1", base)}
            if any(c.isalpha() for c in base):
                code |= _OBFUSCATED
        for forms_of, bit in ((self.learned, _LEARNED), (self.given, _GIVEN), (self.strong, _STRONG)):
            if any(f in forms_of for f in forms):
                code |= bit
        if base in self.person:
            code |= _PERSON
        if len(word) > 1 and word.isupper():
            code |= _CAPS
        if word[-1] in "!?*$%&#":
            code |= _PUNCT
        return code

    def __call__(self, text: str | None) -> np.ndarray:
        known, codes = self._known, []
        for word in (text or "").encode("utf-8", "surrogatepass").split():
            code = known.get(word)
            if code is None:
                if len(known) >= 500_000:
                    known.clear()
                code = known[word] = self._code(word.decode("utf-8", "replace"))
            codes.append(code)
        codes = np.array(codes, dtype=np.int64)
        n = max(1, len(codes))
        rates = [np.count_nonzero(codes & bit) for bit in
                 (_LEARNED, _STRONG, _GIVEN, _PERSON, _CAPS, _PUNCT, _OBFUSCATED)]
        hits, people = (np.flatnonzero(codes & bits) for bits in (_LEARNED | _GIVEN, _PERSON))
        near = 0
        if len(hits) and len(people):
            right = np.searchsorted(people, hits)
            gaps = np.minimum(
                np.abs(hits - people[np.minimum(right, len(people) - 1)]),
                np.abs(hits - people[np.maximum(right - 1, 0)]),
            )
            near = np.count_nonzero(gaps <= 5)
        return np.array(
            [*(r / n for r in rates), near / n, rates[0], rates[2], rates[1], np.log1p(len(codes)),
             (text or "").count("!") / n]
        )


def learn_lexicon(sample: DataFrame, size: int = LEXICON, least: int = 4) -> dict[str, float]:
    """Words much likelier in texts labelled 1, with their log odds: at most ``size`` of them."""
    word = F.lower(F.regexp_replace("w", r"^[^\p{L}\p{N}@$*]+|[^\p{L}\p{N}@$*]+$", ""))
    seen = sample.select("_y", F.explode(F.array_distinct(words_of(F.lower("_text")))).alias("w"))
    counts = seen.select("_y", word.alias("w")).where("w != ''").groupBy("w").agg(
        F.sum("_y").alias("ones"), F.count("*").alias("n")
    )
    total = sample.agg(F.coalesce(F.sum("_y"), F.lit(0.0)), F.count("*")).first()
    ones, zeros = total[0], total[1] - total[0]
    if not ones or not zeros:
        return {}
    odds = F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((F.col("n") - F.col("ones") + 0.5) / (zeros + 1))
    best = counts.where(F.col("ones") >= least).withColumn("odds", odds).where(F.col("odds") >= 1.5)
    rows = best.orderBy(F.col("odds").desc(), "w").limit(size).select("w", "odds").collect()
    return {r["w"]: r["odds"] for r in rows}


class Trees:
    """Boosted regression trees on binned features, logistic loss."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        rate = (y.sum() + 1) / (len(y) + 2)
        self.base, self.trees = float(np.log(rate / (1 - rate))), []
        grid = np.linspace(0, 1, BINS + 1)[1:-1]
        # Zeros are often most of a column: cuts come from the other values, and one at zero.
        self.cuts = [
            np.unique(np.r_[1e-12, np.quantile(c[c > 0], grid)]) if (c > 0).any() else np.array([1e-12])
            for c in x.T
        ]
        bins = self._bins(x)
        out = np.full(len(y), self.base)
        for _ in range(TREES if 0 < y.sum() < len(y) else 0):
            p = 1 / (1 + np.exp(-out))
            tree = self._grow(bins, y - p, np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            out += self._one(tree, bins)
        return self

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, x.T)], axis=1)

    def _grow(self, bins, grad, hess):
        """Arrays (feature, bin, value) of a full tree of ``DEPTH`` levels, in heap order."""
        nodes = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.zeros(nodes, int), np.full(nodes, BINS + 1), np.zeros(nodes)
        at = np.zeros(len(grad), int)
        for node in range(nodes):
            here = np.flatnonzero(at == node)
            g, h = grad[here].sum(), hess[here].sum()
            value[node] = RATE * g / (h + 1.0)
            if node >= nodes // 2 or len(here) < 8:
                continue
            best = 1e-6
            for f in range(bins.shape[1]):
                b = bins[here, f]
                gs = np.cumsum(np.bincount(b, grad[here], BINS + 2))
                hs = np.cumsum(np.bincount(b, hess[here], BINS + 2))
                gain = gs**2 / (hs + 1.0) + (g - gs) ** 2 / (h - hs + 1.0) - g**2 / (h + 1.0)
                gain[(hs < 0.2) | (h - hs < 0.2)] = 0
                if gain.max() > best:
                    best, feature[node], cut[node] = gain.max(), f, int(gain.argmax())
            if best > 1e-6:
                at[here] = 2 * node + 1 + (bins[here, feature[node]] > cut[node])
        return feature, cut, value

    @staticmethod
    def _one(tree, bins):
        feature, cut, value = tree
        at = np.zeros(len(bins), int)
        rows = np.arange(len(bins))
        for _ in range(DEPTH):
            # A cut beyond all bins marks a leaf; its rows stay.
            leaf = cut[at] > BINS
            at = np.where(leaf, at, 2 * at + 1 + (bins[rows, feature[at]] > cut[at]))
        return value[at]

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        return sum((self._one(t, bins) for t in self.trees), np.full(len(x), self.base))


class Isotonic:
    """Monotone step function by pooling adjacent violators, interpolated between the steps.

    Each pool is pulled a little to the overall rate, so that no score is exactly 0 or 1.
    """

    def fit(self, raw: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(raw, kind="stable")
        prior = (y.sum() + 1) / (len(y) + 2)
        pools: list[list[float]] = []
        values, starts = np.unique(raw[order], return_index=True)
        for value, part in zip(values, np.split(y[order], starts[1:]) if len(values) else []):
            pools.append([part.sum(), len(part), value, value])
            while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
                s, n, _, high = pools.pop()
                pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], high]
        self.x = np.array([v for p in pools for v in (p[2], p[3])]) if pools else np.zeros(1)
        level = [(p[0] + prior) / (p[1] + 1) for p in pools] or [prior]
        self.y = np.maximum.accumulate(np.repeat(level, 2 if pools else 1))
        return self

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.x, self.y)


class Model:
    """Lexicon, trees and calibration."""

    def __init__(self, lexicon: dict[str, float], trees: Trees, calibration: Isotonic):
        self.lexicon, self.trees, self.calibration = lexicon, trees, calibration

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.calibration(self.trees.raw(x))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, parts: int = 3, held_out: int = 1,
        label_col: str = "toxic") -> Model:
    """Lexicon from two fifths of the sample, trees and calibration from the rest.

    The calibration sees scores of trees that were fitted without the row (three folds).
    """
    chosen = labelled_sample(docs, labels, label_col, sample, parts, held_out)
    part = F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(10))
    lexicon = learn_lexicon(chosen.where(part < 4))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Features(lexicon)
        for batch in batches:
            out = batch[["_y"]].assign(_id=batch["_id"].astype(str), x=[of(t) for t in batch["_text"]])
            yield out[["_id", "_y", "x"]]

    # At most ``sample`` rows of fixed width, in a fixed order.
    rows = chosen.where(part >= 4).mapInPandas(features, "_id string, _y double, x array<double>").toPandas()
    rows = rows.sort_values("_id")
    x = np.array(rows["x"].tolist()).reshape(len(rows), len(Features.NAMES))
    y = rows["_y"].to_numpy(dtype=float)
    fold_of, raw = np.arange(len(y)) % 3, np.zeros(len(y))
    for number in range(3):
        out = fold_of == number
        raw[out] = Trees().fit(x[~out], y[~out]).raw(x[out])
    return Model(lexicon, Trees().fit(x, y), Isotonic().fit(raw, y))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``score`` of every row.

    Null and empty texts have zero features and get the model's answer to them; null ids and
    repeated rows are scored like others; further columns are ignored.
    """
    rows = inputs(docs, _id=id_col, _text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        of = Features(fitted.lexicon)
        for batch in batches:
            for start, length in slices(batch.column(1)):
                x = np.array([of(t) for t in batch.column(1).slice(start, length).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, length), pa.array(fitted.predict(x))], names=["_id", "score"]
                )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE,
             parts: int = 3, held_out: int = 1) -> DataFrame:
    """Fit and score: doc_id, held_out, score, predicted (1 when the score reaches the threshold).

    Without labels every score is one half.  An empty table of documents gives no rows.
    """
    scored = score(docs, fit(docs, labels, sample, parts, held_out))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), parts) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
