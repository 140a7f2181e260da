"""Quality classifier: random-indexing word vectors, a two-layer network, a calibrated temperature.

Every word and every word shape falls into one of a fixed number of hash buckets.  A bucket's
index vector is sparse, random and fixed; its context vector is the sum of the index vectors
seen around its words in the training sample.  A document is the mean of its words' vectors
and of its shapes' vectors.  A network with one hidden layer is fitted on the driver in numpy
on at most ``sample`` labelled documents; a temperature fitted on a part kept aside turns its
output into probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.bpe_automaton import slices
from topicloom.llm.samples import labelled_sample
from topicloom.llm.text import fold, inputs

BUCKETS = 1 << 14
DIM = 64
NONZERO = 4
WINDOW = 2
HIDDEN = 32
EPOCHS = 30
STEPS = 3_000  # gradient steps at least, for small samples
SAMPLE = 12_000
CHUNK = 50_000
# The shape of a word that repeats the one before it.
_REPEATED = BUCKETS + zlib.crc32(b"=") % BUCKETS
_CACHE = 500_000
_SHAPES = (
    (re.compile(rb"[a-z\x80-\xff]+"), b"a"),
    (re.compile(rb"[A-Z]+"), b"A"),
    (re.compile(rb"[0-9]+"), b"0"),
    (re.compile(rb"([^aA0])\1+"), rb"\1\1"),
)


def shape(word: bytes) -> bytes:
    """Letters, capitals and digits each as one sign, runs of another sign as two of it."""
    for pattern, sign in _SHAPES:
        word = pattern.sub(sign, word)
    return word[:12]


class Buckets:
    """Word -> (bucket of the word, bucket of its shape), remembered per task."""

    def __init__(self):
        self._known: dict[bytes, tuple[int, int]] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        known, pairs = self._known, []
        for word in (text or "").encode("utf-8", "surrogatepass").split():
            pair = known.get(word)
            if pair is None:
                if len(known) >= _CACHE:
                    known.clear()
                # Shapes have buckets of their own, above those of the words.
                form = BUCKETS + zlib.crc32(shape(word)) % BUCKETS
                pair = known[word] = (zlib.crc32(word.lower()) % BUCKETS, form)
            pairs.append(pair)
        both = np.array(pairs, dtype=np.int32).reshape(-1, 2)
        words, shapes = both[:, 0], both[:, 1].copy()
        shapes[1:][words[1:] == words[:-1]] = _REPEATED
        return words, shapes


def index_vectors(seed: int = 11) -> np.ndarray:
    """The fixed sparse ternary vector of every bucket."""
    rng = np.random.default_rng(seed)
    out = np.zeros((2 * BUCKETS, DIM), dtype=np.float32)
    places = np.argsort(rng.random((2 * BUCKETS, DIM)), axis=1)[:, :NONZERO]
    signs = rng.integers(0, 2, places.shape) * 2 - 1
    np.put_along_axis(out, places, signs.astype(np.float32), axis=1)
    return out


def word_vectors(sample: DataFrame, parts: int = 8) -> np.ndarray:
    """Unit vectors of all buckets: index vector plus the contexts gathered from the sample.

    ``parts`` tasks each sum a table of fixed size; the tables are added by bucket before one
    of that size reaches the driver.
    """

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, buckets = index_vectors(), Buckets()
        sums = np.zeros((2 * BUCKETS, DIM), dtype=np.float32)
        for batch in batches:
            for text in batch["_text"]:
                for ids in buckets(text):
                    for start in range(0, len(ids), CHUNK):
                        part = ids[start : start + CHUNK]
                        around = np.zeros((len(part), DIM), dtype=np.float32)
                        vectors = index[part]
                        for step in range(1, WINDOW + 1):
                            around[step:] += vectors[:-step]
                            around[:-step] += vectors[step:]
                        np.add.at(sums, part, around)
        used = np.flatnonzero(np.abs(sums).sum(axis=1))
        for some in np.array_split(used, len(used) // 4096 + 1) if len(used) else []:
            yield pd.DataFrame({"bucket": some, "vector": list(sums[some])})

    rows = sample.repartition(parts, "_id").select("_text").mapInPandas(gather, "bucket int, vector array<float>")
    total = rows.groupBy("bucket").agg(
        F.array(*[F.sum(F.get("vector", F.lit(i))) for i in range(DIM)]).alias("vector")
    )
    out = index_vectors()
    table = total.toArrow()
    sums = np.asarray(table["vector"].combine_chunks().flatten(), dtype=np.float64).reshape(-1, DIM)
    out[np.asarray(table["bucket"])] += np.log1p(np.abs(sums)) * np.sign(sums)
    return out / np.linalg.norm(out, axis=1, keepdims=True).clip(1e-9)


def pooled(text: str | None, buckets: Buckets, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, mean shape vector and the logarithm of the length."""
    pieces = []
    for ids in buckets(text):
        total = np.zeros(DIM)
        for start in range(0, len(ids), CHUNK):
            total += vectors[ids[start : start + CHUNK]].sum(axis=0)
        pieces.append(total / max(1, len(ids)))
    return np.concatenate([*pieces, [np.log1p(len(ids))]])


class Network:
    """Two layers, fitted by Adam; ``temperature`` divides the output before the sigmoid."""

    def __init__(self, seed: int = 5):
        self.rng = np.random.default_rng(seed)
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        aside = np.arange(len(y)) % 5 == 0
        if len(set(y[~aside])) < 2 or not aside.any():
            # One class only: the share of ones, pulled to a half where rows are few.
            rate = (y.sum() + 1) / (len(y) + 2)
            self.weights = [np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.log(rate / (1 - rate))]
            return self
        rng, n = self.rng, x.shape[1]
        w = [rng.normal(0, n**-0.5, (n, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)), 0.0]
        first, second, step = [0.0] * 4, [0.0] * 4, 0
        train, target = x[~aside], y[~aside]
        for _ in range(max(EPOCHS, STEPS // (len(target) // 128 + 1))):
            order = rng.permutation(len(target))
            for start in range(0, len(order), 128):
                rows = order[start : start + 128]
                hidden = np.tanh(train[rows] @ w[0] + w[1])
                wrong = (_sigmoid((hidden @ w[2])[:, 0] + w[3]) - target[rows])[:, None] / len(rows)
                back = (wrong @ w[2].T) * (1 - hidden**2)
                grads = [train[rows].T @ back + 1e-3 * w[0], back.sum(0), hidden.T @ wrong + 1e-3 * w[2], wrong.sum()]
                step += 1
                for i, g in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g**2
                    rate = 2e-3 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                    w[i] = w[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
        self.weights = w
        logits = self._logits(x[aside])
        # Never sharper than fitted: a part without errors would ask for no softness at all.
        grid = np.geomspace(1.0, 8.0, 60)
        losses = [np.mean(np.logaddexp(0, logits / t) - y[aside] * logits / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])
        return self

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return (np.tanh(x @ w[0] + w[1]) @ w[2])[:, 0] + w[3]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self._logits((x - self.mean) / self.scale) / self.temperature)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, parts: int = 5, held_out: int = 0,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, Network]:
    """Vectors and network from at most ``sample`` labelled rows outside the held-out fold."""
    chosen = labelled_sample(docs, labels, label_col, sample, parts, held_out, id_col, text_col)
    vectors = word_vectors(chosen)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = Buckets()
        for batch in batches:
            x = [pooled(t, buckets, shared.value) for t in batch["_text"]]
            yield pd.DataFrame({"_id": batch["_id"].astype(str), "_y": batch["_y"], "x": x})

    # At most ``sample`` rows of fixed width, in a fixed order.
    rows = chosen.mapInPandas(features, "_id string, _y double, x array<double>").toArrow().to_pandas().sort_values("_id")
    x = np.array(rows["x"].tolist()).reshape(len(rows), 2 * DIM + 1)
    return vectors, Network().fit(x if len(rows) else np.zeros((1, 2 * DIM + 1)), rows["_y"].to_numpy() if len(rows) else np.zeros(1) + 0.5)


def score(docs: DataFrame, vectors: np.ndarray, network: Network, id_col: str = "doc_id",
          text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The id, ``carry`` columns and ``score`` of every row, whole texts.

    Null and empty texts are pooled as zero vectors and get the network's answer to them;
    null ids and repeated rows are scored like others.
    """
    columns = (id_col, text_col, *[c for c in carry if c not in (id_col, text_col)])
    rows = inputs(docs, **{f"_c{i}": c for i, c in enumerate(columns)})
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, net = shared.value
        buckets = Buckets()
        for batch in batches:
            for start, length in slices(batch.column(1)):
                part = batch.slice(start, length)
                x = np.array([pooled(t, buckets, table) for t in part.column(1).to_pylist()])
                kept = [part.column(i) for i in range(part.num_columns) if i != 1 or text_col in carry]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(net.predict(x))], names=names)

    kept = [f for i, f in enumerate(rows.schema.fields) if i != 1 or text_col in carry]
    names = [*[f.name for f in kept], "score"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", score double"
    out = rows.mapInArrow(run, schema)
    back = {f"_c{i}": c for i, c in enumerate(columns)}
    return out.select(*[F.col(n).alias(back.get(n, n)) for n in names])


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE,
             parts: int = 5, held_out: int = 0) -> DataFrame:
    """Fit and score: doc_id, held_out, score, predicted (1 when the score reaches the threshold).

    Without labels every score is one half.  An empty table of documents gives no rows.
    """
    vectors, network = fit(docs, labels, sample, parts, held_out)
    scored = score(docs, vectors, network)
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), parts) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
