"""Document fingerprints by context-triggered piecewise hashing (CTPH).

A rolling hash over a 7-byte window of the UTF-8 text marks chunk ends where it
falls on ``block - 1`` modulo the block size; every chunk gives one base64 sign,
so the fingerprint is a short string that changes only locally when the text
changes locally.  Two signatures are kept, at the block size ``b`` and at
``2 b``, written ``"b:sig:sig2"``.  The block size starts at ``MIN_BLOCK`` and
doubles until ``b * SIG_LENGTH`` reaches the byte count, then halves while the
signature is shorter than half its length, as usual for CTPH.  The last sign of
a full signature covers all bytes after the earlier ones, so the whole text is
always hashed.

Likeness of two fingerprints: signatures at a common block size (equal, or one
twice the other) are compared by edit distance after runs of more than three
equal signs are cut to three, ``1 - distance / longer length``, or 0 if two
signatures of at least 7 signs share no 7 signs in a row; the better of
the comparable pairs counts, 0 when no block size is shared.  Equal texts have
equal fingerprints and likeness 1.

``fingerprint_edits`` runs this on Spark: the rows are cut into ranges of the
id by quantiles, each range is one window partition in id order, and the first
row of every range is sent as a guest to the range before it, so the next
document of each row is its ``lead`` and the text moves through one shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.text import inputs

# Fixed values of the method.
WINDOW = 7
MIN_BLOCK = 3
SIG_LENGTH = 64
COMMON = 7  # signs two comparable signatures must share in a row
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_MULT = np.uint64(0x01000193)  # per-byte multiplier of the window hash
_MIX = np.uint64(0x9E3779B97F4A7C15)  # spreads window hashes before the modulo test

_POWERS = [np.uint64(int(_MULT) ** k % (1 << 32)) for k in range(WINDOW)]
_MASK32 = np.uint64(0xFFFFFFFF)


def _window_hashes(data: bytes) -> np.ndarray:
    """32-bit polynomial hash of the 7 bytes ending at each position, mixed to 64 bits."""
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
    h = np.zeros(len(b), dtype=np.uint64)
    for k in range(min(WINDOW, len(b))):
        h[k:] += b[: len(b) - k] * _POWERS[k]
    h &= _MASK32
    with np.errstate(over="ignore"):
        return (h + np.uint64(1)) * _MIX


def _signature(mixed: np.ndarray, block: int, length: int) -> str:
    """One sign per chunk; the sign of the last chunk also covers the bytes after it."""
    if len(mixed) == 0:
        return ""
    ends = np.flatnonzero((mixed >> np.uint64(32)) % np.uint64(block) == np.uint64(block - 1))
    ends = ends[: length - 1]
    if len(ends) == 0 or ends[-1] != len(mixed) - 1:
        ends = np.append(ends, len(mixed) - 1)
    starts = np.concatenate(([0], ends[:-1] + 1))
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mixed, starts)
    signs = (sums >> np.uint64(40)) % np.uint64(64)
    return "".join(B64[int(s)] for s in signs)


def fingerprint(text: str | None) -> str:
    """CTPH fingerprint ``"block:sig:sig2"`` of the UTF-8 text; None counts as empty."""
    data = (text or "").encode("utf-8")
    mixed = _window_hashes(data)
    block = MIN_BLOCK
    while block * SIG_LENGTH < len(data):
        block *= 2
    while True:
        sig = _signature(mixed, block, SIG_LENGTH)
        if block > MIN_BLOCK and len(sig) < SIG_LENGTH // 2:
            block //= 2
            continue
        return f"{block}:{sig}:{_signature(mixed, 2 * block, SIG_LENGTH // 2)}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance by the bit-parallel column recurrence (one machine word per column)."""
    if not a:
        return len(b)
    if not b:
        return len(a)
    m = len(a)
    full = (1 << m) - 1
    top = 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | (1 << i)
    pv, mv, score = full, 0, m
    for c in b:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ((ph << 1) | 1) & full
        mh = (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
    return score


def _squeeze(sig: str) -> str:
    out = []
    for c in sig:
        if len(out) >= 3 and out[-1] == out[-2] == out[-3] == c:
            continue
        out.append(c)
    return "".join(out)


def _sig_likeness(a: str, b: str) -> float:
    a, b = _squeeze(a), _squeeze(b)
    if a == b:
        return 1.0
    if min(len(a), len(b)) >= COMMON:
        # Unrelated signatures share no run of COMMON signs; their edit likeness is noise.
        grams = {a[i : i + COMMON] for i in range(len(a) - COMMON + 1)}
        if not any(b[i : i + COMMON] in grams for i in range(len(b) - COMMON + 1)):
            return 0.0
    return 1.0 - edit_distance(a, b) / max(len(a), len(b))


def likeness(f1: str, f2: str) -> float:
    """0 to 1: edit likeness of the signatures at a block size both fingerprints hold."""
    b1, s1, t1 = f1.split(":")
    b2, s2, t2 = f2.split(":")
    b1, b2 = int(b1), int(b2)
    if b1 == b2:
        return max(_sig_likeness(s1, s2), _sig_likeness(t1, t2))
    if b1 == 2 * b2:
        return _sig_likeness(s1, t2)
    if b2 == 2 * b1:
        return _sig_likeness(t1, s2)
    return 0.0


PASSED = ("_id", "n_chars", "edited_sha256")


def _prints(batches):
    for batch in batches:
        own = [fingerprint(t) for t in batch.column("_t").to_pylist()]
        edited = [fingerprint(t) for t in batch.column("_edited").to_pylist()]
        nxt = [fingerprint(t) for t in batch.column("_next").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in PASSED), pa.array(own, pa.string()), pa.array(edited, pa.string()),
             pa.array([likeness(a, b) for a, b in zip(own, edited)], pa.float64()),
             pa.array([likeness(a, b) for a, b in zip(own, nxt)], pa.float64())],
            names=[*PASSED, "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every whole text, of its edited text and their likeness.

    The edited text of a row keeps the first ``n - floor(n/2)`` code points of
    its text and appends the first ``floor(n/2)`` code points (or all) of the
    next row's text, rows ordered by id ascending, nulls last, then by text;
    the last row's next is the first row.  A null text counts as empty.

    Returns one row per input row (repeated rows give equal rows): the id under
    its own name and type, ``n_chars`` (code points), ``edited_sha256``
    (lowercase hex of the edited text in UTF-8), ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` (likeness of the two) and
    ``near_next`` (likeness to the next row's fingerprint), both in [0, 1].  An
    empty table gives an empty result; a single row is its own next; empty and
    very long texts are hashed whole.  Other columns of ``docs`` are left out,
    whatever their names.
    """
    spark = docs.sparkSession
    rows = inputs(docs, _id=id_col, _text=text_col).withColumn("_t", F.coalesce("_text", F.lit("")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    key = F.col("_id").cast("double")
    # Range borders by approximate quantiles of the id: a bounded list, reached by binary search.
    cuts = rows.select(key.alias("_k")).where(F.col("_k").isNotNull())
    probs = [i / parts for i in range(1, parts)]
    borders = sorted(set(cuts.approxQuantile("_k", probs, 0.001))) if probs else []
    splits = [-float("inf"), *(borders or [0.0]), float("inf")]  # the class needs one border at least
    placed = (
        Bucketizer(splits=splits, inputCol="_k", outputCol="_r", handleInvalid="keep")
        .transform(rows.withColumn("_k", key))
        # Null ids sort last: they form a range after all others.
        .withColumn("_r", F.coalesce(F.col("_r").cast("int"), F.lit(len(splits) - 1)))
    )
    order = [F.col("_id").isNull(), F.col("_id"), F.col("_t")]
    # First row of each range, sent as a guest to the range before it (the first range's to the last).
    firsts = placed.groupBy("_r").agg(F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_f"))
    ring = Window.orderBy("_r")
    guests = firsts.select(
        F.coalesce(F.lag("_r").over(ring), F.max("_r").over(Window.partitionBy())).alias("_r"),
        F.lit(1).alias("_guest"),
        F.col("_f.o1").alias("_id"),
        F.col("_f.o2").alias("_t"),
    )
    hosts = placed.select("_r", F.lit(0).alias("_guest"), "_id", "_t")
    within = Window.partitionBy("_r").orderBy("_guest", *order)
    nt = F.lead("_t").over(within)
    linked = (
        hosts.unionByName(guests)
        .withColumn("_next", nt)
        .where(F.col("_guest") == 0)
        .withColumn("n_chars", F.length("_t").cast("long"))
        .withColumn("_h", F.floor(F.col("n_chars") / 2).cast("int"))
    )
    edited = F.concat(
        F.expr("substring(_t, 1, n_chars - _h)"), F.expr("substring(_next, 1, _h)")
    )
    id_type = rows.schema["_id"].dataType.simpleString()
    schema = (
        f"_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    prints = linked.select(
        "_id", "n_chars", F.sha2(edited.cast("binary"), 256).alias("edited_sha256"), "_t",
        edited.alias("_edited"), "_next",
    ).mapInArrow(_prints, schema)
    return prints.withColumnRenamed("_id", id_col)
