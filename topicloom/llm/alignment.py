"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizations of the same bytes are aligned by their end arrays (the byte
offset where each token ends).  Walking both at once, the current index shift
``d = j - i`` is a diagonal: while ``end_a[i + k] == end_b[i + k + d]`` the
tokens pair one to one.  Such stretches are jumped by exponential probing,
comparing windows of 1, 2, 4, ... ends at the shift and taking the first
mismatch inside the last window.  At a mismatch the irregular group is
resolved locally, advancing whichever end is behind until both end at the same
byte; the shift is then updated and probing resumes.

Where neither tokenizer can have a token across a space that follows another
character, a text is cut there: both tokenizations end at the cut, so those of
the text, its groups and its links are those of its parts, one after the other.
The parts that a worker has not met yet are tokenized and aligned together, as
one run of tokens; what was found for a part is remembered.

On Spark, every document is tokenized and aligned in one Arrow pass; the
per-document link counts per (A id, B id) are summed corpus-wide by a grouped
aggregation with map-side combine, the best count per B id by a second small
aggregation, and both return to the documents through a salted join, so that
a very common pair (a third of all links) spreads over ``SALTS`` tasks.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.bpe_automaton import slices
from topicloom.llm.text import inputs
from topicloom.workspace import keep

# Files of the two tokenizers (parameters) and the salt count of the count join.
A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
SALTS = 16
CHUNK = 400_000  # bytes of text tokenized at once: bounds the encodings a Python worker holds
# Parts a worker remembers; when half of them are new, those not met since are forgotten.  Longer
# parts are not kept.
CACHE_PARTS = 300_000
LONGEST_KEPT = 64
LINE = 50  # parts that A encodes at once
# A space after another character, unless only white space follows: there a text is cut.
CUT = re.compile(r"(?<=\S) (?=\s*\S)")


def byte_level_table() -> dict[str, int]:
    """Inverse of the byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    other 68 bytes for the code points from 256 upwards, in byte order."""
    plain = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    table, extra = {}, 0
    for b in range(256):
        if b in plain:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def piece_bytes(piece: str) -> bytes:
    """A sentence piece as bytes: U+2581 is a space, ``<0xHH>`` is the byte HH."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode("utf-8")


def _flat(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All token byte strings in one array, with each id's start and length."""
    lengths = np.array([len(x) for x in pieces], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.frombuffer(b"".join(pieces), dtype=np.uint8), starts, lengths


def _cuts_a(path: str) -> bool:
    """Whether A's file has nothing that joins characters across a space after another character:
    words of the byte-level pattern, no normalizer, plain merges, no added token that stays whole."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    words, model = spec["pre_tokenizer"] or {}, spec["model"]
    return (
        spec["normalizer"] is None
        and words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space", True)
        and model["type"] == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix") and all(t["special"] for t in spec["added_tokens"])
    )


def _cuts_b(model: bytes) -> bool:
    """The same of B's model: merges without normalization, no piece with a space after another character."""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:
        return False
    spec = sentencepiece_model_pb2.ModelProto.FromString(model)
    trainer, normalizer = spec.trainer_spec, spec.normalizer_spec
    return (
        trainer.model_type == trainer.BPE and not trainer.treat_whitespace_as_suffix
        and not normalizer.precompiled_charsmap and normalizer.add_dummy_prefix
        and normalizer.escape_whitespaces and not normalizer.remove_extra_whitespaces
        and not any(p.type == p.USER_DEFINED or re.search("[^▁]▁", p.piece) for p in spec.pieces)
    )


class Tokenizers:
    """Both tokenizers with the byte string of every id, loaded once per Python worker."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        table = byte_level_table()
        self.a_bytes = [
            bytes(table[c] for c in (self.a.id_to_token(i) or "")) for i in range(self.a.get_vocab_size())
        ]
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        top = max(len(self.a_bytes), len(self.b_bytes))
        self.decimal = _flat([str(i).encode() for i in range(top)])  # ids as decimal text
        self.a_len, self.b_len = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        self.cuts = _cuts_a(a_path) and _cuts_b(self.b.serialized_model_proto())
        self._known: dict[str, tuple | None] = {}
        self._before: dict[str, tuple | None] = {}

    def _encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        # The fast variant skips offsets; the ids are the same.
        encoded_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        encoded_b = self.b.encode(texts, num_threads=1)
        out, a_of, b_of = [], self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for text, ea, b in zip(texts, encoded_a, encoded_b):
            want, a = (" " + text).encode("utf-8"), ea.ids
            whole = text and b"".join(map(a_of, a)) == want and b"".join(map(b_of, b)) == want
            out.append((a, b) if whole else None)
        return out

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(A ids, B ids) per text, or None where a text is empty or either tokenization
        does not join to exactly space + text."""
        return [
            pair and (np.array(pair[0], dtype=np.int64), np.array(pair[1], dtype=np.int64)) for pair in self._encoded(texts)
        ]

    def documents(self, texts: list[str]) -> list[tuple | None]:
        """Figures, digest and links per text (see ``document``), or None where ``tokens`` gives none."""
        cut = [CUT.split(t) if self.cuts and t else [t] for t in texts]
        if len(self._known) >= CACHE_PARTS // 2:
            self._known, self._before = {}, self._known
        known, before = self._known, self._before
        new = set(chain.from_iterable(cut)).difference(known)
        met = new.intersection(before)
        known.update((part, before[part]) for part in met)
        new = list(new - met)
        if new:
            known.update(zip(new, aligned_parts(self, *(self._joined(new) or self._single(new)))))
        out = [document([known[part] for part in parts]) for parts in cut]
        for part in new:
            if len(part) > LONGEST_KEPT:
                del known[part]
        return out

    def _single(self, parts: list[str]):
        """Whether each part joins back, and of those that do all A and B ids and their numbers per part."""
        pairs = self._encoded(parts)
        whole = [p for p in pairs if p]
        return (
            [bool(p) for p in pairs],
            np.array([x for p in whole for x in p[0]], dtype=np.int64),
            np.array([x for p in whole for x in p[1]], dtype=np.int64),
            np.array([len(p[0]) for p in whole], dtype=np.int64),
            np.array([len(p[1]) for p in whole], dtype=np.int64),
        )

    def _joined(self, parts: list[str]):
        """As ``_single``, but A encodes ``LINE`` parts as one text; None where that cannot be told apart
        into the parts or a part does not join back."""
        if not self.cuts or not all(p and not p[-1].isspace() for p in parts):
            return None
        lines = [" " + " ".join(parts[i : i + LINE]) for i in range(0, len(parts), LINE)]
        of_a = [e.ids for e in self.a.encode_batch_fast(lines, add_special_tokens=False)]
        of_b = self.b.encode(parts, num_threads=1)
        want = "".join(lines).encode("utf-8")
        if b"".join(map(self.a_bytes.__getitem__, chain.from_iterable(of_a))) != want:
            return None
        if b"".join(map(self.b_bytes.__getitem__, chain.from_iterable(of_b))) != want:
            return None
        a = np.array(list(chain.from_iterable(of_a)), dtype=np.int64)
        b = np.array(list(chain.from_iterable(of_b)), dtype=np.int64)
        sizes = list(map(len, parts)) if len(want) == sum(map(len, lines)) else [len(p.encode("utf-8")) for p in parts]
        ends = np.cumsum(np.array(sizes, dtype=np.int64) + 1)
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        last_a, last_b = np.searchsorted(ends_a, ends), np.cumsum(list(map(len, of_b)), dtype=np.int64) - 1
        if not np.array_equal(ends_a[last_a], ends) or not np.array_equal(ends_b[last_b], ends):
            return None
        return [True] * len(parts), a, b, np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)


@cache
def _loaded(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group borders of two end arrays: per group the exclusive end index in A and in B.

    Both arrays rise strictly and end at the same offset.  Groups are cut where
    an A token and a B token end at the same byte.  One-to-one stretches along
    the current diagonal are found by exponential probing (slices of the end
    lists compared at the shift, windows doubling); an irregular group is
    closed locally by advancing the end that lies behind.  Plain lists: the
    stretches are short, so list slices beat array calls.
    """
    ea, eb = ends_a.tolist(), ends_b.tolist()
    na, nb = len(ea), len(eb)
    a_cut: list[int] = []
    b_cut: list[int] = []
    i = j = 0
    while i < na and j < nb:
        run, step = 0, 1
        while True:
            stop = min(step, na - i, nb - j)
            if ea[i + run : i + stop] != eb[j + run : j + stop]:
                while ea[i + run] == eb[j + run]:
                    run += 1
                break
            run = stop
            if stop < step:
                break
            step *= 2
        if run:
            a_cut.extend(range(i + 1, i + run + 1))
            b_cut.extend(range(j + 1, j + run + 1))
            i, j = i + run, j + run
        if i >= na or j >= nb:
            break
        # Irregular group, resolved locally; the shift j - i changes with it.
        x, y = ea[i], eb[j]
        while x != y:
            if x < y:
                i += 1
                x = ea[i]
            else:
                j += 1
                y = eb[j]
        i, j = i + 1, j + 1
        a_cut.append(i)
        b_cut.append(j)
    return np.array(a_cut, dtype=np.int64), np.array(b_cut, dtype=np.int64)


def groups_of(a_cut: np.ndarray, b_cut: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The groups as ``(a_lo, a_hi, b_lo, b_hi)`` index ranges."""
    a_lo = np.concatenate(([0], a_cut[:-1]))
    b_lo = np.concatenate(([0], b_cut[:-1]))
    return list(zip(a_lo.tolist(), a_cut.tolist(), b_lo.tolist(), b_cut.tolist()))


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (A, B) of overlapping tokens: one per piece between consecutive ends of either."""
    union = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, union), np.searchsorted(ends_b, union)


def groups_text(
    a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, decimal
) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3``: per group its A ids, then its B ids, in token order; and where each group ends.

    The ids are written by gathering their decimal text from ``decimal`` (see ``_flat``).
    """
    ga = np.searchsorted(a_cut, np.arange(len(a)), side="right")
    gb = np.searchsorted(b_cut, np.arange(len(b)), side="right")
    b_before = np.concatenate(([0], b_cut[:-1]))
    seq = np.empty(len(a) + len(b), dtype=np.int64)
    seq[b_before[ga] + np.arange(len(a))] = a
    seq[a_cut[gb] + np.arange(len(b))] = b
    data, starts, lengths = decimal
    lens = lengths[seq]
    start = np.cumsum(lens + 1) - (lens + 1)  # of each id in the text
    out = np.full(int(lens.sum()) + len(seq), ord(","), dtype=np.uint8)
    inner = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    out[np.repeat(start, lens) + inner] = data[np.repeat(starts[seq], lens) + inner]
    after = start + lens  # separator after each id
    ends = after[a_cut + b_cut - 1]
    out[after[a_cut + b_before - 1]] = ord("|")
    out[ends] = ord(";")
    return out[:-1].tobytes(), ends


def aligned_parts(
    tok: Tokenizers, whole: list[bool], a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray
) -> list[tuple | None]:
    """Per part of a text: the numbers of its A tokens, B tokens and groups, the text of its groups and its
    links as packed keys (A id above B id); None where a part does not join back.

    ``a`` and ``b`` are the ids of all other parts, ``na`` and ``nb`` their numbers per part.  They
    are aligned in one walk: both tokenizations end where a part ends.
    """
    if not len(a):
        return [None] * len(whole)
    ends_a, ends_b = np.cumsum(tok.a_len[a]), np.cumsum(tok.b_len[b])
    a_cut, b_cut = align(ends_a, ends_b)
    pa_, pb_ = links(ends_a, ends_b)
    keys = (a[pa_] * (1 << 20) + b[pb_]).tobytes()
    text, group_ends = groups_text(a, b, a_cut, b_cut, tok.decimal)
    last = np.cumsum(na)
    groups = np.searchsorted(a_cut, last) + 1
    key_ends = (8 * np.searchsorted(pa_, last)).tolist()
    text_ends = group_ends[groups - 1].tolist()
    found = zip(
        na.tolist(), nb.tolist(), np.diff(groups, prepend=0).tolist(),
        [text[x:y] for x, y in zip([0] + [e + 1 for e in text_ends], text_ends)],
        [keys[x:y] for x, y in zip([0] + key_ends, key_ends)],
    )
    return [next(found) if ok else None for ok in whole]


def document(parts: list[tuple | None]):
    """Per-document figures, digest and the link multiset as (A id, B id, count) arrays, from its parts."""
    if None in parts:
        return None
    na, nb, groups, texts, keys = zip(*parts)
    packed = np.frombuffer(b"".join(keys), dtype=np.int64)
    uniq, mult = np.unique(packed, return_counts=True)
    digest = hashlib.sha256(b";".join(texts)).hexdigest()
    return sum(na), sum(nb), sum(groups), len(packed), digest, uniq >> 20, uniq & ((1 << 20) - 1), mult


EMPTY = np.zeros(0, dtype=np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    """One Arrow list per document, built from the numpy arrays without Python ints."""
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    values = np.concatenate(parts).astype(np.int64) if parts else EMPTY
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _slices(batches):
    for whole in batches:
        for start, length in slices(whole.column("_text"), CHUNK):
            yield whole.slice(start, length)


def _aligned(a_path: str, b_path: str):
    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tok = _loaded(a_path, b_path)
        for batch in _slices(batches):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            cols = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_la", "_lb", "_lm")}
            for figures in tok.documents(texts):
                for k, v in zip(cols, figures or (0, 0, 0, 0, "", EMPTY, EMPTY, EMPTY)):
                    cols[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_row")]
                + [pa.array(cols[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                + [pa.array(cols["groups_sha256"], pa.string())]
                + [_lists(cols[k]) for k in ("_la", "_lb", "_lm")],
                names=["_id", "_row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_la", "_lb", "_lm"],
            )

    return run


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Align the tokenizations A (``a_path``, of space + text) and B (``b_path``) of every text.

    Returns one row per input row: the id under its name and type, ``n_a``,
    ``n_b``, ``n_groups``, ``n_links`` (A-B token pairs with overlapping bytes),
    ``n_best`` (links whose (A, B) pair has the highest corpus-wide link count
    among pairs of its B id, ties included), ``count_sum`` (corpus-wide counts
    of the doc's links, summed) and ``groups_sha256`` (sha-256 of
    ``a1,a2|b1;a3|b2,b3``).  Null, empty and texts that a tokenizer cannot join
    back byte for byte get zeros and ``''``; repeated rows count as separate
    documents (their links count twice); very long texts are aligned whole; an
    empty table gives an empty result; other columns are left out.
    """
    rows = inputs(docs, _id=id_col, _text=text_col).withColumn("_row", F.monotonically_increasing_id())
    id_type = rows.schema["_id"].dataType.simpleString()
    schema = (
        f"_id {id_type}, _row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "_la array<long>, _lb array<long>, _lm array<long>"
    )
    aligned = keep(rows.mapInArrow(_aligned(a_path, b_path), schema), "aligned")
    links = aligned.select(
        "_row", F.explode(F.arrays_zip(F.col("_la").alias("a"), F.col("_lb").alias("b"), F.col("_lm").alias("m"))).alias("l")
    ).select("_row", F.col("l.a").alias("_a"), F.col("l.b").alias("_b"), F.col("l.m").alias("_m"))
    counts = links.groupBy("_a", "_b").agg(F.sum("_m").alias("_count"))
    best = counts.groupBy("_b").agg(F.max("_count").alias("_top"))
    pairs = (
        counts.join(best, "_b")
        .select("_a", "_b", "_count", (F.col("_count") == F.col("_top")).alias("_best"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    per_row = (
        links.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int"))
        .join(pairs, ["_a", "_b", "_salt"])
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("_best"), F.col("_m")).otherwise(0)).alias("n_best"),
            F.sum(F.col("_m") * F.col("_count")).alias("count_sum"),
        )
    )
    return aligned.join(per_row, "_row", "left").select(
        F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
