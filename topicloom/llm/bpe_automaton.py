"""BPE encoding and decoding with a deterministic tokenization automaton.

The merges are compiled, one gadget after the other, into a deterministic automaton over
tokens that accepts exactly the correctly merged token sequences.  It starts as one state
with a loop for every base symbol.  The gadget of a merge (a, b) -> c splits the state q that
all a-arcs enter: they now enter a copy of q that has no b-arc, and every state with an a-arc
gets a c-arc to where the b-arc led.  All arcs of one label enter the same state, so the
automaton is held as four tables: the state each label enters, and for each state the one it
was copied from, the label removed in the copy and the merge at which it was made.

A pre-split word is encoded left to right: each prefix has exactly one accepted path, whose
last arc is found by following arcs from the states of the shorter prefixes.  Decoding emits
the labels of the arcs.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.text import inputs

# Words kept with their encoding per task; when full, the table is started anew.
CACHE_WORDS = 400_000
BATCH_CHARS = 4_000_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Tables of the automaton; tokens are ids, a token's ``final`` form ends a word."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = "</w>"):
        letters = byte_letters()
        size = max(vocab.values()) + 1
        self.labels = [""] * size
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for text, token in vocab.items():
            self.labels[token] = text
        self.enters = [0] * size  # state that every arc with this label enters
        self.first = [-1] * size  # left part of a merged label
        self.step = [-1] * size  # merge that made the label, -1 for base symbols
        self.copied, self.removed, self.made = [-1], [-1], [-1]
        self._arcs: dict[int, bool] = {}
        live = [token for text, token in vocab.items() if len(text.removesuffix(suffix)) == 1]
        for number, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if self._gadget(number, left, right, whole):
                live.append(whole)
        self._arcs.clear()
        for token in live:
            text = self.labels[token]
            stem = text.removesuffix(suffix)
            raw = bytes(letters[c] for c in stem)
            (self.final if stem != text else self.inner)[raw] = token
        self.longest = max(map(len, [*self.inner, *self.final]))

    def _gadget(self, number: int, left: int, right: int, whole: int) -> bool:
        """Add the merge; False when an earlier merge already keeps the pair apart."""
        state = self.enters[left]
        if not self.has_arc(state, right):
            return False
        self.enters[whole] = state if left == right else self.enters[right]
        self.first[whole], self.step[whole] = left, number
        self.enters[left] = len(self.made)
        self.copied.append(state)
        self.removed.append(right)
        self.made.append(number)
        return True

    def has_arc(self, state: int, label: int) -> bool:
        """Whether ``label`` leaves ``state``.

        A state has a merged label if it was there at the merge and has the left part; older
        labels it has from the state it was copied from, except the removed one.
        """
        path = state
        while path:
            if self.step[label] >= self.made[path]:
                label = self.first[label]
            elif self.removed[path] == label:
                return False
            else:
                path = self.copied[path]
        return True

    def follows(self, before: int, label: int) -> bool:
        """``has_arc`` from the state that ``before`` enters, remembered."""
        key = before << 20 | label
        known = self._arcs.get(key)
        if known is None:
            if len(self._arcs) > 2_000_000:
                self._arcs.clear()
            known = self._arcs[key] = self.has_arc(self.enters[before], label)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """The labels on the accepted path that spells the word."""
        size, longest, follows = len(word), self.longest, self.follows
        last, begin = [0] * (size + 1), [0] * (size + 1)
        for end in range(1, size + 1):
            table = self.final if end == size else self.inner
            for start in range(max(0, end - longest), end):
                token = table.get(word[start:end])
                if token is not None and (start == 0 or follows(last[start], token)):
                    last[end], begin[end] = token, start
                    break
        path, end = [], size
        while end:
            path.append(last[end])
            end = begin[end]
        return path[::-1]


class WordBPE:
    """A tokenizer file of the word kind: its clean-up, its word pattern and its automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.automaton = Automaton(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # White space as in the file's regular expressions.
        self._words = regex.compile(
            split["pattern"]["Regex"].replace(r"[^\s", r"[^\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")
        )
        by_length = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        names = self.automaton.labels + [""] * (max([0, *self.special.values()]) + 1 - len(self.automaton.labels))
        for content, token in self.special.items():
            names[token] = content
        self.names = names
        self._known: dict[str, bytes] = {}

    def _parts(self, text: str) -> Iterator[tuple[str, bytes | None]]:
        at = 0
        for found in self._special.finditer(text) if self._special else ():
            yield text[at : found.start()], np.uint32(self.special[found.group()]).tobytes()
            at = found.end()
        yield text[at:], None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, out = self._known, []
        for part, token in self._parts(text):
            if not unicodedata.is_normalized("NFC", part):
                part = unicodedata.normalize("NFC", part)
            # Letters are lowered one by one: no special form of sigma at a word's end.
            for word in self._words.findall(part.replace("Σ", "σ").lower()):
                ids = known.get(word)
                if ids is None:
                    path = self.automaton.encode_word(word.encode("utf-8", "surrogatepass"))
                    ids = np.array(path, dtype="<u4").tobytes()
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    known[word] = ids
                out.append(ids)
            if token is not None:
                out.append(token)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, joined as the file's missing decoder does: by spaces."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


_SCHEMA = "n_tokens long, ids binary, decoded string"


def encode_decode(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = True,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Encode every text and decode it again: id, carried columns, n_tokens, ids, decoded.

    ``tokenizer``: path of a tokenizer file on the driver; the compiled automaton, whose size
    is fixed by that file, is broadcast.  ``ids`` are little-endian unsigned 32-bit integers.
    Null texts are empty ones: no ids and an empty decoded text.  Null ids, repeated rows and
    very long texts are treated like others; further columns are ignored.
    """
    names = (id_col, text_col, *carry)
    rows = inputs(docs, **{f"_c{i}": c for i, c in enumerate(names)})
    kept = [f for i, f in enumerate(rows.schema.fields) if i != 1]
    model = docs.sparkSession.sparkContext.broadcast(WordBPE(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model.value
        for batch in batches:
            texts = batch.column(1)
            for start, length in slices(texts):
                part = batch.slice(start, length)
                ids = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(i) for i in range(part.num_columns) if i != 1],
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([bpe.decode(x) if decoded else None for x in ids], pa.string()),
                    ],
                    names=[*[f.name for f in kept], "n_tokens", "ids", "decoded"],
                )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    out = rows.mapInArrow(run, f"{schema}, {_SCHEMA}")
    back = {f"_c{i}": c for i, c in enumerate(names)}
    return out.select(*[F.col(n).alias(back.get(n, n)) for n in out.columns])


def slices(texts: pa.Array, limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """(start, length) pieces of a batch with about ``limit`` bytes of text each."""
    ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop - start
        start = stop
