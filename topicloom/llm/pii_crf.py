"""PII: base patterns, and a skip-chain conditional random field that carries their labels on.

The base spans (e-mail, IP, card, phone) come from patterns and checks.  Mentions are the base
spans and weaker forms: numbers without the sign or the check, written-out addresses, the name
part of an address.  They are the nodes of a graph per document: neighbours in the text share
a chain potential, mentions of the same value, however far apart, a skip potential.  Loopy
message passing gives every weak mention a label; base labels are fixed.  The weights are
fitted by pseudo-likelihood on counts from a bounded sample of documents.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.bpe_automaton import slices
from topicloom.llm.text import inputs

# Kinds in the order that breaks ties, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its first digit only: later starts cannot match more.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"(?<![0-9])[0-9](?:[\x20().-]{0,2}[0-9])+")
_NAME = re.compile(r"(?<![\w.%+@-])[A-Za-z0-9._%+-]{5,}(?![\w@%+-])")
_WRITTEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]+)\s?[(\[{]\s?at\s?[)\]}]\s?([A-Za-z0-9-]+(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?[A-Za-z0-9-]+)+)"
)
_DOT = re.compile(r"\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?")
WEAK = ("short_number", "number", "long_number", "written_email", "name_part")
LABELS = ("none", *KINDS)
CLASSES = (*KINDS, *WEAK)
SAMPLE = 4_000
NEAR = 40  # characters between two mentions that are neighbours in the chain
STEADY = 50  # rounds of message passing before damping
SUFFIX = 7  # last digits that make two numbers the same value


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start, then kind; offsets in code points."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                    out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _value(kind: int, mention: str) -> str:
    """What makes two mentions the same: an address, or the last digits of a number."""
    if kind == 0:
        return mention.lower()
    digits = "".join(_DIGIT.findall(mention))
    return digits if kind == 1 else digits[-SUFFIX:]


def weak_mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """(start, class, end, value) of weak mentions that touch no base span and no other one.

    Name parts are looked for only where the document has an address with that name.
    """
    found: list[tuple[int, int, int, str]] = []
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            digits = "".join(_DIGIT.findall(m.group()))
            if SUFFIX <= len(digits) <= 19:
                weak = 0 if len(digits) < 9 else 1 if len(digits) < 12 else 2
                found.append((m.start(), len(KINDS) + weak, m.end(), digits[-SUFFIX:]))
    if "at" in text:
        for m in _WRITTEN.finditer(text):
            found.append((m.start(), CLASSES.index("written_email"), m.end(), f"{m[1]}@{_DOT.sub('.', m[2])}".lower()))
    addresses = sorted({text[s:e].lower() for s, k, e in base if k == 0})
    names = {a.split("@")[0]: a for a in addresses if not a.split("@")[0].isalpha()}
    if names:
        for m in _NAME.finditer(text):
            name = m.group().rstrip(".")
            if name.lower() in names:
                found.append((m.start(), CLASSES.index("name_part"), m.start() + len(name), names[name.lower()]))
    starts, ends, out, done = [], [], [], 0
    for s, _, e in base:  # the union of the base spans
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for item in sorted(found):
        before = bisect.bisect_left(starts, item[2])  # base spans that begin before its end
        if item[0] >= done and (before == 0 or ends[before - 1] <= item[0]):
            done = item[2]
            out.append(item)
    return out


def graph(text: str, base: list[tuple[int, int, int]], weak: list[tuple[int, int, int, str]]):
    """Nodes (start, class, end, value) by start, chain edges and skip edges.

    A mention is linked to the first base mention of each kind of its value, or to the first
    mention where there is no base one: a base label is one step away, and the edges are linear.
    """
    nodes = sorted([*((s, k, e, _value(k, text[s:e])) for s, k, e in base), *weak])
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if 0 <= nodes[i + 1][0] - nodes[i][2] <= NEAR]
    hubs: dict[str, dict[int, int]] = {}
    for i, node in enumerate(nodes):
        if node[1] < len(KINDS):
            hubs.setdefault(node[3], {}).setdefault(node[1], i)
    for i, node in enumerate(nodes):
        hubs.setdefault(node[3], {-1: i})
    skip = [(hub, i) for i, node in enumerate(nodes) for hub in hubs[node[3]].values() if hub != i]
    return nodes, chain, skip


class Field:
    """Weights: a score per mention class and label, and the two agreement potentials."""

    def __init__(self):
        self.unary = np.zeros((len(CLASSES), len(LABELS)))
        self.skip = self.chain = 0.0

    def fit(self, rows: list[tuple[int, int, int, int, float]]) -> Field:
        """Pseudo-likelihood by gradient steps; rows: class, skip label, chain label, label, count.

        Neighbour labels are -1 where there is none.  A prior row per class keeps weights finite.
        """
        rows = [*rows, *((c, -1, -1, 0 if c >= len(KINDS) else c + 1, 5.0) for c in range(len(CLASSES)))]
        c, s, h, y = (np.array([r[i] for r in rows]) for i in range(4))
        n = np.log1p(np.array([r[4] for r in rows], float))
        share = n / n.sum()
        labels = np.arange(len(LABELS))
        skip, chain = (s[:, None] == labels).astype(float), (h[:, None] == labels).astype(float)
        truth = (y[:, None] == labels).astype(float)
        for _ in range(3000):
            z = self.unary[c] + self.skip * skip + self.chain * chain
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            off = (truth - p) * share[:, None]
            step = np.zeros_like(self.unary)
            np.add.at(step, c, off)
            self.unary += 2.0 * (step - 2e-4 * self.unary)
            self.skip += 2.0 * ((off * skip).sum() - 2e-4 * self.skip)
            self.chain += 2.0 * ((off * chain).sum() - 2e-3 * self.chain)
        # Neighbours can only support a label here: a disagreement says nothing about the pair.
        self.skip, self.chain = max(self.skip, 0.0), max(self.chain, 0.0)
        return self

    def marginals(self, nodes, chain, skip) -> np.ndarray:
        """Label probabilities of the nodes by loopy message passing; base nodes are fixed.

        Messages pass until they settle, damped after ``STEADY`` rounds; a path has at most as many
        steps as there are nodes, so no more rounds than that are added.
        """
        size = len(LABELS)
        local = np.exp(self.unary[[node[1] for node in nodes]])
        for i, node in enumerate(nodes):
            if node[1] < len(KINDS):
                local[i] = np.eye(size)[node[1] + 1]
        edges = [(a, b, np.exp(w)) for pairs, w in ((chain, self.chain), (skip, self.skip)) for a, b in pairs]
        if not edges:
            return local / local.sum(1, keepdims=True)
        ends = np.array([(a, b) for a, b, _ in edges] + [(b, a) for a, b, _ in edges])
        same = np.array([w for *_, w in edges] * 2)[:, None]
        back = np.r_[np.arange(len(edges), 2 * len(edges)), np.arange(len(edges))]
        fixed = np.array([node[1] < len(KINDS) for node in nodes])
        sure = fixed[ends[:, 0]]
        sent = np.full((len(ends), size), 1.0 / size)
        for turn in range(STEADY + len(nodes)):
            before = sent
            total = np.log(local + 1e-12)
            np.add.at(total, ends[:, 1], np.log(sent))
            own = total[ends[:, 0]] - np.log(sent[back])
            own[sure] = np.log(local[ends[sure, 0]] + 1e-12)  # however many mentions lean on a base one
            own = np.exp(own - own.max(1, keepdims=True))
            # Potts potential: agreement counts ``same`` times, any other pair once.
            sent = own.sum(1, keepdims=True) + (same - 1) * own
            sent /= sent.sum(1, keepdims=True)
            if turn >= STEADY:
                sent = (sent + before) / 2
            if np.abs(sent - before).max() < 1e-6:
                break
        total = np.log(local + 1e-12)
        np.add.at(total, ends[:, 1], np.log(sent))
        total[fixed] = np.log(local[fixed] + 1e-12)
        out = np.exp(total - total.max(1, keepdims=True))
        return out / out.sum(1, keepdims=True)


def all_spans(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and all spans with those the field adds.

    Without a base span no mention has support: every weak class alone prefers no label.
    """
    base = base_spans(text)
    weak = weak_mentions(text, base) if base else []
    if not weak:
        return base, base
    nodes, chain, skip = graph(text, base, weak)
    p = field.marginals(nodes, chain, skip)
    added = [
        (node[0], int(p[i].argmax()) - 1, node[2])
        for i, node in enumerate(nodes)
        if node[1] >= len(KINDS) and p[i, 0] < 0.5
    ]
    return base, sorted([*base, *added])


def _weakened(kind: int, mention: str) -> int:
    """The weak class that a base mention would have without its sign, check or form."""
    if kind == 0:
        return CLASSES.index("written_email")
    n = len(_DIGIT.findall(mention))
    return len(KINDS) + (0 if n < 9 else 1 if n < 12 else 2)


def training_rows(text: str) -> Counter:
    """Counts of (class, skip label, chain label, label) in a document.

    Base mentions carry their kind.  Each also gives a weakened copy that keeps the label next
    to it, and an address a name part; weak mentions without such a link count as none.
    """
    base = base_spans(text)
    nodes, chain, skip = graph(text, base, weak_mentions(text, base))
    label = [node[1] + 1 if node[1] < len(KINDS) else 0 for node in nodes]
    near, far = [-1] * len(nodes), [-1] * len(nodes)
    for pairs, out in ((chain, near), (skip, far)):
        for a, b in pairs:
            out[a], out[b] = label[b], label[a]
    rows = Counter()
    for i, (start, kind, end, _) in enumerate(nodes):
        if kind < len(KINDS):
            rows[kind, far[i], near[i], label[i]] += 1
            rows[_weakened(kind, text[start:end]), label[i], -1, label[i]] += 1
            if kind == 0:
                rows[CLASSES.index("name_part"), label[i], -1, label[i]] += 1
        elif far[i] <= 0:
            rows[kind, far[i], near[i], 0] += 1
    return rows


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """The field, from counts over at most ``sample`` documents drawn in the order of an id hash."""
    rows = inputs(docs, _id=id_col, _text=text_col)
    drawn = rows.select("_id").where(F.col("_id").isNotNull()).distinct()
    drawn = drawn.orderBy(F.xxhash64("_id"), "_id").limit(sample)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Counter()
        for batch in batches:
            for text in batch["_text"]:
                total.update(training_rows(text or ""))
        yield pd.DataFrame([(*key, float(n)) for key, n in total.items()], columns=list("cshyn"))

    texts = rows.join(F.broadcast(drawn), "_id", "left_semi").select("_text")
    counts = texts.mapInPandas(count, "c int, s int, h int, y int, n double")
    # One row per combination of classes and labels: a few hundred at most.
    merged = counts.groupBy("c", "s", "h", "y").agg(F.sum("n").alias("n")).orderBy("c", "s", "h", "y").collect()
    return Field().fit([tuple(r) for r in merged])


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans as one."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[str, ...] = (), redacted: bool = False) -> DataFrame:
    """id, carried columns, counts of base spans, ``base`` and ``spans`` as text, ``redacted`` text.

    Null texts are empty: no spans, and their redacted text stays null.  Null ids, repeated rows
    and very long texts are treated like others; an empty table gives no rows.
    """
    field = field or fit(docs, id_col=id_col, text_col=text_col)
    names = (id_col, text_col, *carry)
    rows = inputs(docs, **{f"_c{i}": c for i, c in enumerate(names)})
    kept = [f for i, f in enumerate(rows.schema.fields) if i != 1]
    added = ["n_email", "n_ip", "n_card", "n_phone", "base", "spans", "redacted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in slices(batch.column(1)):
                part = batch.slice(start, length)
                texts = part.column(1).to_pylist()
                found = [all_spans(t or "", field) for t in texts]
                counts = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in range(4)]
                clean = [redact(t, every) if redacted and t is not None else None for t, (_, every) in zip(texts, found)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(i) for i in range(part.num_columns) if i != 1],
                        *[pa.array(c, pa.int64()) for c in counts],
                        pa.array([digest(base) for base, _ in found], pa.string()),
                        pa.array([digest(every) for _, every in found], pa.string()),
                        pa.array(clean, pa.string()),
                    ],
                    names=[*[f.name for f in kept], *added],
                )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    schema += ", n_email long, n_ip long, n_card long, n_phone long, base string, spans string, redacted string"
    back = {f"_c{i}": c for i, c in enumerate(names)}
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(back.get(n, n)) for n in out.columns])
