"""N-gram Jaccard join by universe partition and pigeonhole, exact, without all pairs in a group.

A document is the set of its distinct five-word shingles, as 64-bit hashes.  Two sets of sizes
a <= b are linked at similarity t when their difference has at most H = (a + b)(1-t)/(1+t)
elements.  Sizes fall into bands in which b exceeds a by 1/t at most.  The scheme of a band cuts
the universe of hashes into segments with capacities 1 or 2 that sum to H + 1 + slack: by the
pigeonhole principle linked sets agree on a whole segment of capacity 1, or differ by at most
one element in a segment of capacity 2.  The index therefore holds a key per segment subset, and
for capacity 2 also a key for each of its one-deletion subsets.  How many segments have which
capacity is chosen by the number of keys and the chance of too little slack.

Subsets too thin to be told apart (empty ones) have no key.  The slack covers up to ``slack``
of them; a document with more also enters a second universe partition with another salt, and so
on.  A pair is found in the first partition in which one of the two fits the slack.

Groups of documents sharing a key are not expanded: each document is first verified against one
hub, the pairs still apart after that are verified where they share a key.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.bpe_automaton import slices
from topicloom.llm.graph import components
from topicloom.llm.text import inputs
from topicloom.workspace import drop_kept, keep, small

N = 5
# Similarity 0.8 as whole numbers: 100 * intersection >= 80 * union.
PERCENT = 80
SALTS = 8
PIECE = 1 << 20  # bytes of a text whose words are hashed at once
FLUSH = 1_000_000  # keys a task holds before it sends them off
WEAK_PRICE = 8.0
KEY_BYTES = 5  # of a key within its bucket; a chance collision is only one more candidate
HOT = 64  # documents of one flush with the same key from which they are sent as a group
LEAST_BITS = 1024  # of the bitmap kept per document
_SPACE = re.compile(rb"[ \t-\r]")
_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Pieces of a long text, cut at white space: they bound the arrays of ``word_hashes``."""
    start = 0
    while start < len(raw):
        cut = _SPACE.search(raw, start + PIECE)
        stop = cut.start() if cut else len(raw)
        yield raw[start:stop]
        start = stop


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of every word: its bytes, each mixed with its place in the word, summed and mixed."""
    data = np.frombuffer(raw, dtype=np.uint8)
    at = np.flatnonzero((data != 32) & (data - np.uint8(9) > 4))  # below 9 wraps around
    if not len(at):
        return np.zeros(0, dtype=np.uint64)
    new = np.ones(len(at), dtype=bool)
    np.not_equal(at[1:], at[:-1] + 1, out=new[1:])
    first = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
    return mix(np.add.reduceat(mix((place.astype(np.uint64) << np.uint64(8) | data[at]) + _P), first))


class Shingles:
    """Text -> sorted distinct shingle hashes."""

    def __call__(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8", "surrogatepass").lower()
        h = np.concatenate([np.zeros(0, dtype=np.uint64), *map(word_hashes, _pieces(raw))])
        if not len(h):
            return h
        if len(h) < N:
            # The whole sequence is one shingle, told apart by its length.
            total = np.array([len(h)], dtype=np.uint64)
            for value in h:
                total = mix(total * _P + value)
            return total
        total = np.full(len(h) - N + 1, N, dtype=np.uint64)
        for i in range(N):
            total = total * _P + h[i : len(h) - N + 1 + i]
        total = np.sort(mix(total))
        return total[np.concatenate([[True], total[1:] != total[:-1]])]


class Scheme:
    """Universe partition for pairs whose smaller set lies in ``[low, high]``."""

    def __init__(self, number: int, low: int, high: int, percent: int):
        self.number, self.most = number, 100 * high // percent
        self.differ = (100 - percent) * (high + self.most) // (100 + percent)
        best = None
        # Large sets gain nothing from deletions; for small ones every split is priced.
        choices = range((self.differ + 2) // 2 + 1) if self.differ < 60 else (0,)
        for pairs in choices:
            for slack in range(0, 8 + self.differ // 4):
                singles = self.differ + 1 + slack - 2 * pairs
                if singles >= 0:
                    cost = self._cost(low, high, singles, pairs, slack)
                    if best is None or cost < best[0]:
                        best = (cost, singles, pairs, slack)
        _, self.singles, self.pairs, self.slack = best

    @staticmethod
    def _cost(low: int, high: int, singles: int, pairs: int, slack: int) -> float:
        """Expected keys of a set, partitions it enters included, plus a price on weak keys.

        A subset of one element is weak: it is shared by every text that quotes one passage.
        """
        if singles + pairs == 1:
            return 1 + pairs * high + WEAK_PRICE * (high <= 1 + pairs)
        each = (low + high) / 2 / (singles + 2 * pairs)  # elements per segment of capacity 1
        weak = singles * each * math.exp(-each) + pairs * (2 * each) ** 2 * math.exp(-2 * each)
        number = singles + pairs * (1 + 2 * each)
        # Too few filled segments is likeliest for the smallest sets of the band.
        least = low / (singles + 2 * pairs)
        p1, p2 = math.exp(-least), math.exp(-2 * least) * (1 + 2 * least)
        thin, spread = singles * p1 + 2 * pairs * p2, singles * p1 + 4 * pairs * p2
        over = 0.5 * math.erfc((slack + 0.5 - thin) / math.sqrt(2 * spread + 1e-9))
        return (number + WEAK_PRICE * weak) / max(1e-9, 1 - over)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """All keys of a set of the scheme's sizes."""
        out = []
        for salt in range(SALTS):
            tag = np.uint64((self.number * SALTS + salt + 1) * int(_P) % (1 << 64))
            place = mix(hashes ^ tag)
            # Segments of capacity 2 are twice as wide.
            parts = self.singles + 2 * self.pairs
            cell = ((place >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            seg = np.where(cell < self.singles, cell, self.singles + (cell - self.singles) // 2)
            # Sorting 16-bit numbers is much faster, and nearly all schemes fit.
            short = seg.astype(np.uint16) if self.singles + self.pairs < 1 << 16 else seg
            order = np.argsort(short, kind="stable")
            seg, value = seg[order], place[order]
            first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            sums = np.add.reduceat(value, first)
            ids = seg[first]
            out.append(mix(sums + mix(ids.astype(np.uint64) + tag)))
            counts = np.diff(np.r_[first, len(seg)])
            deletable = (ids >= self.singles) & (counts > 1)
            if deletable.any():
                which = np.repeat(np.arange(len(first)), counts)
                take = deletable[which]
                rest = sums[which[take]] - value[take]
                out.append(mix(rest + mix(ids[which[take]].astype(np.uint64) + tag)))
            filled = np.zeros(self.singles + self.pairs, dtype=np.int64)
            filled[ids] = counts
            thin = np.count_nonzero(filled[: self.singles] == 0) + 2 * np.count_nonzero(filled[self.singles :] <= 1)
            if thin <= self.slack or (self.singles + self.pairs == 1 and (self.singles or len(hashes) > 1)):
                break
        else:
            # Thin in every partition: those few documents share one key of the scheme.
            out.append(np.array([mix(np.array([self.number + 1], dtype=np.uint64))[0] ^ _M2], dtype=np.uint64))
        return np.concatenate(out)


@lru_cache(maxsize=None)
def bands(percent: int, number: int) -> tuple[int, int]:
    """(first size of the band, first size of the next one)."""
    low = 1 if number == 0 else bands(percent, number - 1)[1]
    return low, max(low + 1, 100 * (low - 1) // percent + 1)


@lru_cache(maxsize=None)
def scheme(percent: int, number: int) -> Scheme:
    low, after = bands(percent, number)
    return Scheme(number, low, after - 1, percent)


def keys_of(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Index keys of a set: in its own band's scheme, and as the larger one in the band below."""
    size, number = len(hashes), 0
    while bands(percent, number)[1] <= size:
        number += 1
    out = [scheme(percent, number).keys(hashes)]
    if number and size <= scheme(percent, number - 1).most:
        out.append(scheme(percent, number - 1).keys(hashes))
    return np.concatenate(out)


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parity bitmap: bits that differ between two sets cannot outnumber their difference.

    It has at least as many bits as the set has elements, a power of two; the longer of two
    bitmaps folds onto the shorter by exclusive or.
    """
    bits = max(LEAST_BITS, 1 << (len(hashes) - 1).bit_length() if len(hashes) else 0)
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(rows: DataFrame) -> DataFrame:
    """``_id``, ``_text`` -> ``_id``, ``_n`` (set size), ``_sig`` (digest of the set), ``_bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for start, length in slices(batch.column(1)):
                sets = [shingles(t) for t in batch.column(1).slice(start, length).to_pylist()]
                maps = [_bitmap(s) for s in sets]
                bits = np.concatenate(maps)
                offsets = np.concatenate([[0], np.cumsum([len(m) for m in maps])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, length),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(bits)),
                    ],
                    names=["_id", "_n", "_sig", "_bits"],
                )

    return rows.mapInArrow(run, "_id long, _n long, _sig binary, _bits array<long>")


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit numbers, byte by byte, so that equal high bytes compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view(np.int64)[:, 0]


def postings(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Members of every key that at least two documents share: ``_key`` (equal for keys with equal
    members), ``_id``, ``_hub`` (least id of the group), ``_before`` (the member before this one).

    A task sends its keys in packed blobs, one per bucket, and each set only once.  A key that
    many documents of a flush share is sent as a group of its own with only its least id in
    the bucket, so that a bucket holds at most ``HOT`` ids of a key per flush.
    """
    buckets = min(4 * max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), 1 << 22)
    low = np.uint64(8 * KEY_BYTES)

    def pack(keys: list, ids: list) -> Iterator[pa.RecordBatch]:
        key, owner = np.concatenate(keys), np.concatenate(ids)
        # The bucket on top of the key's own bits: one sort brings buckets and keys together.
        key = (key >> low) % np.uint64(buckets) << low | key & np.uint64((1 << 8 * KEY_BYTES) - 1)
        order = np.argsort(key)
        key, owner = key[order], owner[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        counts = np.diff(np.r_[first, len(key)])
        out = []
        plain = np.ones(len(key), dtype=bool)
        for i in np.flatnonzero(counts >= HOT):
            start, stop = first[i], first[i] + counts[i]
            owner[start:stop] = np.sort(owner[start:stop])
            plain[start + 1 : stop] = False
            out.append((int(key[start] >> low), key[start : start + 1], owner[start:stop].copy(), True))
        key, owner = key[plain], owner[plain]
        bucket = (key >> low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
        for a, b in zip(first, [*first[1:], len(bucket)]):
            out.append((int(bucket[a]), key[a:b], owner[a:b], False))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([o[0] for o in out], pa.int32()),
                pa.array([_planes(o[1], KEY_BYTES) for o in out], pa.binary()),
                pa.array([_planes(o[2], 8) for o in out], pa.binary()),
                pa.array([o[3] for o in out], pa.bool_()),
            ],
            names=["_bucket", "_keys", "_ids", "_hot"],
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(), set()
        keys, ids, held = [], [], 0
        for batch in batches:
            owners = batch.column(0).to_pylist()
            for start, length in slices(batch.column(1)):
                texts = batch.column(1).slice(start, length).to_pylist()
                for owner, text in zip(owners[start : start + length], texts):
                    hashes = shingles(text)
                    sign = xxhash.xxh3_128_intdigest(hashes.tobytes())
                    if not len(hashes) or sign in seen:
                        continue
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(sign)
                    keys.append(keys_of(hashes, percent))
                    ids.append(np.full(len(keys[-1]), owner, dtype=np.int64))
                    held += len(keys[-1])
                    if held >= FLUSH:
                        yield from pack(keys, ids)
                        keys, ids, held = [], [], 0
        if held:
            yield from pack(keys, ids)

    def match(table: pa.Table) -> pa.Table:
        hot = np.asarray(table["_hot"])
        top = np.int64(table["_bucket"][0].as_py()) << np.int64(8 * KEY_BYTES)
        keys = [_from_planes(k, KEY_BYTES) | top for k in table["_keys"].to_pylist()]
        ids = [_from_planes(i, 8) for i in table["_ids"].to_pylist()]
        key, owner, hub, before = [], [], [], []
        for k, i, is_hot in zip(keys, ids, hot):
            if is_hot:
                key.append(np.full(len(i), -1 - k[0]))
                owner.append(i)
                hub.append(np.full(len(i), i[0]))
                before.append(np.r_[i[0], i[:-1]])
        keys, ids = [k for k, h in zip(keys, hot) if not h], [i for i, h in zip(ids, hot) if not h]
        if keys:
            k, i = np.concatenate(keys), np.concatenate(ids)
            order = np.argsort(k)
            k, i = k[order], i[order]
            new = np.r_[True, k[1:] != k[:-1]]
            shared = ~(new & np.r_[new[1:], True])  # most keys have one document and end here
            k, i = k[shared], i[shared]
            order = np.lexsort((i, k))
            k, i = k[order], i[order]
            fresh = np.r_[True, (k[1:] != k[:-1]) | (i[1:] != i[:-1])] if len(k) else np.zeros(0, bool)
            k, i = k[fresh], i[fresh]
            first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, int)
            counts = np.diff(np.r_[first, len(k)])
            take, last = np.repeat(counts > 1, counts), np.r_[i[:1], i[:-1]]
            last[first] = i[first]
            # Keys with the same members are one group, named by the set of members; a key that
            # was also sent in groups keeps its own name, which those share.
            sums = np.add.reduceat(mix(i.view(np.uint64)), first) if len(first) else np.zeros(0, np.uint64)
            name = (mix(sums + counts.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
            sent = np.array([x[0] for x in key], dtype=np.int64)
            name = np.where(np.isin(-1 - k[first], sent), -1 - k[first], name)
            key.append(np.repeat(name, counts)[take])
            owner.append(i[take])
            hub.append(np.repeat(i[first], counts)[take])
            before.append(last[take])
        columns = {"_key": key, "_hub": hub, "_before": before, "_id": owner}
        return pa.table({c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in columns.items()})

    blobs = rows.mapInArrow(emit, "_bucket int, _keys binary, _ids binary, _hot boolean")
    return blobs.groupBy("_bucket").applyInArrow(match, "_key long, _hub long, _before long, _id long")


def _sets(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for start, length in slices(batch.column(1)):
                sets = [shingles(t) for t in batch.column(1).slice(start, length).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, length), pa.ListArray.from_arrays(pa.array(offsets), values)],
                    names=["_id", "_set"],
                )

    return rows.mapInArrow(run, "_id long, _set array<long>")


def _folded(bits: Column, longs: Column) -> Column:
    """A bitmap folded to a number of longs that divides its own."""
    return F.transform(
        F.sequence(F.lit(0), longs - 1),
        lambda i: F.aggregate(
            F.sequence(i, F.size(bits) - 1, longs), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(bits, j))
        ),
    )


def _could_link(percent: int, longs: int | None = None, bits: str = "_bits") -> Column:
    """Sizes and bitmaps of ``a`` and ``b`` (of ``longs`` longs, if equal) do not rule out a link."""
    small_, large = F.least("a._n", "b._n"), F.greatest("a._n", "b._n")
    sized = 100 * small_ >= percent * large
    x, y = F.col(f"a.{bits}"), F.col(f"b.{bits}")
    if longs is not None:
        parts = [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(longs)]
        differ = sum(parts, F.lit(0))
    else:
        common = F.least(F.size(x), F.size(y))
        pairs = F.zip_with(_folded(x, common), _folded(y, common), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        differ = F.aggregate(pairs, F.lit(0), lambda p, q: p + q)
    return sized & ((100 + percent) * differ <= (100 - percent) * (F.col("a._n") + F.col("b._n")))


def _plausible(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs (``u``, ``v``, other columns) that sizes and bitmaps do not rule out."""
    a = sizes.select(F.col("_id").alias("u"), F.struct("_n", "_bits").alias("a"))
    b = sizes.select(F.col("_id").alias("v"), F.struct("_n", "_bits").alias("b"))
    could = F.coalesce(_could_link(percent), F.lit(True))
    return pairs.join(a, "u").join(b, "v").where(could).drop("a", "b")


def verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (``u``, ``v``) whose whole sets are linked.

    Sets are computed again from the texts, for the documents of the pairs only.
    """
    ids = keep(pairs.select(F.col("u").alias("_id")).union(pairs.select("v")).distinct(), "jaccard-ids")
    sets = keep(_sets(rows.join(small(ids), "_id", "left_semi")), "jaccard-sets")
    left = sets.select(F.col("_id").alias("u"), F.col("_set").alias("a"))
    right = sets.select(F.col("_id").alias("v"), F.col("_set").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    joined = pairs.join(right, "v").join(left, "u")
    linked = joined.where(100 * both >= percent * (F.size("a") + F.size("b") - both)).select("u", "v")
    out = keep(linked, "jaccard-links")
    drop_kept(sets, ids)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``, the least id reachable by links.

    Null and empty texts have no shingles and link with nothing.  Equal sets are one vertex, so
    copies need no pairs.  Rows that share an id are one document and therefore linked; a row
    with a null id links with nothing and has a null component.  An empty table gives no rows.
    """
    rows = inputs(docs, _id=id_col, _text=text_col).withColumn("_id", F.col("_id").cast("long"))
    stats = keep(signatures(rows), "jaccard-stats")
    usable = stats.where("_n > 0 AND _id IS NOT NULL")
    # Copies hang on the least id that has their set.
    least = usable.groupBy("_sig").agg(F.min("_id").alias("_rep"))
    copies = keep(
        usable.select("_id", "_sig").join(least, "_sig").where("_id != _rep").select(F.col("_id").alias("u"), F.col("_rep").alias("v")),
        "jaccard-copies",
    )
    # An id with several sets is not ruled out by any of them.
    one = F.min("_sig") == F.max("_sig")
    sizes = usable.groupBy("_id").agg(F.when(one, F.first("_n")).alias("_n"), F.when(one, F.first("_bits")).alias("_bits"))

    texts = rows.where("_id IS NOT NULL")
    members = keep(
        postings(texts, percent).groupBy("_key", "_id").agg(
            F.min("_hub").alias("_hub"), F.min("_before").alias("_before"), F.count("*").alias("_keys")
        ),
        "jaccard-members",
    )
    # First each document against the one hub it shares most keys with.
    stars = keep(
        members.where("_id != _hub").groupBy(F.col("_id").alias("u"), F.col("_hub").alias("v")).agg(F.sum("_keys").alias("n")),
        "jaccard-stars",
    )
    best = _plausible(stars, sizes, percent).groupBy("u").agg(F.max(F.struct("n", (-F.col("v")).alias("v"))).alias("m"))
    links = verified(keep(best.select("u", (-F.col("m.v")).alias("v")), "jaccard-pairs"), texts, percent)
    labels = keep(components(links.union(copies)), "jaccard-labels")

    # Then, where a key joins documents still apart, each against the member before it.
    open_ = keep(_open(members, stars, labels), "jaccard-open")
    steps = open_.where("_id != _before").select(F.col("_id").alias("u"), F.col("_before").alias("v")).distinct()
    links = verified(keep(_plausible(_apart(steps, labels), sizes, percent), "jaccard-pairs"), texts, percent)
    # What is joined already hangs on its least id: a star each, which the new links connect.
    before, labels = labels, keep(components(_stars(labels).union(links)), "jaccard-labels")
    drop_kept(before)

    # At last all pairs that share a key and are still apart.
    placed = _labelled(open_.select("_key", F.col("_id").alias("u")).distinct(), labels, "u", "c")
    mixed = placed.groupBy("_key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low != high")
    left = placed.join(mixed.select("_key", "low"), "_key").join(sizes.withColumnRenamed("_id", "u"), "u")
    folded = _folded(F.col("_bits"), F.lit(LEAST_BITS // 64))
    whole = F.when(F.size("_bits") > LEAST_BITS // 64, F.col("_bits"))
    shape = F.struct("_n", folded.alias("_bits"), whole.alias("_all"))
    left = keep(left.select("_key", "u", "c", "low", shape.alias("s")), "jaccard-left")
    minor = left.where("c != low").select("_key", F.col("u").alias("x"), F.col("c").alias("d"), F.col("s").alias("a"))
    major = left.select("_key", F.col("u").alias("y"), F.col("c").alias("e"), F.col("s").alias("b"))
    # Sizes and whole bitmaps are compared inside the join: of a group's pairs only those pass
    # that may be linked.  A short bitmap tells large sets nothing, so the folded one goes first
    # and the whole ones of two large sets after it.
    could = F.coalesce(_could_link(percent, LEAST_BITS // 64), F.lit(True))
    large = F.col("a._all").isNull() | F.col("b._all").isNull() | _could_link(percent, bits="_all")
    apart = (minor["_key"] == major["_key"]) & (F.col("d") != F.col("e")) & could & large
    pairs = minor.join(major, apart).select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
    more = verified(keep(_plausible(pairs, sizes, percent), "jaccard-pairs"), texts, percent)
    final = components(_stars(labels).union(more)).withColumnRenamed("vertex", "_id")
    # The components are written: nothing reads these tables any more.
    drop_kept(members, stars, open_, left, copies, labels)

    out = stats.join(final, "_id", "left")
    return out.select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.coalesce("component", "_id").alias("component_id")
    )


def _stars(labels: DataFrame) -> DataFrame:
    """The edges from the vertices to their components."""
    return labels.select(F.col("vertex").alias("u"), F.col("component").alias("v"))


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """Add the component of ``column`` as ``name``; a vertex without an edge is its own."""
    known = labels.select(F.col("vertex").alias(column), F.col("component").alias("_c"))
    return rows.join(known, column, "left").withColumn(name, F.coalesce("_c", column)).drop("_c")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    both = _labelled(_labelled(pairs, labels, "u", "_cu"), labels, "v", "_cv")
    return both.where("_cu != _cv").drop("_cu", "_cv")


def _open(members: DataFrame, stars: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the keys in which a document and its hub are in different components.

    Every member hangs on a hub and every hub of a group on the key's, so a key without such
    a pair lies in one component.
    """
    apart = keep(_apart(stars, labels).select(F.col("u").alias("_id"), F.col("v").alias("_hub")), "jaccard-apart")
    keys = keep(members.join(small(apart), ["_id", "_hub"], "left_semi").select("_key").distinct(), "jaccard-keys")
    return members.join(small(keys), "_key", "left_semi")
