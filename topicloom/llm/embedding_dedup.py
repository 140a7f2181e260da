"""Embedding near-dedup over a robust-pruned flat graph built on overlapping cluster shards.

Vectors of one label fall into the shards of their ``overlap`` nearest centres (rows of a bounded
sample).  Each shard, cut into blocks of bounded size, gets a graph: greedy searches from its
medoid give the candidates of a vector, robust pruning keeps the edges, reverse edges are added
and pruned again.  The adjacency lists of a vector from all its shards are united.  Then every
vector is searched in the blocks of the shards that can be the nearest one of a vector in range:
greedily from the medoid with a beam, and where the beam ends inside the radius the search goes
on through all neighbours in range.  What is found is verified in double precision.

Where vectors have no structure, nearly every shard can be that one.  The shards are therefore
visited from the nearest on: the audit tells how far down the list true links go, twice as many
shards are visited, and a vector with a link in the farther half visits all the others as well.
A vector lies in several shards, so a link is met in the first of them on the list: it counts
there, and in the nearest shard of the vector that is found where none of them comes so early.

Equal vectors of a label are one vertex with a count, so copies never form pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.graph import components
from topicloom.llm.text import inputs
from topicloom.workspace import drop_kept, keep

COSINE = 0.93
CENTRES = 32_768  # most rows that serve as centres
PER_CENTRE = 400  # rows per centre aimed at
OVERLAP = 3
BLOCK = 2_000  # rows per block aimed at; a shard with more is cut
DEGREE = 24
BEAM = 40
ALPHA = 1.2
AUDIT = 200
EXPAND = 4
PREFIX = 32  # most shards named in a query's row; where more are visited first, links count at home only
BATCH = 256
_SLACK = 1e-5  # float32 search error; what is found is verified
_ROUTE_SLACK = 1e-4  # float32 routing error


class Graph:
    """Unit vectors (float32) with adjacency lists, -1 for an empty place."""

    def __init__(self, vectors: np.ndarray, neighbours: np.ndarray):
        self.vectors, self.neighbours = vectors, neighbours
        mean = vectors.mean(axis=0)
        self.medoid = int((vectors @ mean).argmax())

    def join_directions(self) -> None:
        """Edges in both directions, for the search in range.

        Pruning lets the members of a tight group lean on one of them, whose own list is too
        short to name them all; against the arrows they can be reached.
        """
        source, place = np.nonzero(self.neighbours >= 0)
        target = self.neighbours[source, place]
        size = np.int64(len(self.vectors))
        pair = np.unique(np.r_[source * size + target, target * size + source])
        self.ends = np.searchsorted(pair, np.arange(size + 1) * size)
        self.both = pair % size

    def _parts(self, fq: np.ndarray, fn: np.ndarray, edges: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces of a frontier with about ``edges`` edges each."""
        total = np.cumsum(self.ends[fn + 1] - self.ends[fn])
        cuts = np.searchsorted(total, np.arange(edges, int(total[-1]) + 1, edges), side="right")
        yield from ((a, b) for a, b in zip(np.split(fq, cuts), np.split(fn, cuts)) if len(a))

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy search from the medoid: ids and similarities of the beam, all places visited."""
        count, size = len(queries), len(self.vectors)
        beam = min(beam, size)
        rows = np.arange(count)[:, None]
        ids = np.full((count, beam), -1)
        sims = np.full((count, beam), -np.inf, dtype=np.float32)
        done = np.ones((count, beam), dtype=bool)
        visited = np.zeros((count, size + 1), dtype=bool)  # the last column takes the empty places
        visited[:, -1] = True
        ids[:, 0], sims[:, 0], done[:, 0] = self.medoid, queries @ self.vectors[self.medoid], False
        visited[:, self.medoid] = True
        while not done.all():
            open_sims = np.where(done, -np.inf, sims)
            pick = np.argpartition(-open_sims, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND]
            chosen = np.where(np.take_along_axis(done, pick, 1), -1, np.take_along_axis(ids, pick, 1))
            np.put_along_axis(done, pick, True, 1)
            near = np.where(chosen[:, :, None] >= 0, self.neighbours[chosen], -1).reshape(count, -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[visited[rows, near]] = -1
            visited[rows, near] = True
            new = np.matmul(self.vectors[near], queries[:, :, None])[:, :, 0]
            new[near < 0] = -np.inf
            ids, sims = np.concatenate([ids, near], 1), np.concatenate([sims, new], 1)
            done = np.concatenate([done, near < 0], 1)
            best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            ids, sims, done = (np.take_along_axis(x, best, 1) for x in (ids, sims, done))
            done |= ids < 0
        return ids, sims, visited

    def in_range(self, queries: np.ndarray, own: np.ndarray, radius: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) with similarity of at least ``radius``.

        From the nodes in range that the beam ends in, and from the query's own place in the
        graph where it has one, the search goes on through every neighbour in range.
        """
        ids, sims, visited = self.search(queries, beam)
        q, slot = np.nonzero(sims >= radius)
        node = ids[q, slot]
        known = np.zeros_like(visited)
        known[:, -1] = True
        known[q, node] = True
        here = np.flatnonzero(own >= 0)
        more = here[~known[here, own[here]]]
        known[more, own[more]] = True
        front_q, front_n = np.r_[q, more], np.r_[node, own[more]]
        while len(front_q):
            next_q, next_n = [], []
            for fq, fn in self._parts(front_q, front_n):
                counts = self.ends[fn + 1] - self.ends[fn]
                place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                near = self.both[np.repeat(self.ends[fn], counts) + place]
                pq = np.repeat(fq, counts)
                fresh = ~known[pq, near]
                pair = np.unique(pq[fresh] * np.int64(len(self.vectors)) + near[fresh])
                pq, pn = pair // len(self.vectors), pair % len(self.vectors)
                # Seen once is enough, whether in range or not.
                known[pq, pn] = True
                inside = np.einsum("ij,ij->i", queries[pq], self.vectors[pn]) >= radius
                next_q.append(pq[inside])
                next_n.append(pn[inside])
            front_q, front_n = np.concatenate(next_q), np.concatenate(next_n)
            q, node = np.r_[q, front_q], np.r_[node, front_n]
        pair = np.unique(q * np.int64(len(self.vectors)) + node)
        return pair // len(self.vectors), pair % len(self.vectors)


def robust_prune(vectors: np.ndarray, points: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Kept neighbours of each point (rows of ``candidates``, -1 empty): nearest first; a candidate
    falls when a kept one is nearer to it, by the factor ``alpha``, than the point is."""
    count, width = candidates.shape
    rows = np.arange(count)
    near = vectors[candidates]
    to_point = 2 - 2 * np.matmul(near, vectors[points][:, :, None])[:, :, 0]
    alive = (candidates >= 0) & (candidates != points[:, None])
    to_point = np.maximum(to_point, 0) ** 0.5
    out = np.full((count, degree), -1)
    for place in range(degree):
        cost = np.where(alive, to_point, np.inf)
        best = cost.argmin(axis=1)
        ok = np.isfinite(cost[rows, best])
        if not ok.any():
            break
        out[ok, place] = candidates[rows, best][ok]
        between = np.maximum(2 - 2 * np.matmul(near, near[rows, best][:, :, None])[:, :, 0], 0) ** 0.5
        alive &= (alpha * between > to_point) & ok[:, None]
        alive[rows, best] = False
    return out


def _dedupe(ids: np.ndarray) -> np.ndarray:
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    return ids


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, seed: int = 3) -> np.ndarray:
    """Adjacency lists of a block: from a random graph, two passes of search and prune."""
    size = len(vectors)
    if size <= degree + 1:
        lists = np.tile(np.arange(size), (size, 1))
        lists[np.arange(size), np.arange(size)] = -1
        return lists
    rng = np.random.default_rng(seed)
    graph = Graph(vectors, rng.integers(0, size, (size, degree)))
    for alpha in (1.0, ALPHA):
        order = rng.permutation(size)
        for start in range(0, size, BATCH):
            points = order[start : start + BATCH]
            ids, _, _ = graph.search(vectors[points], beam)
            pool = _dedupe(np.concatenate([ids, graph.neighbours[points]], 1))
            kept = robust_prune(vectors, points, pool, alpha, degree)
            graph.neighbours[points] = kept
            # Reverse edges, for all points that gained one; pruned where they overflow.
            target, source = kept.ravel(), np.repeat(points, degree)
            target, source = target[target >= 0], source[target >= 0]
            order_ = np.argsort(target, kind="stable")
            target, source = target[order_], source[order_]
            hit, first, counts = np.unique(target, return_index=True, return_counts=True)
            width = int(counts.max(initial=0))
            extra = np.full((len(hit), width), -1)
            extra[np.repeat(np.arange(len(hit)), counts), np.arange(len(target)) - np.repeat(first, counts)] = source
            for part in range(0, len(hit), BATCH):
                some = hit[part : part + BATCH]
                pool = _dedupe(np.concatenate([graph.neighbours[some], extra[part : part + BATCH]], 1))
                graph.neighbours[some] = robust_prune(vectors, some, pool, alpha, degree)
    return graph.neighbours


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def vertices(rows: DataFrame) -> DataFrame:
    """Valid vectors, equal ones of a label together: ``_v`` (least id), ``_label``, ``_vec``, ``_n``.

    A vector is valid with an id, a label, no null or non-finite component and a length above
    zero; negative zeros count as zeros.
    """
    vec = F.transform("_vec", lambda x: x.cast("double") + F.lit(0.0))
    fine = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    valid = rows.where("_id IS NOT NULL AND _label IS NOT NULL AND _vec IS NOT NULL").where(fine)
    valid = valid.where(F.exists("_vec", lambda x: x != 0)).withColumn("_vec", vec)
    return valid.groupBy("_label", "_vec").agg(F.min("_id").alias("_v"), F.count("*").alias("_n"))


def route(points: DataFrame, dim: int, overlap: int = OVERLAP, cosine: float = COSINE) -> DataFrame:
    """Add ``_cells``: the numbers of the nearest centres of the same label, in rising order,
    ``_home``: the nearest one, and ``_visits``: all that can be the home of a vector in range, nearest first.

    A vector x at home at c is not nearer to the home h of q than to c, so q (h - c) is at most
    (q - x)(h - c), and at most |q - x| |h - c|; a centre beyond that has nothing in range of q.
    Centres are at most ``CENTRES`` rows in the order of an id hash; a label without one has a
    single cell.  Their table is bounded by that number and broadcast.
    """
    spark = points.sparkSession
    chord = math.sqrt(max(0.0, 2 - 2 * cosine))
    wanted = min(CENTRES, max(1, points.count() // PER_CENTRE))
    drawn = points.select("_v", "_label", "_vec").orderBy(F.xxhash64("_v"), "_v").limit(wanted).collect()
    by_label: dict = {}
    for number, row in enumerate(sorted(drawn, key=lambda r: r["_v"])):
        by_label.setdefault(row["_label"], []).append((number, row["_vec"]))
    table = {
        k: (np.array([n for n, _ in v]), _unit(np.array([x for _, x in v])).astype(np.float32))
        for k, v in by_label.items()
    }
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(0).to_pylist()
            vectors = _unit(_matrix(batch.column(1), dim)).astype(np.float32)
            cells, homes, visits = [[-1]] * len(labels), [-1] * len(labels), [[-1]] * len(labels)
            for label in set(labels) & set(shared.value):
                at = np.flatnonzero([x == label for x in labels])
                numbers, centres = shared.value[label]
                for part in np.array_split(at, max(1, len(at) * len(numbers) // 4_000_000)):
                    sims = vectors[part] @ centres.T
                    order = np.argsort(-sims, axis=1, kind="stable")
                    best, first = order[:, :overlap], order[:, 0]
                    apart = np.sqrt(np.maximum(2 - 2 * (centres[first] @ centres.T), 0))
                    reached = sims[np.arange(len(part)), first][:, None] - sims <= chord * apart + _ROUTE_SLACK
                    for i, chosen, row, near in zip(part, best, reached, order):
                        cells[i] = sorted(numbers[chosen].tolist())
                        homes[i] = int(numbers[chosen[0]])
                        visits[i] = numbers[near[row[near]]].tolist()
            added = [pa.array(cells, pa.list_(pa.int32())), pa.array(homes, pa.int32()), pa.array(visits, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "_cells", "_home", "_visits"])

    kind = points.schema["_label"].dataType.simpleString()
    return points.select("_label", "_vec", "_v", "_n").mapInArrow(
        run, f"_label {kind}, _vec array<double>, _v long, _n long, _cells array<int>, _home int, _visits array<int>"
    )


def placed(routed: DataFrame, cells: str = "_cells") -> DataFrame:
    """One row per vector and shard: ``_cell``, its ``_place`` in the list, ``_block``, ``_blocks`` and the vector's columns."""
    rows = routed.select("*", F.posexplode(cells).alias("_place", "_cell")).drop("_cells", "_visits")
    sizes = rows.groupBy("_label", "_cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    block = F.pmod(F.xxhash64("_v"), F.col("_blocks")).cast("int")
    return rows.join(sizes, ["_label", "_cell"]).withColumn("_block", block)


def _lists(table: pa.Table) -> pa.Table:
    ids = np.asarray(table["_v"])
    vectors = _unit(np.array(table["_vec"].to_pylist(), dtype=np.float64)).astype(np.float32)
    order = np.argsort(ids)
    ids, vectors = ids[order], vectors[order]
    lists = build(vectors)
    return pa.table({"_v": ids, "_near": pa.array([ids[row[row >= 0]].tolist() for row in lists], pa.list_(pa.int64()))})


def _padded(lists, fill: int) -> np.ndarray:
    lists = lists.to_pylist()
    width = max(1, max(map(len, lists), default=1))
    return np.array([x + [fill] * (width - len(x)) for x in lists], dtype=np.int32).reshape(-1, width)


def _searcher(cosine: float, beam: int | None):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        cell = key[1].as_py()
        query, home = np.asarray(table["_query"]), np.asarray(table["_home"])
        ids, weight, late = np.asarray(table["_v"]), np.asarray(table["_n"]), np.asarray(table["_late"])
        raw = np.array(table["_vec"].to_pylist(), dtype=np.float64)
        norms = np.linalg.norm(raw, axis=1)
        vectors = (raw / norms[:, None]).astype(np.float32)
        nodes, queries = np.flatnonzero(~query), np.flatnonzero(query)
        if not len(nodes) or not len(queries):
            return _none()
        nodes, queries = nodes[np.argsort(ids[nodes])], queries[np.argsort(ids[queries])]
        # The shards a node lies in and those whose links a query counts elsewhere, by row.
        row = np.zeros(len(ids), dtype=np.int64)
        row[nodes], row[queries] = np.arange(len(nodes)), np.arange(len(queries))
        lies, before = (_padded(table["_in"].take(pa.array(some)), fill) for some, fill in ((nodes, -2), (queries, -3)))
        home_only = np.asarray(table["_home_only"])
        if beam is not None:
            known = {int(v): i for i, v in enumerate(ids[nodes])}
            lists = [[known[x] for x in table["_near"][int(i)].as_py() if x in known] for i in nodes]
            degree = max(1, max(map(len, lists)))
            near = np.array([x + [-1] * (degree - len(x)) for x in lists], dtype=np.int64).reshape(len(nodes), degree)
            graph = Graph(vectors[nodes], near)
            graph.join_directions()
            own = np.array([known.get(int(v), -1) for v in ids[queries]])
        links = np.zeros(len(ids), dtype=np.int64)
        # Rows of one id, as query and as node, share a place.
        values, place = np.unique(ids, return_inverse=True)
        least, hit, far = values.copy(), np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=bool)
        left, right = [], []
        for start in range(0, len(queries), BATCH):
            some = queries[start : start + BATCH]
            if beam is None:
                q, x = np.nonzero(vectors[some] @ vectors[nodes].T >= cosine - _SLACK)
            else:
                q, x = graph.in_range(vectors[some], own[start : start + BATCH], cosine - _SLACK, beam)
            q, x = some[q], nodes[x]
            q, x = q[ids[q] != ids[x]], x[ids[q] != ids[x]]
            for part in range(0, len(q), 100_000):
                a, b = q[part : part + 100_000], x[part : part + 100_000]
                # Verified in double precision; every pair joins, a link counts in one shard.
                ok = np.einsum("ij,ij->i", raw[a], raw[b]) >= cosine * (norms[a] * norms[b])
                a, b = a[ok], b[ok]
                met = (lies[row[b]][:, :, None] == before[row[a]][:, None, :]).any(axis=(1, 2))
                counts = ~met & (~home_only[a] | (home[b] == cell))
                np.add.at(links, a[counts], weight[b[counts]])
                far[place[a[counts & late[a]]]] = True
                left.append(place[a])
                right.append(place[b])
        a, b = np.concatenate(left or [[]]).astype(int), np.concatenate(right or [[]]).astype(int)
        while len(a):
            earlier = least.copy()
            np.minimum.at(least, a, least[b])
            np.minimum.at(least, b, least[a])
            if (earlier == least).all():
                break
        hit[a] = hit[b] = True
        total = np.zeros(len(values), dtype=np.int64)
        np.add.at(total, place, links)
        return pa.table({"_v": values[hit], "_links": total[hit], "_least": least[hit], "_far": far[hit]})

    return run


def _none() -> pa.Table:
    whole = {c: pa.array([], pa.int64()) for c in ("_v", "_links", "_least")}
    return pa.table({**whole, "_far": pa.array([], pa.bool_())})


def search_all(routed: DataFrame, cosine: float = COSINE, beam: int | None = BEAM, nearest: int | None = None) -> DataFrame:
    """Rows ``_v``, ``_links``, ``_least``, several per vector: links found in a task and the least
    id they lead to there.  Without a beam all pairs of a query block and a node block are compared.

    With ``nearest`` a vector visits that many shards of its list, and the others when one of the
    farther half of them gave it a link.  Up to ``PREFIX`` shards, a link counts in the first of
    them that holds the vector found.
    """
    nodes = keep(placed(routed.withColumn("_in", F.col("_cells"))), "graph-placed")
    early = nearest is not None and nearest <= PREFIX
    routed = routed.withColumn("_in", F.slice("_visits", 1, nearest) if early else F.array().cast("array<int>"))
    if beam is None:
        full = nodes.where("_home = _cell").withColumn("_near", F.lit(None).cast("array<long>"))
    else:
        built = nodes.select("_label", "_cell", "_block", "_v", "_vec").groupBy("_label", "_cell", "_block")
        lists = built.applyInArrow(_lists, "_v long, _near array<long>")
        union = lists.groupBy("_v").agg(F.array_distinct(F.flatten(F.collect_list("_near"))).alias("_near"))
        full = nodes.join(union, "_v")
    if nearest is None:
        return _search(routed, nodes, full, cosine, beam).drop("_far")
    full = keep(full, "graph-full")
    first = routed.withColumn("_visits", F.slice("_visits", 1, nearest))
    found = keep(_search(first, nodes, full, cosine, beam, nearest // 2, early), "graph-first")
    far = keep(found.where("_far").select("_v").distinct(), "graph-far")
    rest = routed.withColumn("_visits", F.slice("_visits", nearest + 1, CENTRES)).where(F.size("_visits") > 0)
    rest = rest.join(far, "_v", "left_semi")
    return found.unionByName(_search(rest, nodes, full, cosine, beam)).drop("_far")


def _search(routed: DataFrame, nodes: DataFrame, full: DataFrame, cosine: float, beam: int | None, late: int = CENTRES,
            early: bool = False) -> DataFrame:
    """The links of all vectors of ``routed`` in the shards they visit; ``_far``: one was found at place ``late`` or later.

    Links count where the vector found is at home, unless it lies in one of the query's shards
    ``_in`` that counted them before; with ``early``, in the first of the shards ``_in`` it lies in.
    """
    asked = keep(placed(routed, "_visits"), "graph-asked")
    if early:
        asked = asked.withColumn("_in", F.slice("_in", F.lit(1), F.col("_place")))
    # Every block of a shard is searched for every block of the queries that visit it.
    sizes = [rows.select("_label", "_cell", F.col("_blocks").alias("_others")).distinct() for rows in (nodes, asked)]
    every = F.explode(F.sequence(F.lit(0), F.col("_others") - 1))
    as_query = asked.join(sizes[0], ["_label", "_cell"]).select(
        "_label", "_cell", F.col("_block").alias("_i"), every.alias("_j"), "_v", "_n", "_vec", "_home", "_in",
        F.lit(None).cast("array<long>").alias("_near"), F.lit(True).alias("_query"), (F.col("_place") >= late).alias("_late"),
        F.lit(not early).alias("_home_only"))
    as_node = full.join(sizes[1], ["_label", "_cell"]).select(
        "_label", "_cell", every.alias("_i"), F.col("_block").alias("_j"), "_v", "_n", "_vec", "_home", "_in", "_near",
        F.lit(False).alias("_query"), F.lit(False).alias("_late"), F.lit(not early).alias("_home_only"))
    tasks = as_query.unionByName(as_node)
    return tasks.groupBy("_label", "_cell", "_i", "_j").applyInArrow(
        _searcher(cosine, beam), "_v long, _links long, _least long, _far boolean"
    )


def true_links(routed: DataFrame, dim: int, cosine: float = COSINE, queries: int = AUDIT) -> DataFrame:
    """Exact link counts of at most ``queries`` vectors against all rows, in blocks: ``_v``, ``_true``,
    ``_last``: the farthest place in its ``_visits`` at which a linked vector is at home (-1: none), and
    ``_first``: the farthest of the first places at which the linked vectors lie."""
    wanted = routed.select("_v", "_label", "_vec", "_visits").orderBy(F.xxhash64("_v", F.lit("audit")), "_v").limit(queries)
    drawn = wanted.collect()
    shared = routed.sparkSession.sparkContext.broadcast([tuple(r) for r in drawn])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, raw, visits = zip(*shared.value)
        ids, raw = np.array(ids), _unit(np.array(raw, dtype=np.float64))
        # Place of each cell in each list; cell -1 takes the last column, the one before it stays empty.
        places = np.full((len(ids), max(map(max, visits)) + 3), -1, dtype=np.int32)
        for row, cells in zip(places, visits):
            row[cells] = np.arange(len(cells))
        found, last, first = np.zeros(len(ids), dtype=np.int64), *np.full((2, len(ids)), -1, dtype=np.int64)
        for batch in batches:
            rows = _unit(_matrix(batch.column(1), dim))
            mine = batch.column(0).to_pylist()
            same = np.array([[a == b for b in mine] for a in labels]) & (ids[:, None] != np.asarray(batch.column(2)))
            linked = (raw @ rows.T >= cosine) & same
            found += linked @ np.asarray(batch.column(3))
            q, x = np.nonzero(linked)
            home = np.asarray(batch.column(4))[x]
            known = home < places.shape[1] - 2
            np.maximum.at(last, q[known], places[q[known], home[known]])
            lies = _padded(batch.column(5), -2)[x]
            lies[lies >= places.shape[1] - 2] = -2
            at = places[q[:, None], lies]
            least = np.where(at < 0, CENTRES, at).min(axis=1, initial=CENTRES)
            np.maximum.at(first, q[least < CENTRES], least[least < CENTRES])
        columns = {"_v": ids, "_true": found, "_last": last, "_first": first}
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))

    if not drawn:
        return routed.select("_v", F.lit(0).cast("long").alias("_true"), *[F.lit(-1).cast("long").alias(c) for c in ("_last", "_first")])
    counts = routed.select("_label", "_vec", "_v", "_n", "_home", "_cells").mapInArrow(run, "_v long, _true long, _last long, _first long")
    return counts.groupBy("_v").agg(F.sum("_true").alias("_true"), F.max("_last").alias("_last"), F.max("_first").alias("_first"))


def recall(links: DataFrame, truth: DataFrame) -> float:
    """Share of the true links of the audited vectors that were found."""
    found = truth.join(links, "_v", "left").agg(
        F.sum(F.least("_true", F.coalesce("_links", F.lit(0)))), F.sum("_true")
    ).first()
    return found[0] / found[1] if found[1] else 1.0


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, beam: int = BEAM, least_recall: float = 0.95) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` (least id reachable), ``kept`` (own id is that).

    Recall is audited on a bounded number of vectors against all rows; while it is below
    ``least_recall`` the search is repeated in all shards that can hold a vector in range, with the
    beam, with twice and with four times the beam, and at last all pairs of the blocks are compared.  Invalid
    vectors link with nothing and are their own component.  Vectors of another length than
    the rest are compared among themselves only.  Rows that share an id and a vector are copies
    of each other (their links count); a null id has a null component and is not kept.  An
    empty table gives no rows.
    """
    base = inputs(rows, _id=id_col, _vec=vec_col, _label=label_col).withColumn("_id", F.col("_id").cast("long"))
    points = keep(vertices(base), "graph-points")
    counts, edges = None, None
    for dim in sorted(r[0] for r in points.select(F.size("_vec")).distinct().collect()):
        same = points.where(F.size("_vec") == dim)
        routed = keep(route(same, dim, cosine=cosine), "graph-routed")
        truth = keep(true_links(routed, dim, cosine), "graph-truth")
        # Twice as far as the audited links go.
        last, first = truth.agg(F.max("_last"), F.max("_first")).first()
        nearest = max(OVERLAP, 2 * (first + 1))
        if nearest > PREFIX:
            nearest = max(nearest, 2 * (last + 1))
        for width, limit in ((beam, nearest), (beam, None), (2 * beam, None), (4 * beam, None), (None, None)):
            found = keep(search_all(routed, cosine, width, limit), "graph-found")
            links = found.groupBy("_v").agg(F.sum("_links").alias("_links"))
            if width is None or recall(links, truth) >= least_recall:
                break
            drop_kept(found)
        part = found.select(F.col("_v").alias("u"), F.col("_least").alias("v"))
        counts = links if counts is None else counts.union(links)
        edges = part if edges is None else edges.union(part)
        drop_kept(truth)
    if counts is None:
        counts = points.select("_v", F.lit(0).cast("long").alias("_links"))
        edges = points.select(F.col("_v").alias("u"), F.col("_v").alias("v"))
    labels = components(edges).withColumnRenamed("vertex", "_v")
    state = points.join(counts, "_v", "left").join(labels, "_v", "left").select(
        "_label", "_vec", "_v", (F.coalesce("_links", F.lit(0)) + F.col("_n") - 1).alias("_links"),
        F.coalesce("component", "_v").alias("_component"),
    )
    # Back to the rows by label and vector: equal vectors share their state.
    keyed = base.withColumn("_key", F.transform("_vec", lambda x: x.cast("double") + F.lit(0.0)))
    joined = keyed.where("_id IS NOT NULL").join(
        state.select(F.col("_label"), F.col("_vec").alias("_key"), "_links", "_component"), ["_label", "_key"], "left"
    ).select("_id", "_links", "_component")
    lost = keyed.where("_id IS NULL").select("_id", F.lit(None).cast("long").alias("_links"), F.lit(None).cast("long").alias("_component"))
    out = joined.unionByName(lost)
    component = F.coalesce("_component", "_id")
    return out.select(
        F.col("_id").alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("_id") == component, F.lit(False)).alias("kept"),
    )
