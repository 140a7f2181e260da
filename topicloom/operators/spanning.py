"""Mutual reachability, minimum spanning trees and connected components.

Trees grow in Boruvka rounds: every component picks its lightest outgoing edge,
the picks are contracted, and the component count at least halves.  Edges are
ordered by (w, lo, hi), so the tree is unique.

A neighbour graph alone may miss the lightest edge out of a component.  The exact
tree therefore checks each round which points could have a lighter edge to a point
outside their neighbour list (everything outside is at least ``reach`` away) and
searches the other components for those points only, cell by cell, within the
weight found so far.  The largest component never searches: the others attach
themselves to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.operators.neighbours import (
    TILE_COLS,
    TILE_ROWS,
    Scores,
    block_rows_for,
    cell_radii,
    exact_pairs,
    fits,
    knn_exact,
    matrix,
    pair_blocks,
    places,
    sample_centres,
    squared,
    to_cells_within,
    to_nearest_cells,
)
from topicloom.workspace import drop_kept, keep, keep_all


def core_distances(knn: DataFrame, min_samples: int) -> DataFrame:
    """(id, core): distance to the ``min_samples``-th neighbour, the point itself excluded.

    Neighbour distances are squared; a point with fewer neighbours uses its farthest.
    """
    return (
        knn.where((F.col("rank") <= min_samples) & (F.col("src") != F.col("dst")))
        .groupBy(F.col("src").alias("id"))
        .agg(F.sqrt(F.max("dist")).alias("core"))
    )


def mutual_reachability(knn: DataFrame, core: DataFrame) -> DataFrame:
    """Undirected edges (lo, hi, w) with w = max(core of both ends, distance)."""
    undirected = (
        knn.where(F.col("src") != F.col("dst"))
        .groupBy(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi"))
        .agg(F.sqrt(F.min("dist")).alias("d"))
    )
    return (
        undirected.join(core.select(F.col("id").alias("lo"), F.col("core").alias("c1")), "lo")
        .join(core.select(F.col("id").alias("hi"), F.col("core").alias("c2")), "hi")
        .select("lo", "hi", F.greatest("c1", "c2", "d").alias("w"))
    )


# -- contraction -------------------------------------------------------------


def hook(picks: DataFrame) -> DataFrame:
    """Add ``root`` to (v, other, ...): of two vertices that picked each other, the smaller."""
    back = picks.select(F.col("v").alias("other"), F.col("other").alias("_back"))
    return picks.join(back, "other", "left").withColumn(
        "root", F.col("_back").eqNullSafe(F.col("v")) & (F.col("v") < F.col("other"))
    ).drop("_back")


def flatten(parents: DataFrame) -> DataFrame:
    """(v, p) pointers -> (v, root), by doubling: each pass follows four pointers at once."""
    current, written = parents.select("v", "p"), None
    while True:
        twice = _follow(current).select("v", "p")
        following = keep(_follow(twice), "parents")
        drop_kept(written)
        current, written = following.select("v", "p"), following
        if following.where("moved").isEmpty():
            return current


def _follow(pointers: DataFrame) -> DataFrame:
    up = pointers.select(F.col("v").alias("p"), F.col("p").alias("_up"))
    target = F.coalesce("_up", "p")
    return pointers.join(up, "p", "left").select(
        "v", target.alias("p"), (target != F.col("p")).alias("moved")
    )


def contract(picks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept picks with ``root`` flag, and the (v, p) map of vertices to components."""
    hooked = keep(hook(picks), "picks")
    parent = F.when(F.col("root"), F.col("v")).otherwise(F.col("other")).alias("p")
    return hooked, flatten(hooked.select("v", parent))


def relabel(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by its component where the map has one."""
    new = labels.select(F.col("v").alias(column), F.col("p").alias("_new"))
    return rows.join(new, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def _lightest(edges: DataFrame) -> DataFrame:
    """Each component's lightest outgoing edge: (v, other, w, lo, hi)."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("v"), F.col("b").alias("other")),
                F.struct(F.col("b").alias("v"), F.col("a").alias("other")),
            )
        ).alias("e"),
        "w",
        "lo",
        "hi",
    )
    key = F.struct("w", "lo", "hi", F.col("e.other").alias("other"))
    return _best(ends.select(F.col("e.v").alias("v"), key.alias("edge")))


def _best(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("v").agg(F.min("edge").alias("edge")).select(
        "v", "edge.other", "edge.w", "edge.lo", "edge.hi"
    )


def _shrink(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Move edges to the contracted components; keep the lightest per component pair."""
    moved = relabel(relabel(edges, labels, "a"), labels, "b").where(F.col("a") != F.col("b"))
    return (
        moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .agg(F.min(F.struct("w", "lo", "hi")).alias("edge"))
        .select("a", "b", "edge.w", "edge.lo", "edge.hi")
    )


# -- trees -------------------------------------------------------------------


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lightest spanning forest (lo, hi, w) of a graph, and its (id, comp) labels."""
    ends = edges.select(F.explode(F.array("lo", "hi")).alias("id")).distinct()
    return _grow(ends.select("id", F.col("id").alias("comp")), edges, None)


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, comp) for every vertex, comp being the smallest id of the component."""
    start = vertices.select("id", F.col("id").alias("comp"))
    _, labels = _grow(start, edges, None)
    smallest = labels.groupBy("comp").agg(F.min("id").alias("first"))
    return labels.join(smallest, "comp").select("id", F.col("first").alias("comp"))


def _grow(labels: DataFrame, edges: DataFrame, search) -> tuple[DataFrame, DataFrame]:
    comp, edges = keep_all(
        components=labels,
        edges=edges.select(F.col("lo").alias("a"), F.col("hi").alias("b"), "w", "lo", "hi"),
    )
    left = comp.count()
    trees: list[DataFrame] = []
    first = True
    while left > 1:
        best = _lightest(edges)
        if search is not None:
            best = search(comp, keep(best, "lightest"), first)
        picked, labels_of = contract(best)
        added = picked.where(~F.col("root")).select("lo", "hi", "w")
        n = added.count()
        if n == 0:
            break
        trees.append(added)
        left -= n
        old_comp, old_edges = comp, edges
        comp, edges = keep_all(
            components=relabel(comp, labels_of, "comp").select("id", "comp"),
            edges=_shrink(edges, labels_of),
        )
        drop_kept(old_comp, old_edges, labels_of)
        first = False
    tree = trees[0] if trees else edges.select("lo", "hi", "w").limit(0)
    for part in trees[1:]:
        tree = tree.unionByName(part)
    return tree, comp


def spanning_tree(
    points: DataFrame,
    min_samples: int,
    id_col: str = "id",
    vector_col: str = "vec",
    knn: DataFrame | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Exact minimum spanning tree (lo, hi, w) of the mutual reachability distance.

    ``knn`` may hold an exact neighbour table of at least ``min_samples`` neighbours
    besides the point itself.  A longer list saves searches in the rounds.
    """
    points = points.select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec")
    )
    if knn is None:
        knn = knn_exact(
            points, points, k=2 * min_samples + 5, exclude_self=True, block_rows=block_rows
        )
    knn = keep(knn.where(F.col("src") != F.col("dst")), "knn")
    core = keep(core_distances(knn, min_samples), "core")
    edges = mutual_reachability(knn, core)
    reach = knn.groupBy(F.col("src").alias("id")).agg(F.sqrt(F.max("dist")).alias("reach"))
    scalars = keep(core.join(reach, "id"), "scalars")
    search = _ForeignSearch(points, scalars, block_rows)
    tree, _ = _grow(points.select("id", F.col("id").alias("comp")), edges, search)
    return tree


class _ForeignSearch:
    """Completes a round's picks with edges the neighbour graph does not hold."""

    def __init__(self, points: DataFrame, scalars: DataFrame, block_rows: int | None):
        self.scalars = scalars
        self.n = points.count()
        self.block_rows = block_rows or block_rows_for(points, self.n)
        n_cells = min(max(-(-self.n // self.block_rows), 1), 1024)
        self.centres = sample_centres(points, n_cells)
        celled = to_nearest_cells(points, self.centres, with_distance=True)
        self.rows = keep(celled.join(scalars.select("id", "core"), "id"), "celled")
        self.radii = cell_radii(self.rows, n_cells)
        id_type = points.schema["id"].dataType
        self.found = T.StructType(
            [
                T.StructField("v", id_type),
                T.StructField("w", T.DoubleType()),
                T.StructField("lo", id_type),
                T.StructField("hi", id_type),
                T.StructField("other", id_type),
            ]
        )

    def __call__(self, comp: DataFrame, best: DataFrame, first: bool) -> DataFrame:
        if first:
            active, asked = comp, best
        else:
            sizes = comp.groupBy("comp").agg(F.count("*").alias("n"))
            largest = sizes.orderBy(F.col("n").desc(), "comp").first()["comp"]
            active, asked = comp.where(F.col("comp") != largest), best.where(F.col("v") != largest)
        bounds = asked.select(F.col("v").alias("comp"), F.col("w").alias("bound"))
        need = keep(
            active.join(bounds, "comp", "left")
            .join(self.scalars, "id")
            .where(F.col("bound").isNull() | (F.col("reach") <= F.col("bound")))
            .select("id", "comp", "reach", "bound"),
            "unresolved",
        )
        asking, bounded = need.agg(F.count("*"), F.count("bound")).first()
        if asking == 0:
            return asked
        searched = self._search(comp, need, asking, bounded < asking)
        edge = F.struct("w", "lo", "hi", "other").alias("edge")
        return _best(asked.select("v", edge).unionByName(searched.select("v", edge)))

    def _search(self, comp: DataFrame, need: DataFrame, asking: int, unbounded: bool) -> DataFrame:
        wanted = self.rows.select("id", "vec", "core").join(need, "id")
        if unbounded:
            wanted = self._bounded_by_landmarks(comp, keep(wanted, "unbounded"))
        queries = wanted.select(
            "id", "vec", "core", "comp", F.coalesce("bound", F.lit(float("inf"))).alias("bound")
        )
        if len(self.centres) == 1:
            routed = queries.withColumn("cell", F.lit(0))
            train = self.rows
        else:
            routed = keep(to_cells_within(queries, self.centres, self.radii), "routed")
            cells = routed.select("cell").distinct()
            train = self.rows.join(F.broadcast(cells), "cell")  # at most 1024 cells
        train = train.select("id", "vec", "core", "cell").join(comp, "id")
        schema = self.found

        def func(a: pa.Table, b: pa.Table) -> pa.Table:
            return _lightest_between(a, b).cast(_arrow(schema))

        sizes = (asking, self.n)
        return pair_blocks(routed, train, func, schema, self.block_rows, len(self.centres) > 1, sizes)

    def _bounded_by_landmarks(self, comp: DataFrame, wanted: DataFrame) -> DataFrame:
        """Bound components without a known edge by their distance to sampled points.

        The sample has at most one row per cell (1024 rows) and is held by every task.
        """
        marks = (
            self.rows.orderBy(F.xxhash64("id"), "id").limit(1024)
            .join(comp, "id").select("vec", "core", "comp").toArrow()
        )
        shared = wanted.sparkSession.sparkContext.broadcast(
            (matrix(marks["vec"]), marks["core"].to_numpy(), marks["comp"].to_numpy())
        )
        schema = T.StructType([wanted.schema["comp"], T.StructField("near", T.DoubleType())])

        def run(batches):
            vec, core, label = shared.value
            for batch in batches:
                own = batch.column("comp").to_numpy(zero_copy_only=False)
                d = np.sqrt(squared(matrix(batch.column("vec")), vec))
                w = np.maximum(np.maximum(d, core[None, :]), batch.column("core").to_numpy()[:, None])
                w[own[:, None] == label[None, :]] = np.inf
                yield pa.RecordBatch.from_arrays(
                    [batch.column("comp"), pa.array(w.min(1))], names=["comp", "near"]
                )

        near = wanted.mapInArrow(run, schema).groupBy("comp").agg(F.min("near").alias("near"))
        # least() skips nulls; the slack covers the rounding of the product form.
        bound = F.least("bound", F.col("near") * (1 + 1e-6) + 1e-6)
        return wanted.join(near, "comp").withColumn("bound", bound).where(
            F.col("reach") <= F.col("bound")
        )


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _lightest_between(a: pa.Table, b: pa.Table) -> pa.Table:
    """Lightest mutual-reachability edge to a foreign component, per component of ``a``.

    Edges above the component's ``bound`` need not be found.
    """
    q, t = matrix(a["vec"]), matrix(b["vec"])
    q_id, t_id = a["id"].to_numpy(), b["id"].to_numpy()
    q_core, t_core = a["core"].to_numpy(), b["core"].to_numpy()
    q_comp, t_comp = a["comp"].to_numpy(), b["comp"].to_numpy()
    names, group = np.unique(q_comp, return_inverse=True)
    def first(rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of candidate pairs, the first in the exact (w, lo, hi) order per component."""
        w = np.sqrt(exact_pairs(q, t, rows, cols))
        w = np.maximum(np.maximum(w, q_core[rows]), t_core[cols])
        lo = np.minimum(q_id[rows], t_id[cols])
        hi = np.maximum(q_id[rows], t_id[cols])
        ranked = np.lexsort((hi, lo, w, group[rows])) if lo.dtype != object else np.array(
            sorted(range(len(rows)), key=lambda i: (group[rows[i]], w[i], lo[i], hi[i])), dtype=int
        )
        head = ranked[np.r_[True, np.diff(group[rows[ranked]]) != 0]] if len(ranked) else ranked
        return rows[head], cols[head], w[head]

    # Candidates up to rounding by squared weight, reduced to one per component before the next
    # tile, so that copies (whose edges all tie) hold no more than a tile.
    if fits(q) and fits(t) and fits(q_core) and fits(t_core):
        bound = a["bound"].to_numpy() if "bound" in a.column_names else np.full(len(q), np.inf)
        tiles = _near_single(q, t, q_core, t_core, q_comp, t_comp, group, bound)
    else:
        tiles = _near_double(q, t, q_core, t_core, q_comp, t_comp, group)
    found = []
    for r, c in tiles:
        # 50,000 candidates at a time, as each takes two whole vectors.
        for part in range(0, len(r), 50_000):
            found.append(first(r[part : part + 50_000], c[part : part + 50_000])[:2])
    rows = np.concatenate([x[0] for x in found]) if found else np.array([], dtype=int)
    cols = np.concatenate([x[1] for x in found]) if found else np.array([], dtype=int)
    rows, cols, w = first(rows, cols)
    return pa.table(
        {
            "v": q_comp[rows],
            "w": w,
            "lo": np.minimum(q_id[rows], t_id[cols]),
            "hi": np.maximum(q_id[rows], t_id[cols]),
            "other": t_comp[cols],
        }
    )


def _near_single(q, t, q_core, t_core, q_comp, t_comp, group, bound) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs by products in single precision, with room for their rounding."""
    # In the order of components, most tiles inside one component are left out whole.
    q_order, t_order = np.argsort(q_comp, kind="stable"), np.argsort(t_comp, kind="stable")
    q, q_core, q_comp, group, bound = (x[q_order] for x in (q, q_core, q_comp, group, bound))
    t, t_core, t_comp = (x[t_order] for x in (t, t_core, t_comp))
    scores = Scores(q, t)
    room = 1 + 1e-9
    lowest = np.full(group.max() + 1, np.inf)
    np.minimum.at(lowest, group, bound * bound * room)
    height, width = TILE_ROWS, TILE_COLS
    for s in range(0, len(q), height):
        rows = slice(s, min(s + height, len(q)))
        own, core2 = group[rows], q_core[rows] ** 2
        for at in range(0, len(t), width):
            cols = slice(at, min(at + width, len(t)))
            if q_comp[rows.start] == q_comp[rows.stop - 1] == t_comp[cols.start] == t_comp[cols.stop - 1]:
                continue
            d = scores.tile(rows, cols)
            r, c = places(d <= scores.limits(lowest[own], rows)[:, None])
            far = t_core[cols] ** 2
            keeps = (q_comp[rows][r] != t_comp[cols][c]) & (far[c] <= lowest[own[r]] * room)
            r, c = r[keeps], c[keeps]
            # The upper ends of the candidates' weights lower the limit, the lower ends then meet it.
            middle = d[r, c] + scores.lift[rows][r]
            wide = scores.error[rows][r]
            least = np.maximum(core2[r], far[c])
            above = np.maximum((middle + wide) * scores.scale * scores.scale, least)
            np.minimum.at(lowest, own[r], above * room)
            below = np.maximum((middle - wide) * scores.scale * scores.scale, least)
            keeps = below <= lowest[own[r]] * room
            yield q_order[r[keeps] + s], t_order[c[keeps] + at]


def _near_double(q, t, q_core, t_core, q_comp, t_comp, group) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same in double precision: for numbers that are not finite or very large."""
    lowest = np.full(group.max() + 1, np.inf)
    step = max(1, (1 << 21) // len(t))
    for s in range(0, len(q), step):
        w2 = np.maximum(squared(q[s:s + step], t), (t_core * t_core)[None, :])
        np.maximum(w2, (q_core[s:s + step] ** 2)[:, None], out=w2)
        w2[q_comp[s:s + step][:, None] == t_comp[None, :]] = np.inf
        np.minimum.at(lowest, group[s:s + step], w2.min(1))
        limit = lowest[group[s:s + step]]
        r, c = np.nonzero(np.isfinite(w2) & (w2 <= (limit + 1e-9 * (1 + limit))[:, None]))
        yield r + s, c


def density_cut(
    points: DataFrame, tree: DataFrame, epsilon: float, min_cluster_size: int
) -> DataFrame:
    """(id, label): clusters at one fixed distance, a horizontal cut of the tree.

    The label is the smallest id of the cluster; clusters below the minimum size
    and single points get -1.
    """
    comp = components(points.select("id"), tree.where(F.col("w") <= epsilon))
    sizes = comp.groupBy("comp").agg(F.count("*").alias("n"))
    label = F.when(F.col("n") >= min_cluster_size, F.col("comp")).otherwise(F.lit(-1))
    return comp.join(sizes, "comp").select("id", label.alias("label"))
