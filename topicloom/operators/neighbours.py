"""k-nearest-neighbour joins, exact and by inverted lists.

Both share one core.  Train rows lie in cells; each query is routed to the cells
it must search; each cell is cut into blocks of a bounded number of rows, on both
sides, so that no task ever holds more than one block pair however full a cell is.
A block pair gives at most k rows per query, and a ranked window merges them.

The exact join routes in two passes: the query's own cell first, which bounds its
k-th distance, then only those cells whose nearest possible point (triangle
inequality on centre distance and radius) is within that bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.workspace import keep, parallelism

# Largest number of cells; centres and radii are held by every task.
MAX_CELLS = 16_384
MAX_CENTRE_BYTES = 256 << 20
BLOCK_ROWS = 8_192
# Distance-matrix entries computed at a time inside a task.
_TILE = 1 << 21
# Those of a tile in single precision, which should stay in the processor's cache.
TILE_ROWS, TILE_COLS = 512, 2_048
# Largest block of an exact search; a vector is sent to every block it may have a neighbour in.
MOST_ROWS, MOST_BYTES = 32_768, 16 << 20


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column -> (rows, dims) array without a copy per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances by the product form (fast, rounding of about 1e-15)."""
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


def exact_pairs(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Squared distances of listed pairs by the difference form, in bounded slices."""
    out = np.empty(len(rows))
    step = max(1, (1 << 22) // max(a.shape[1], 1))
    for s in range(0, len(rows), step):
        diff = a[rows[s:s + step]] - b[cols[s:s + step]]
        out[s:s + step] = (diff * diff).sum(1)
    return out


def best_per_row(rows: np.ndarray, k: int) -> np.ndarray:
    """Mask of the first k entries of each run in the sorted array ``rows``."""
    starts = np.r_[0, np.flatnonzero(np.diff(rows)) + 1] if len(rows) else np.zeros(0, int)
    lengths = np.diff(np.r_[starts, len(rows)])
    return np.arange(len(rows)) - np.repeat(starts, lengths) < k


def block_search(
    q_ids: np.ndarray,
    q: np.ndarray,
    t_ids: np.ndarray,
    t: np.ndarray,
    k: int,
    max_dist: float | None,
    exclude_self: bool,
    bounds: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k nearest train rows for each query of one block pair, ordered (dist, id).

    Only rows within ``bounds`` (a squared distance per query) are returned.  Products in
    single precision name the candidates, with room for their rounding; distances in double
    precision decide.
    """
    order = np.argsort(t_ids, kind="stable")
    t_ids, t = t_ids[order], t[order]
    caps = np.full(len(q), np.inf) if bounds is None else bounds.astype(float)
    if max_dist is not None:
        caps = np.minimum(caps, max_dist)
    search = _single if fits(q) and fits(t) else _double
    found = search(q_ids, q, t_ids, t, k, caps, exclude_self)
    return tuple(np.concatenate(part) for part in zip(*found))


def fits(a: np.ndarray) -> bool:
    """All numbers are finite and their squares far from the largest one."""
    return bool((np.abs(a) < 1e100).all())


class Scores:
    """Squared distances up to a constant per query, in single precision.

    Centred and scaled, |a - b|^2 - |a|^2 is one product of the rows (-2a, 1) and (b, |b|^2).
    ``error`` bounds its rounding per query, ``lift`` is the constant (both in scaled units).
    """

    def __init__(self, q: np.ndarray, t: np.ndarray):
        centre = t.mean(0)
        q, t = q - centre, t - centre
        self.scale = max(np.sqrt((q * q).sum(1)).max(), np.sqrt((t * t).sum(1)).max()) or 1.0
        q, t = q / self.scale, t / self.scale
        self.lift, squares = (q * q).sum(1), (t * t).sum(1)
        reach = np.sqrt(self.lift) + np.sqrt(squares.max())
        dims = q.shape[1] + 8
        far = np.sqrt((centre * centre).sum()) / self.scale + reach
        self.error = dims * reach * (2.0**-22 * reach + 1e-15 * far) + 1e-30
        self._q = np.c_[-2.0 * q, np.ones(len(q))].astype(np.float32)
        self._t = np.c_[t, squares].astype(np.float32)

    def tile(self, rows: slice, cols: slice) -> np.ndarray:
        return self._q[rows] @ self._t[cols].T

    def limits(self, caps: np.ndarray, rows: slice) -> np.ndarray:
        """Scores that squared distances up to ``caps`` cannot exceed."""
        scaled = caps / self.scale / self.scale
        out = scaled * (1 + 1e-9) - self.lift[rows] + self.error[rows]
        return np.nextafter(np.minimum(out, 1e30).astype(np.float32), np.float32(np.inf))


def _single(q_ids, q, t_ids, t, k, caps, exclude_self):
    scores = Scores(q, t)
    for s in range(0, len(q), TILE_ROWS):
        rows = slice(s, min(s + TILE_ROWS, len(q)))
        part, own, cap = q[rows], q_ids[rows], caps[rows]
        limit = scores.limits(cap, rows)
        held, waiting = _nothing(), []

        def settle():
            r, c = (np.concatenate(x) for x in zip(*waiting))
            if exclude_self:
                other = own[r] != t_ids[c]
                r, c = r[other], c[other]
            dist = exact_pairs(part, t, r, c)
            near = dist <= cap[r]
            r, c, dist = (np.concatenate(x) for x in zip(held, (r[near], c[near], dist[near])))
            ranked = np.lexsort((c, dist, r))
            top = ranked[best_per_row(r[ranked], k)]
            return r[top], c[top], dist[top]

        for at in range(0, len(t), TILE_COLS):
            cols = slice(at, min(at + TILE_COLS, len(t)))
            d = scores.tile(rows, cols)
            r, c = places(d <= limit[:, None])
            # Of the rows with many candidates, the k-th smallest score lowers the limit.
            many = np.flatnonzero(np.bincount(r, minlength=len(part)) > k + 1)
            if len(many):
                crowd = d[many]
                if exclude_self:
                    crowd[own[many][:, None] == t_ids[None, cols]] = np.inf
                if crowd.shape[1] > k:
                    kth = np.partition(crowd, k - 1, axis=1)[:, k - 1].astype(float)
                    kth = np.where(np.isfinite(kth), kth + 2 * scores.error[rows][many], np.inf)
                    kth = np.nextafter(kth.astype(np.float32), np.float32(np.inf))
                    limit[many] = np.minimum(limit[many], kth)
                    stays = d[r, c] <= limit[r]
                    r, c = r[stays], c[stays]
            waiting.append((r, c + at))
            # Copies all tie: what waits never exceeds a tile by much.
            if sum(len(w[0]) for w in waiting) > TILE_ROWS * TILE_COLS // 4:
                held, waiting = settle(), []
                full = np.flatnonzero(np.bincount(held[0], minlength=len(part)) == k)
                last = np.searchsorted(held[0], full, side="right") - 1
                kth = np.full(len(part), np.inf)
                kth[full] = held[2][last]
                cap = np.minimum(cap, kth)
                limit = np.minimum(limit, scores.limits(cap, rows))
        if waiting:
            held = settle()
        yield own[held[0]], t_ids[held[1]], held[2]


def places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.nonzero``, faster where little is set."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def _nothing():
    return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)


def _double(q_ids, q, t_ids, t, k, caps, exclude_self):
    """The same in double precision: for numbers that are not finite or very large."""
    step = max(1, _TILE // len(t_ids))
    for s in range(0, len(q_ids), step):
        part, cap = q[s:s + step], caps[s:s + step]
        d = squared(part, t)
        if exclude_self:
            d[q_ids[s:s + step][:, None] == t_ids[None, :]] = np.inf
        limit = np.full(len(part), np.inf)
        if len(t_ids) > k:
            limit = np.partition(d, k - 1, axis=1)[:, k - 1]
        limit = np.minimum(limit, cap)
        # The slack lets every tie through; exact distances then decide.
        mask = np.isfinite(d) & (d <= (limit + 1e-9 * (1.0 + limit))[:, None])
        rows, cols = np.nonzero(mask)
        dist = exact_pairs(part, t, rows, cols)
        near = dist <= cap[rows]
        rows, cols, dist = rows[near], cols[near], dist[near]
        ranked = np.lexsort((cols, dist, rows))
        rows, cols, dist = rows[ranked], cols[ranked], dist[ranked]
        top = best_per_row(rows, k)
        yield q_ids[s + rows[top]], t_ids[cols[top]], dist[top]


def _chunk(id_col: str, count) -> F.Column:
    return F.pmod(F.xxhash64(id_col), count).cast("int")


def pair_blocks(
    queries: DataFrame,
    train: DataFrame,
    func: Callable[[pa.Table, pa.Table], pa.Table],
    schema: T.StructType,
    block_rows: int = BLOCK_ROWS,
    cells: bool = True,
    rows: tuple[int, int] | None = None,
) -> DataFrame:
    """Run ``func`` on every (query block, train block) pair that shares a cell.

    Both inputs have ``id`` and, with ``cells``, an integer ``cell``.  Rows fall
    into blocks by a hash of their id, so a retried task sees the same block.
    Without cells, ``rows`` gives the row counts of both sides if they are known.
    """
    spark = queries.sparkSession

    def blocks(n, at_least: int = 1):
        return F.greatest(F.ceil(n / block_rows), F.lit(at_least)).cast("int")

    if cells:
        sizes = (
            queries.groupBy("cell").agg(F.count("*").alias("nq"))
            .join(train.groupBy("cell").agg(F.count("*").alias("nt")), "cell")
            .select("cell", blocks(F.col("nq")).alias("qb"), blocks(F.col("nt")).alias("tb"))
        )
        sizes = F.broadcast(sizes)  # at most MAX_CELLS rows
        queries, train = queries.join(sizes, "cell"), train.join(sizes, "cell")
    else:
        nq, nt = rows or (queries.count(), train.count())
        # Even a small input should use all cores, in blocks of a few hundred rows.
        spread = max(1, min(parallelism(spark), nq // 256))
        counts = {
            "cell": F.lit(0),
            "qb": blocks(F.lit(nq), spread),
            "tb": blocks(F.lit(nt)),
        }
        queries, train = queries.withColumns(counts), train.withColumns(counts)

    left = (
        queries.withColumn("qc", _chunk("id", F.col("qb")))
        .withColumn("tc", F.explode(F.sequence(F.lit(0), F.col("tb") - 1)))
        .drop("qb", "tb")
    )
    right = (
        train.withColumn("tc", _chunk("id", F.col("tb")))
        .withColumn("qc", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)))
        .drop("qb", "tb")
    )

    def both(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows == 0 or b.num_rows == 0:
            return empty
        return func(a, b)

    empty = _empty_table(schema)
    # Fresh column identities: both sides may stem from the same table.
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    # Key columns must have the same types on both sides, or rows silently miss.
    keys = ["cell", "qc", "tc"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(both, schema)


def _empty_table(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()


def _knn_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("src", id_type),
            T.StructField("dst", id_type),
            T.StructField("dist", T.DoubleType()),
        ]
    )


def _search(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    max_dist: float | None,
    exclude_self: bool,
    block_rows: int,
    cells: bool,
) -> DataFrame:
    schema = _knn_schema(train.schema["id"].dataType)
    empty = _empty_table(schema)

    def func(a: pa.Table, b: pa.Table) -> pa.Table:
        src, dst, dist = block_search(
            a["id"].to_numpy(), matrix(a["vec"]), b["id"].to_numpy(), matrix(b["vec"]),
            k, max_dist, exclude_self, a["cap"].to_numpy() if "cap" in a.column_names else None,
        )
        return pa.table([src, dst, dist], names=["src", "dst", "dist"]).cast(empty.schema)

    return pair_blocks(queries, train, func, schema, block_rows, cells)


def nearest(edges: DataFrame, k: int) -> DataFrame:
    """(src, dst, rank, dist): the k smallest (dist, dst) per src, ranked from 1."""
    order = Window.partitionBy("src").orderBy("dist", "dst")
    ranked = edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("src", "dst", "rank", "dist")


def _points(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return rows.select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec")
    )


def _check_centres(centres: np.ndarray) -> np.ndarray:
    if len(centres) > MAX_CELLS or centres.nbytes > MAX_CENTRE_BYTES:
        raise ValueError("too many or too wide cell centres to hold in every task")
    return centres


def sample_centres(points: DataFrame, count: int) -> np.ndarray:
    """``count`` points in hash order; at most MAX_CELLS rows reach the driver."""
    rows = (
        points.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(min(count, MAX_CELLS))
    ).toArrow()
    return _check_centres(matrix(rows["vec"]))


def kmeans_centres(points: DataFrame, count: int, seed: int = 42) -> np.ndarray:
    """k-means centres, trained on all points."""
    train = points.select(array_to_vector("vec").alias("features"))
    model = KMeans(k=count, seed=seed, initMode="random", maxIter=10).fit(train)
    return _check_centres(np.array(model.clusterCenters()))


def _route(
    rows: DataFrame,
    centres: np.ndarray,
    pick: Callable[[pa.Table, np.ndarray], tuple[np.ndarray, np.ndarray]],
    with_distance: bool = False,
) -> DataFrame:
    """Copy each row to the cells that ``pick`` names for it."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    extra = [T.StructField("cell", T.IntegerType())]
    if with_distance:
        extra.append(T.StructField("radius", T.DoubleType()))
    schema = T.StructType(list(rows.schema.fields) + extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, _TILE // len(shared.value))
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                d = np.sqrt(squared(matrix(part.column("vec")), shared.value))
                r, c = pick(part, d)
                out = pa.Table.from_batches([part]).take(pa.array(r))
                out = out.append_column("cell", pa.array(c.astype(np.int32)))
                if with_distance:
                    out = out.append_column("radius", pa.array(d[r, c]))
                yield from out.combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def to_nearest_cells(rows: DataFrame, centres: np.ndarray, n: int = 1, **kw) -> DataFrame:
    n = min(n, len(centres))

    def pick(part: pa.RecordBatch, d: np.ndarray):
        near = np.argpartition(d, n - 1, axis=1)[:, :n]
        return np.repeat(np.arange(len(d)), n), near.ravel()

    return _route(rows, centres, pick, **kw)


def cell_radii(celled: DataFrame, count: int) -> np.ndarray:
    """Largest distance to the centre per cell (-inf where a cell is empty)."""
    radii = np.full(count, -np.inf)
    for cell, radius in celled.groupBy("cell").agg(F.max("radius")).collect():  # <= MAX_CELLS
        radii[cell] = radius
    return radii


def to_cells_within(
    rows: DataFrame, centres: np.ndarray, radii: np.ndarray, skip: str | None = None
) -> DataFrame:
    """Route to every cell that may hold a point within ``bound`` of the row."""

    def pick(part: pa.RecordBatch, d: np.ndarray):
        bound = part.column("bound").to_numpy(zero_copy_only=False)
        mask = d - radii[None, :] <= (bound + 1e-9 * (1.0 + np.abs(bound)))[:, None]
        mask &= np.isfinite(radii)[None, :]
        if skip is not None:
            mask[np.arange(len(d)), part.column(skip).to_numpy()] = False
        return np.nonzero(mask)

    return _route(rows, centres, pick)


def block_rows_for(points: DataFrame, n: int) -> int:
    """Rows of a block: more for a larger table, within a bounded number of bytes."""
    least = BLOCK_ROWS
    if n <= 24 * least:
        return least
    dims = points.agg(F.max(F.size("vec"))).first()[0] or 1
    return max(least, min(-(-n // 24), MOST_ROWS, MOST_BYTES // (8 * max(dims, 1))))


def knn_exact(
    queries: DataFrame,
    train: DataFrame,
    k: int = 10,
    id_col: str = "id",
    vector_col: str = "vec",
    max_dist: float | None = None,
    exclude_self: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Exact (src, dst, rank, dist) with squared Euclidean distance.

    ``max_dist`` drops farther neighbours inside the block search already.  Blocks grow with
    the table up to a bound, as every vector is copied to every block it may have to meet.
    """
    q, t = _points(queries, id_col, vector_col), _points(train, id_col, vector_col)
    n = t.count()
    if block_rows is None:
        block_rows = block_rows_for(t, n)
    n_cells = min(-(-n // block_rows), 1024)
    if n_cells <= 1:
        return nearest(_search(q, t, k, max_dist, exclude_self, block_rows, cells=False), k)

    centres = sample_centres(t, n_cells)
    celled = keep(to_nearest_cells(t, centres, with_distance=True), "knn-train")
    own = keep(to_nearest_cells(q, centres), "knn-queries")
    first = keep(
        nearest(
            _search(own, celled.drop("radius"), k, max_dist, exclude_self, block_rows, True), k
        ),
        "knn-first",
    )
    # The k-th distance so far; no bound yet where fewer than k were found.
    bounds = first.where(F.col("rank") == k).select(F.col("src").alias("id"), F.col("dist").alias("cap"))
    cap = float("inf") if max_dist is None else float(max_dist)
    bounded = (
        own.withColumnRenamed("cell", "own")
        .join(bounds, "id", "left")
        .withColumn("cap", F.coalesce("cap", F.lit(cap)))
        .withColumn("bound", F.sqrt("cap"))
    )
    rest = keep(
        to_cells_within(bounded, centres, cell_radii(celled, len(centres)), skip="own")
        .select("id", "vec", "cell", "cap"),
        "knn-routed",
    )
    more = _search(rest, celled.drop("radius"), k, max_dist, exclude_self, block_rows, True)
    return nearest(first.select("src", "dst", "dist").unionByName(more), k)


def knn_lists(
    queries: DataFrame,
    train: DataFrame,
    k: int = 10,
    id_col: str = "id",
    vector_col: str = "vec",
    n_lists: int = 100,
    n_probe: int = 10,
    max_dist: float | None = None,
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    seed: int = 42,
    centres: np.ndarray | None = None,
) -> DataFrame:
    """Approximate neighbours: search only the ``n_probe`` lists nearest to the query.

    The lists belong to ``n_lists`` k-means centres of the train rows, or to the given
    ``centres``.  With ``n_probe`` equal to the number of lists the result is exact.
    """
    q, t = _points(queries, id_col, vector_col), _points(train, id_col, vector_col)
    centres = kmeans_centres(t, n_lists, seed) if centres is None else _check_centres(centres)
    celled = keep(to_nearest_cells(t, centres), "ivf-train")
    routed = keep(to_nearest_cells(q, centres, n_probe), "ivf-queries")
    return nearest(_search(routed, celled, k, max_dist, exclude_self, block_rows, True), k)


def as_lists(edges: DataFrame) -> DataFrame:
    """One row per src: ``knn_ind`` and ``knn_dist`` in rank order (at most k long)."""
    listed = F.sort_array(F.collect_list(F.struct("rank", "dst", "dist")))
    return edges.groupBy(F.col("src").alias("id")).agg(
        listed["dst"].alias("knn_ind"), listed["dist"].alias("knn_dist")
    )


def from_lists(rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Edge table back from the two list columns."""
    zipped = F.posexplode(F.arrays_zip("knn_ind", "knn_dist"))
    return rows.select(F.col(id_col).alias("src"), zipped.alias("pos", "e")).select(
        "src",
        F.col("e.knn_ind").alias("dst"),
        (F.col("pos") + 1).alias("rank"),
        F.col("e.knn_dist").alias("dist"),
    )
