import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicloom.operators import spanning
from topicloom.operators.spanning import (
    components,
    density_cut,
    spanning_forest,
    spanning_tree,
)


def prim(x, min_samples):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, min(min_samples, len(x) - 1)]  # column 0 is the point itself
    m = np.maximum(np.maximum(core[:, None], core[None]), d)
    best, done, out = m[0].copy(), np.zeros(len(x), bool), []
    done[0] = True
    for _ in range(len(x) - 1):
        best[done] = np.inf
        j = int(np.argmin(best))
        out.append(best[j])
        done[j] = True
        best = np.where(done, np.inf, np.minimum(best, m[j]))
    return np.sort(out)


def table(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")


@pytest.mark.parametrize("block_rows", [10_000, 30])
def test_tree_weights_match_prim(spark, block_rows):
    rng = np.random.default_rng(3)
    # Far groups: the neighbour graph alone falls apart, so the search must connect them.
    x = np.concatenate([rng.normal(size=(40, 3)) + 30 * g for g in range(3)] + [rng.normal(size=(20, 3)) * 40])
    tree = spanning_tree(table(spark, x), min_samples=4, block_rows=block_rows).collect()
    assert len(tree) == len(x) - 1
    assert np.allclose(np.sort([r.w for r in tree]), prim(x, 4))
    seen = {r.lo for r in tree} | {r.hi for r in tree}
    assert seen == set(range(len(x)))


def test_line(spark):
    x = np.array([[0.0], [1.0], [3.0], [7.0]])
    tree = spanning_tree(table(spark, x), min_samples=1).orderBy("w").collect()
    assert [(r.lo, r.hi, r.w) for r in tree] == [(0, 1, 1.0), (1, 2, 2.0), (2, 3, 4.0)]


def test_copies_have_weight_zero(spark):
    x = np.array([[0.0, 0.0]] * 6 + [[5.0, 0.0]] * 4)
    tree = spanning_tree(table(spark, x), min_samples=2)
    assert sorted(r.w for r in tree.collect()) == [0.0] * 8 + [5.0]


def test_forest_and_components(spark):
    edges = spark.createDataFrame(
        [(1, 2, 1.0), (2, 3, 2.0), (1, 3, 3.0), (5, 6, 1.0)], "lo long, hi long, w double"
    )
    tree, _ = spanning_forest(edges)
    assert sorted((r.lo, r.hi) for r in tree.collect()) == [(1, 2), (2, 3), (5, 6)]
    got = components(spark.createDataFrame([(i,) for i in (1, 2, 3, 5, 6, 9)], "id long"), edges)
    assert {r.id: r.comp for r in got.collect()} == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 9: 9}


def test_density_cut(spark):
    points = spark.createDataFrame([(i,) for i in range(6)], "id long")
    tree = spark.createDataFrame(
        [(0, 1, 0.5), (1, 2, 0.6), (2, 3, 4.0), (3, 4, 0.7), (4, 5, 9.0)],
        "lo long, hi long, w double",
    )
    got = {r.id: r.label for r in density_cut(points, tree, 1.0, 3).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: -1, 4: -1, 5: -1}


def test_copies_hold_one_tile_of_memory():
    """All edges between copies tie; they must not pile up over the tiles of a block pair."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from topicloom.operators.spanning import _lightest_between

    n = 3000
    rows = pa.table(
        {
            "id": np.arange(n),
            "vec": pa.array([[1.0, 2.0]] * n),
            "core": np.zeros(n),
            "comp": np.arange(n),
        }
    )
    tracemalloc.start()
    found = _lightest_between(rows, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250e6
    got = {r["v"]: (r["w"], r["lo"], r["hi"]) for r in found.to_pylist()}
    assert got[0] == (0.0, 0, 1) and got[7] == (0.0, 0, 7) and len(got) == n


def test_lightest_between_within_a_bound_matches_brute_force(monkeypatch):
    monkeypatch.setattr(spanning, "TILE_ROWS", 16)
    monkeypatch.setattr(spanning, "TILE_COLS", 32)
    rng = np.random.default_rng(5)
    for grid in (False, True):
        q, t = ((rng.integers(0, 3, (n, 3)) if grid else rng.normal(size=(n, 3))).astype(float) for n in (70, 130))
        q_core, t_core = rng.random(70), rng.random(130)
        q_comp, t_comp = rng.integers(0, 5, 70), rng.integers(0, 5, 130)
        w = np.maximum(np.sqrt(((q[:, None] - t[None]) ** 2).sum(-1)), np.maximum(q_core[:, None], t_core[None]))
        best = {}
        for i in range(70):
            for j in range(130):
                if q_comp[i] != t_comp[j]:
                    edge = (w[i, j], i, 100 + j, t_comp[j])
                    best[q_comp[i]] = min(best.get(q_comp[i], edge), edge)
        bound = np.array([best[c][0] for c in q_comp])
        for limit in (bound, 2 * bound, np.full(70, np.inf)):
            left = pa.table({"id": np.arange(70), "vec": list(q), "core": q_core, "comp": q_comp, "bound": limit})
            right = pa.table({"id": np.arange(100, 230), "vec": list(t), "core": t_core, "comp": t_comp})
            for row in spanning._lightest_between(left, right).to_pylist():
                edge = best[row["v"]]
                assert (row["lo"], row["hi"], row["other"]) == edge[1:] and abs(row["w"] - edge[0]) < 1e-12
