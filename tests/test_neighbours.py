import numpy as np
import pytest

from topicloom.operators import neighbours
from topicloom.operators.neighbours import as_lists, from_lists, knn_exact, knn_lists


def brute(q, t, k, exclude_self=False, max_dist=None):
    out = set()
    for i, a in q:
        pairs = sorted((float(((a - b) ** 2).sum()), j) for j, b in t if not (exclude_self and i == j))
        for rank, (d, j) in enumerate(pairs[:k], 1):
            if max_dist is None or d <= max_dist:
                out.add((i, j, rank, round(d, 9)))
    return out


def table(spark, points):
    return spark.createDataFrame([(i, v.tolist()) for i, v in points], "id long, vec array<double>")


def result(df):
    return {(r.src, r.dst, r.rank, round(r.dist, 9)) for r in df.collect()}


@pytest.fixture(scope="module")
def clouds():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 5)) * 8
    t = [(i, centres[i % 6] + rng.normal(size=5)) for i in range(300)]
    t += [(300 + i, t[3][1].copy()) for i in range(150)]  # one hot vector
    q = [(i, t[i][1]) for i in range(0, 450, 3)]
    return q, t


@pytest.mark.parametrize("block_rows", [10_000, 40])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_exact_matches_brute_force(spark, clouds, block_rows, exclude_self):
    q, t = clouds
    got = knn_exact(
        table(spark, q), table(spark, t), k=7, exclude_self=exclude_self, block_rows=block_rows
    )
    assert result(got) == brute(q, t, 7, exclude_self)


def test_exact_with_cap(spark, clouds):
    q, t = clouds
    got = knn_exact(table(spark, q), table(spark, t), k=5, max_dist=2.0, block_rows=40)
    assert result(got) == brute(q, t, 5, max_dist=2.0)


def test_lists_with_all_probes_are_exact(spark, clouds):
    q, t = clouds
    got = knn_lists(table(spark, q), table(spark, t), k=4, n_lists=8, n_probe=8, block_rows=64)
    assert result(got) == brute(q, t, 4)


def test_lists_recall(spark, clouds):
    q, t = clouds
    got = result(knn_lists(table(spark, q), table(spark, t), k=4, n_lists=8, n_probe=2))
    want = brute(q, t, 4)
    assert len(got & want) / len(want) > 0.9


def test_string_ids(spark):
    t = [(f"d{i:03d}", np.array([float(i), 0.0])) for i in range(20)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in t], "id string, vec array<double>")
    rows = knn_exact(df, df, k=2, block_rows=6).where("src = 'd007'").orderBy("rank").collect()
    assert [r.dst for r in rows] == ["d007", "d006"]


def test_list_columns_round_trip(spark, clouds):
    q, t = clouds
    edges = knn_exact(table(spark, q), table(spark, t), k=3)
    assert result(from_lists(as_lists(edges))) == result(edges)


@pytest.mark.parametrize("scale", [1e-20, 1.0, 1e20])
@pytest.mark.parametrize("copies", [False, True])
def test_block_search_in_single_precision_is_exact(monkeypatch, scale, copies):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 16)
    monkeypatch.setattr(neighbours, "TILE_COLS", 32)
    rng = np.random.default_rng(3)
    t = (rng.integers(0, 3, (150, 4)) if copies else rng.normal(size=(150, 4))) * scale
    q = np.r_[t[:40], rng.normal(size=(20, 4)) * scale]
    ids, t_ids = np.arange(60), rng.permutation(150)
    d = ((q[:, None] - t[None]) ** 2).sum(-1)
    bounds = np.sort(d, axis=1)[:, 25]
    for bound in (None, bounds):
        src, dst, dist = neighbours.block_search(ids, q, t_ids, t, 7, None, True, bound)
        for i in ids:
            near = sorted((x, j) for x, j in zip(d[i], t_ids) if j != i and (bound is None or x <= bound[i]))
            assert dst[src == i].tolist() == [j for _, j in near[:7]]
            assert np.allclose(dist[src == i], [x for x, _ in near[:7]], rtol=1e-12, atol=0)


def test_bound_leaves_few_candidates_to_compare(monkeypatch):
    rng = np.random.default_rng(4)
    q, t = rng.normal(size=(64, 8)), rng.normal(size=(8192, 8))
    compared = []

    def counted(a, b, rows, cols):
        compared.append(len(rows))
        return exact(a, b, rows, cols)

    exact = neighbours.exact_pairs
    monkeypatch.setattr(neighbours, "exact_pairs", counted)
    bounds = np.sort(((q[:, None] - t[None]) ** 2).sum(-1), axis=1)[:, 3]
    src, _, _ = neighbours.block_search(np.arange(64), q, np.arange(8192), t, 10, None, False, bounds)
    assert len(src) == 64 * 4 and sum(compared) <= 64 * 5
