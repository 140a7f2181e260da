import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators.dendrogram import merge_tree
from topicloom.operators.density import cluster_labels, clustering_metrics, coverage, hdbscan


class Brute:
    """Plain single-process density clustering of a given tree, for comparison."""

    def __init__(self, edges, n, mcs, eps=0.0):
        self.mcs, self.kids, self.size, self.w = mcs, {}, {i: 1 for i in range(n)}, {}
        top = list(range(n))
        for e, (w, a, b) in enumerate(sorted((w, a, b) for a, b, w in edges)):
            ra, rb = top[a], top[b]
            node = n + e
            self.kids[node], self.size[node], self.w[node] = (ra, rb), self.size[ra] + self.size[rb], w
            top = [node if t in (ra, rb) else t for t in top]
        self.n, self.clusters = n, []
        self._cluster(n + len(edges) - 1, None, 0.0)
        self._select()
        self.label = np.full(n, -1)
        final = [c for c in self.clusters if c["chosen"]]
        if eps > 0:
            final = list({id(c): c for c in (self._up(c, eps) for c in final)}.values())
        for c in final:
            self.label[c["points"]] = min(c["points"])

    def points(self, x):
        return [x] if x < self.n else self.points(self.kids[x][0]) + self.points(self.kids[x][1])

    def _cluster(self, node, parent, birth):
        c = dict(parent=parent, birth=birth, kids=[], stab=0.0, points=self.points(node), chosen=False)
        self.clusters.append(c)
        while True:
            lam = 1 / max(self.w[node], 1e-12)
            big = [k for k in self.kids[node] if self.size[k] >= self.mcs]
            if len(big) == 2:
                c["stab"] += self.size[node] * (lam - birth)
                c["kids"] = [self._cluster(k, c, lam) for k in self.kids[node]]
                return c
            c["stab"] += sum(self.size[k] for k in self.kids[node] if k not in big) * (lam - birth)
            if not big:
                return c
            node = big[0]

    def _select(self):
        def visit(c):
            below = sum(visit(k) for k in c["kids"])
            wins = c["parent"] is not None and (not c["kids"] or c["stab"] >= below)
            if wins:
                self._clear(c)
                c["chosen"] = True
                return c["stab"]
            return below

        visit(self.clusters[0])

    def _clear(self, c):
        for k in c["kids"]:
            k["chosen"] = False
            self._clear(k)

    def _up(self, c, eps):
        if 1 / c["birth"] >= eps:
            return c
        while c["parent"]["parent"] is not None:
            c = c["parent"]
            if 1 / c["birth"] > eps:
                return c
        return c


def same_partition(got, want):
    pairs = {(got[i], want[i]) for i in range(len(want))}
    assert len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
    assert all((a == -1) == (b == -1) for a, b in pairs)


def random_tree(rng, n, groups):
    """Light edges inside groups, heavier between them, some outliers."""
    out = []
    for i in range(1, n):
        j = int(rng.integers(max(0, i - 8), i))
        w = rng.random() + (rng.random() * 6 if rng.random() < groups else 0)
        out.append((j, i, float(w) + 0.01))
    return out


@pytest.mark.parametrize("seed,mcs,eps", [(1, 4, 0.0), (2, 3, 0.0), (3, 3, 2.5), (4, 200, 0.0)])
def test_labels_match_plain_clustering(spark, seed, mcs, eps):
    rng = np.random.default_rng(seed)
    edges = random_tree(rng, 150, 0.25)
    tree = merge_tree(spark.createDataFrame(edges, "lo long, hi long, w double"))
    got = {r.id: r.label for r in cluster_labels(tree, mcs, eps).collect()}
    assert len(got) == 150
    if mcs > 150:
        assert set(got.values()) == {-1}
        return
    same_partition(got, Brute(edges, 150, mcs, eps).label.tolist())


def test_planted_groups(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate(
        [rng.normal(size=(m, 2)) * 0.2 + c for m, c in [(30, (0, 0)), (25, (6, 0)), (20, (0, 7))]]
        + [np.array([[20.0, 20], [-20, 15], [15, -20], [-25, -25], [40, 0]])]
    )
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    labels = hdbscan(df, min_cluster_size=10, min_samples=5).collect()
    got = {r.id: r.label for r in labels}
    assert {got[i] for i in range(30)} == {0}
    assert {got[i] for i in range(30, 55)} == {1}
    assert {got[i] for i in range(55, 75)} == {2}
    assert {got[i] for i in range(75, 80)} == {-1}


def test_metrics(spark):
    labels = spark.createDataFrame(
        [(0, 0), (1, 0), (2, 1), (3, 1), (4, -1)], "id long, label int"
    )
    tree = spark.createDataFrame(
        [(0, 1, 1.0), (1, 2, 4.0), (2, 3, 2.0), (3, 4, 9.0)], "lo long, hi long, w double"
    )
    row = clustering_metrics(labels, tree).first()
    assert row.topic_count == 2 and row.coverage == pytest.approx(0.8)
    assert row.validity == pytest.approx(0.4 * (4 - 1) / 4 + 0.4 * (4 - 2) / 4)
    assert coverage(labels).first().coverage == pytest.approx(0.8)
