import numpy as np

from topicloom.operators.dendrogram import merge_sizes, merge_tree


def kruskal(edges, n):
    parent, size, out = list(range(n)), [1] * n, []

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for w, a, b in sorted((w, a, b) for a, b, w in edges):
        a, b = find(a), find(b)
        out.append((w, min(size[a], size[b]), max(size[a], size[b])))
        parent[b] = a
        size[a] += size[b]
    return out


def random_tree(rng, n, path=False):
    w = rng.permutation(n - 1).astype(float)
    order = rng.permutation(n)
    return [
        (int(min(u, v)), int(max(u, v)), float(w[i - 1]))
        for i in range(1, n)
        for u, v in [(order[i], order[i - 1] if path else order[rng.integers(0, i)])]
    ]


def test_sizes_match_kruskal(spark):
    rng = np.random.default_rng(5)
    for n, path in [(2, False), (60, False), (90, True)]:
        edges = random_tree(rng, n, path)
        if n == 60:  # equal weights are ordered by the end points
            edges = [(a, b, float(int(w) // 4)) for a, b, w in edges]
        df = spark.createDataFrame(edges, "lo long, hi long, w double")
        tree = merge_tree(df)
        assert tree.n == n
        got = [(r.w, r.small, r.large) for r in merge_sizes(tree).orderBy("e").collect()]
        assert got == kruskal(edges, n)
