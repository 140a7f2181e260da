import numpy as np
from pyspark.sql import functions as F

from topicloom.llm import embedding_dedup as near


def brute(rows, cosine=0.93):
    valid = [
        (i, np.array(v, float), lab) for i, v, lab in rows
        if i is not None and lab is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    links, label = {}, {i: i for i, *_ in rows if i is not None}
    pairs = []
    for i, v, a in valid:
        for j, w, b in valid:
            if i != j and a == b and len(v) == len(w) and v @ w >= cosine * (np.linalg.norm(v) * np.linalg.norm(w)):
                links[i] = links.get(i, 0) + 1
                pairs.append((i, j))
    for _ in range(len(pairs)):
        before = dict(label)
        for i, j in pairs:
            label[i] = min(label[i], label[j])
        if before == label:
            break
    return {i: (links.get(i, 0), label[i], label[i] == i) for i in label}


def sample(rng, n, dim=16):
    rows, number = [], 0
    for label in range(3):
        base = rng.normal(size=(n, dim))
        for v in base:
            rows.append((number, v.tolist(), label))
            number += 1
        centre = rng.normal(size=dim)
        for _ in range(n // 2):  # a tight group around the threshold
            rows.append((number, (centre + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.3])).tolist(), label))
            number += 1
    return rows


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near, "PER_CENTRE", 60)
    monkeypatch.setattr(near, "BLOCK", 50)
    rng = np.random.default_rng(2)
    rows = sample(rng, 120)
    copies = [(1000 + i, rows[3][1], rows[3][2]) for i in range(20)] + [(1100, rows[3][1], 2)]
    edges = [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [1.0, None] + [0.0] * 14, 1), (2003, [float("nan")] * 16, 1),
             (2004, [float("inf")] + [0.0] * 15, 1), (2005, rows[3][1], None), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1),
             (2008, [-0.0] * 15 + [1.0], 1), (2009, [0.0] * 15 + [1.0], 1), (None, rows[3][1], 0)]
    every = rows + copies + edges
    table = spark.createDataFrame([(*r, "x") for r in every], "vec_id long, embedding array<double>, label int, _v string")
    got = near.near_duplicates(table).collect()
    assert len(got) == len(every)
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    want = brute(every)
    lost = [i for i in want if found[i] != want[i]]
    true = sum(n for n, *_ in want.values())
    assert sum(min(found[i][0], want[i][0]) for i in want) >= 0.95 * true, (len(lost), true)
    assert all(found[i][0] <= want[i][0] for i in want)
    assert found[None] == (0, None, False)
    for i in (2000, 2001, 2002, 2003, 2004, 2005):
        assert found[i] == (0, i, True)
    assert found[2007] == (1, 2006, False) and found[2009] == (1, 2008, False)
    assert found[1005][0] == want[1005][0]


def test_recall_of_the_graph_from_the_medoid():
    rng = np.random.default_rng(4)
    v = near._unit(rng.normal(size=(1500, 64))).astype(np.float32)
    v[700:1100] = near._unit(v[5] + 0.03 * rng.normal(size=(400, 64)))
    graph = near.Graph(v, near.build(v))
    graph.join_directions()
    q, x = graph.in_range(v, np.full(len(v), -1), 0.93, near.BEAM)
    true = (v @ v.T >= 0.93).sum()
    assert len(q) >= 0.97 * true
    assert (graph.neighbours >= 0).sum(1).max() <= near.DEGREE


def test_robust_prune_keeps_the_nearest_and_drops_the_shadowed():
    v = near._unit(np.array([[1, 0.0], [1, 0.1], [1, 0.12], [1, -0.2]])).astype(np.float32)
    kept = near.robust_prune(v, np.array([0]), np.array([[1, 2, 3, -1]]), 1.2, 3)
    assert kept[0].tolist() == [1, 3, -1]


def test_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near.near_duplicates(table).count() == 0
    only_bad = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in near.near_duplicates(only_bad).collect()] == [(1, 0, 1, True)]


def test_group_many_times_larger_than_the_shards(spark, monkeypatch):
    monkeypatch.setattr(near, "PER_CENTRE", 20)
    rng = np.random.default_rng(5)
    noise = [rng.normal(size=32).tolist() for _ in range(300)]
    centre = rng.normal(size=32)
    group = [(centre + 0.1 * rng.normal(size=32)).tolist() for _ in range(900)]  # 15 times three shards
    rows = [(i, v, 1) for i, v in enumerate(noise + group)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near.near_duplicates(table).collect()}
    unit = near._unit(np.array([v for _, v, _ in rows]))
    true = (unit @ unit.T >= 0.93).sum(1) - 1
    assert true[300:].min() > 600
    assert all(found[i][0] <= true[i] for i in found)
    assert sum(found[i][0] for i in found) >= 0.99 * true.sum()
    assert {found[i][1] for i in range(300, 1200)} == {300}


def test_visits_do_not_grow_with_the_shards(spark, monkeypatch):
    # Pairs of near copies and no structure else: a vector visits a few shards however many there are.
    monkeypatch.setattr(near, "PER_CENTRE", 10)
    asked, real = [], near._search

    def counting(routed, *rest):
        asked.append(routed.selectExpr("coalesce(sum(size(_visits)), 0)").first()[0])
        return real(routed, *rest)

    monkeypatch.setattr(near, "_search", counting)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 32))
    rows = [(i, v.tolist(), 1) for i, v in enumerate([*base, *(base + 0.02 * rng.normal(size=base.shape))])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near.near_duplicates(table).collect()}
    assert found == {i: (1, i % 300) for i in range(600)}
    assert sum(asked) < 15 * 600  # of 60 shards


def test_vectors_visit_no_more_shards_than_hold_their_links(spark, monkeypatch):
    # Linked vectors are often at home in different shards, yet share one of their three.
    monkeypatch.setattr(near, "PER_CENTRE", 10)
    asked, real = [], near._search

    def counting(routed, *rest):
        asked.append(routed.selectExpr("coalesce(sum(size(_visits)), 0)").first()[0])
        return real(routed, *rest)

    monkeypatch.setattr(near, "_search", counting)
    rng = np.random.default_rng(7)
    base = rng.normal(size=(200, 32))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([base + 0.18 * rng.normal(size=base.shape) for _ in range(3)]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r["n_links"] for r in near.near_duplicates(table).collect()}
    want = {i: n for i, (n, *_) in brute(rows).items()}
    assert all(found[i] <= want[i] for i in want) and sum(found.values()) >= 0.95 * sum(want.values())
    assert sum(asked) < 8 * 600  # of 60 shards


def test_links_count_once_whatever_is_visited_first(spark, monkeypatch):
    monkeypatch.setattr(near, "PER_CENTRE", 20)
    monkeypatch.setattr(near, "BLOCK", 50)
    rng = np.random.default_rng(8)
    unit = near._unit(rng.normal(size=(400, 4)))
    table = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(unit)], "_id long, _vec array<double>, _label int")
    routed = near.keep(near.route(near.vertices(table), 4), "test-routed")
    same = np.arange(400)[:, None] % 2 == np.arange(400) % 2
    want = ((unit @ unit.T >= 0.93) & same).sum(1) - 1
    for nearest in (1, 2, 3, None):
        rows = near.search_all(routed, nearest=nearest).groupBy("_v").agg(F.sum("_links").alias("n")).collect()
        found = {r["_v"]: r["n"] for r in rows}
        assert all(n <= want[v] for v, n in found.items()), nearest
        assert sum(found.values()) >= 0.98 * want.sum(), nearest


def test_failed_audits_end_in_the_exact_pass(spark, monkeypatch):
    # A search that finds nothing: only the comparison of all pairs is left.
    def nothing(self, queries, *_):
        return np.zeros(0, int), np.zeros(0, int)

    monkeypatch.setattr(near, "_searcher", _patched(near._searcher, nothing))
    table = spark.createDataFrame([(i, [1.0, i / 1000], 1) for i in range(50)], "vec_id long, embedding array<double>, label int")
    rows = near.near_duplicates(table).collect()
    assert {r["n_links"] for r in rows} == {49} and {r["component_id"] for r in rows} == {0}


def _patched(searcher, nothing):
    """The searcher with ``nothing`` as the graph's search, also in the Python workers."""

    def make(cosine, beam):
        inner = searcher(cosine, beam)

        def run(key, table):
            real, near.Graph.in_range = near.Graph.in_range, nothing
            try:
                return inner(key, table)
            finally:
                near.Graph.in_range = real

        return run

    return make
