import numpy as np
from pyspark.sql import functions as F

from topicloom.llm import jaccard_join as join
from topicloom.llm.graph import components


def linked(a, b):
    both = len(np.intersect1d(a, b))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def test_keys_never_miss_a_linked_pair():
    rng = np.random.default_rng(5)
    seen = 0
    for trial in range(4000):
        size = int(rng.integers(1, 60)) if trial % 2 else int(rng.integers(1, 1500))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        keep = rng.random(len(a)) > rng.random() * 0.25
        b = np.union1d(a[keep], rng.integers(0, 2**63, int(rng.integers(0, size // 6 + 2))).astype(np.uint64))
        if len(b) and linked(a, b):
            seen += 1
            assert len(np.intersect1d(join.keys_of(a), join.keys_of(b)))
    assert seen > 1000


def test_schemes_leave_enough_capacity():
    for number in range(45):
        scheme = join.scheme(80, number)
        assert scheme.singles + 2 * scheme.pairs >= scheme.differ + 1 + scheme.slack
        assert join.bands(80, number + 1)[1] > 100 * (join.bands(80, number)[1] - 1) // 80
    assert any(join.scheme(80, number).pairs for number in range(45))


def brute(docs):
    sets = {i: set(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else set() for i, t in docs}
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                n = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in ids}


def edited(rng, words, share):
    out = list(words)
    for i in rng.choice(len(out), max(0, int(len(out) * share)), replace=False):
        out[i] = f"new{rng.integers(0, 10**9)}"
    return " ".join(out)


def test_equals_brute_force_with_a_hot_group(spark):
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(vocabulary, 60))
    texts = []
    base = list(rng.choice(vocabulary, 150))
    # A large group around the threshold, pairs of all sizes, a passage shared by many.
    texts += [edited(rng, base, rng.choice([0, 0.01, 0.02, 0.03, 0.05])) for _ in range(90)]
    for size in (4, 5, 6, 8, 12, 30, 80, 400):
        words = list(rng.choice(vocabulary, size))
        texts += [" ".join(words), " ".join(words[:-1]), edited(rng, words, 0.02), " ".join(words) + " x"]
    texts += [passage + " " + " ".join(rng.choice(vocabulary, int(n))) for n in rng.integers(1, 40, 30)]
    texts += ["", None, "a b", "A B", "b a"]
    docs = list(enumerate(texts))
    got = join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(docs)


def test_hot_keys_are_sent_as_groups(spark, monkeypatch):
    monkeypatch.setattr(join, "HOT", 4)
    monkeypatch.setattr(join, "FLUSH", 500)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 500, 120)]
    docs = [(i, edited(rng, words, 0.01)) for i in range(40)]
    rows = spark.createDataFrame(docs, "_id long, _text string").repartition(3)
    members = join.postings(rows)
    assert members.where("_hub > _id").count() == 0
    # All members of a key reach its least one over the hubs.
    edges = members.select("_key", F.col("_id").alias("u"), F.col("_hub").alias("v"))
    for key in [r[0] for r in edges.select("_key").distinct().limit(20).collect()]:
        rows = edges.where(F.col("_key") == key).collect()
        least = {r["u"]: r["u"] for r in rows}
        for _ in range(5):
            for r in rows:
                least[r["u"]] = min(least[r["u"]], least.get(r["v"], r["v"]))
        assert len(set(least.values())) == 1


def test_edges(spark, edge_docs, no_docs):
    rows = join.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 2, 5), (None, 2, None), (None, 0, None), (7, 1, 7), (8, 1, 7)} <= got
    assert join.near_duplicates(no_docs).count() == 0
    # Two texts under one id are one document and link what either is linked with.
    twice = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "a b c d e f"), (3, "g h i j k l")]
    found = join.near_duplicates(spark.createDataFrame(twice, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in found} == {1}


def test_components(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(50, 60), (60, 55), (70, 71), (5, 2)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(31)} | {50: 50, 60: 50, 55: 50, 70: 70, 71: 70}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_stars_take_few_stages(spark):
    rng = np.random.default_rng(4)
    edges = [(int(u), int(u) % 7) for u in rng.integers(7, 400, 300)] + [(9, 9), (None, 3), (3, None)]
    table = spark.createDataFrame(edges, "u long, v long")
    context, group = spark.sparkContext, "components-of-stars"
    context.setJobGroup(group, group)
    try:
        found = components(table)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    # The driver holds every task of every stage: one round of three shuffles, and its answer.
    assert jobs and sum(len(j.stageIds) for j in jobs) <= 12
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and dict(rows) == {x: x % 7 for u, v in edges[:300] for x in (u, v)}


def test_whole_bitmaps_tell_large_unrelated_sets_apart(spark):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    near = np.r_[base[:2900], rng.integers(0, 1 << 62, 100).astype(np.uint64)]
    other = np.r_[base[:20], rng.integers(0, 1 << 62, 2980).astype(np.uint64)]
    maps = [join._bitmap(np.unique(x)).tolist() for x in (base, near, other)]
    sets = spark.createDataFrame([(i, 3000, m) for i, m in enumerate(maps)], "i int, _n long, _all array<long>")
    side = F.struct("_n", "_all")
    pairs = sets.select(F.col("i").alias("x"), side.alias("a")).crossJoin(sets.select(F.col("i").alias("y"), side.alias("b")))
    could = pairs.where("x < y").where(join._could_link(80, bits="_all")).select("x", "y").collect()
    assert [tuple(r) for r in could] == [(0, 1)]


def test_words_are_hashed_by_array_wherever_they_stand(monkeypatch):
    rng = np.random.default_rng(8)
    words = {"".join(rng.choice(list("abAB\x00\x1fé中.\xa0"), int(rng.integers(1, 9)))) for _ in range(3000)} | {"x" * 70_000}
    words = sorted({w.encode().lower() for w in words} - {b""})
    alone = np.concatenate([join.word_hashes(w) for w in words])
    assert len(alone) == len(words) == len(np.unique(alone))
    gaps = [b" ", b"\t\n", b"\x0b\x0c\r ", b"  "]
    raw = b" " + b"".join(w + gaps[i % 4] for i, w in enumerate(words))
    assert np.array_equal(join.word_hashes(raw), alone)
    whole = join.Shingles()(raw.decode())
    assert len(whole) == len(words) - 4
    for size in (1, 100):
        monkeypatch.setattr(join, "PIECE", size)
        assert np.array_equal(np.concatenate([join.word_hashes(x) for x in join._pieces(raw)]), alone)
        assert np.array_equal(join.Shingles()(raw.decode()), whole)
    assert not len(join.word_hashes(b" \n")) and not len(join.Shingles()(None))
