import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from topicloom.operators import hierarchy, labels, outliers, refine, search, topics, views
from topicloom.operators.embedding import embed_with_model, hashed_embedding
from topicloom.operators.language import detect_language, train_profiles
from topicloom.operators.layout import curve, layout
from topicloom.operators.fuzzy import fuzzy_graph
from topicloom.operators.neighbours import knn_exact
from topicloom.plans.topics import label_model, model_topics, reduce_outliers, split_cluster
from topicloom.workspace import keep


def test_class_tfidf_by_hand(spark):
    rows = [(0, "aa aa bb"), (0, "bb cc"), (1, "aa cc cc"), (1, "cc"), (-1, "dd aa"), (-1, "the dd")]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "id long, topic int, abstract string")
    info, weights = topics.describe(docs, stop_words=["the"], min_df=0.5)
    # kept: terms in at least 1.5 of 3 topics: aa (3 topics), cc (2)
    total = {0: 3, 1: 4, -1: 1}
    freq = {"aa": 4, "cc": 4}
    a = math.floor(8 / 3)
    want = {
        (t, w): math.sqrt(n / total[t]) * math.log(1 + a / freq[w])
        for (t, w), n in {(0, "aa"): 2, (0, "cc"): 1, (1, "aa"): 1, (1, "cc"): 3, (-1, "aa"): 1}.items()
    }
    got = {(r.topic, r.term): r.weight for r in weights.collect()}
    assert got == pytest.approx(want)
    names = {r.topic: r.name for r in info.collect()}
    assert names == {0: "0_aa_cc", 1: "1_cc_aa", -1: "-1_aa"}


def test_renumber_by_size(spark):
    docs = spark.createDataFrame([(i, c) for i, c in enumerate([5, 7, 7, -1, -1, -1, 3])], "id long, cluster int")
    got = {r.id: r.topic for r in topics.renumber(docs, "cluster").collect()}
    assert got == {0: 2, 1: 0, 2: 0, 3: -1, 4: -1, 5: -1, 6: 1}


def test_vote_tie_and_cap(spark):
    pts = [(1, 0.0, 2), (2, 0.1, 1), (3, 0.2, 1), (4, 0.3, 2), (10, -0.01, -1), (11, 50.0, -1), (12, -0.01, 1)]
    docs = spark.createDataFrame([(i, [x], t) for i, x, t in pts], "id long, vec array<double>, topic int")
    got = {r.id: r.topic for r in outliers.reassign_by_neighbours(docs, threshold=0.5, k=4).collect()}
    # 10 and 12 share a vector: both take what the first one gets (tie, nearest has topic 2)
    assert got == {1: 2, 2: 1, 3: 1, 4: 2, 10: 2, 11: -1, 12: 2}


def test_refine(spark):
    docs = spark.createDataFrame([(i, i - 1) for i in range(5)], "id long, topic int")
    assert [r.topic for r in refine.merge_topics(docs, [2, 0]).orderBy("id").collect()] == [-1, 2, 1, 2, 3]
    assert [r.topic for r in refine.merge_topics(docs, [[2, 0], [3, 1]]).orderBy("id").collect()] == [-1, 2, 3, 2, 3]
    assert [r.topic for r in refine.offset_topics(docs).orderBy("id").collect()] == [-1, 1000, 1001, 1002, 1003]


def test_label_retries(spark):
    calls = spark.createDataFrame([("short",), ("long",)], "prompt string")

    def talk(prompts: pd.Series) -> pd.Series:
        return prompts.map(
            lambda p: " ".join(["w"] * 12) if p == "long" else ("again" if "too long" in p else "fine")
        )

    got = {r.prompt: r.answer for r in labels.run_labels(calls, talk).collect()}
    assert got == {"short": "fine", "long": "again"}


def ward_by_hand(d):
    """Textbook agglomeration, one merge at a time, on a full distance matrix."""
    n = len(d)
    d2 = {(i, j): d[i][j] ** 2 for i in range(n) for j in range(n) if i != j}
    size, ids, out = {i: 1 for i in range(n)}, {i: i for i in range(n)}, []
    while len(size) > 1:
        i, j = min(((i, j) for i, j in d2 if i < j), key=lambda p: (d2[p], p))
        dij = d2[i, j]
        out.append((n + len(out), *sorted((ids[i], ids[j])), math.sqrt(dij)))
        for k in size:
            if k not in (i, j):
                v = ((size[i] + size[k]) * d2[i, k] + (size[j] + size[k]) * d2[j, k] - size[k] * dij) / (size[i] + size[j] + size[k])
                d2[i, k] = d2[k, i] = v
        d2 = {p: v for p, v in d2.items() if j not in p}
        size[i] += size.pop(j)
        ids[i] = out[-1][0]
    return out


def test_ward_tree(spark):
    rng = np.random.default_rng(2)
    x = rng.random((12, 4))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    pairs = spark.createDataFrame([(i, j, float(d[i, j])) for i in range(12) for j in range(i + 1, 12)], "a int, b int, dist double")
    got = [(r.parent, r.left, r.right, r.dist) for r in hierarchy.ward_merges(pairs).orderBy("parent").collect()]
    want = ward_by_hand(d)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_hierarchy_names_and_parents(spark):
    merges = spark.createDataFrame([(3, 0, 1, 0.4), (4, 2, 3, 0.9)], "parent int, left int, right int, dist double")
    names = spark.createDataFrame([("0", "zero"), ("1", "one"), ("2", "two")], "topic_id string, name string")
    rows = hierarchy.label_parents(keep(hierarchy.hierarchy_table(merges, names), "h"), names)
    rows = keep(rows, "labelled")
    got = {r.Parent_ID: r for r in rows.collect()}
    assert got["4"].Topics == [0, 1, 2] and got["3"].Topics == [0, 1]
    assert got["3"].Parent_Name == "zero and one" and got["4"].Child_Right_Name == "zero and one"
    info = spark.createDataFrame([(t, 1) for t in (-1, 0, 1, 2)], "Topic int, Count long")
    parents = {r.Topic: (r.parent, r.parent_parent) for r in hierarchy.with_parents(info, rows, 0.5, 2).collect()}
    assert parents == {t: ("zero and one", None) for t in "012"}
    paths = {r.topic: (r.depth, r.path) for r in hierarchy.topic_paths(rows).collect()}
    assert paths[2][0] == 1 and paths[0] == (2, "zero and one > zero and one")


def test_crop_and_grid(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 0.0]), (3, [1.9, -0.5])], "id long, umap array<double>")
    assert {r.id for r in views.crop(rows, (-1, 2, -1, 1)).collect()} == {1, 3}
    with pytest.raises(ValueError):
        views.crop(rows, (1, 2, 3))
    assert {(r.gx, r.gy, r.cnt) for r in views.density_grid(rows).collect()} == {(0, 0, 1), (2, 0, 1), (1, -1, 1)}
    with pytest.raises(Exception, match="two-dimensional"):
        views.density_grid(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id long, umap array<double>")).collect()


def test_language(spark):
    rows = [(1, "en", "the cat and the hat are in the house"), (2, "de", "der hund und die katze sind in dem haus"), (3, "xx", "123")]
    docs = spark.createDataFrame(rows, "id long, lang string, text string")
    found = detect_language(docs, train_profiles(docs.where("id < 3")))
    assert {r.id: r.language for r in found.collect()} == {1: "en", 2: "de", 3: None}


def test_embeddings_are_unit(spark):
    docs = spark.createDataFrame([(1, "one two two"), (2, "...")], "id long, abstract string")
    got = {r.id: r.embedding for r in hashed_embedding(docs, 16).collect()}
    assert np.linalg.norm(got[1]) == pytest.approx(1) and not any(got[2])

    def make():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    rows = embed_with_model(docs, make).collect()
    assert all(np.linalg.norm(r.embeddings) == pytest.approx(1) for r in rows)


def test_random_grid_limit(spark):
    grid = search.parameter_grid(spark, {"a": [1, 2], "b": [0.5]})
    assert grid.count() == 2 and search.random_parameters(grid, 2).count() == 2
    with pytest.raises(ValueError):
        search.random_parameters(grid, 3)


def test_layout_keeps_groups(spark):
    a, b = curve(0.1)
    assert a == pytest.approx(1.577, abs=0.01) and b == pytest.approx(0.895, abs=0.01)
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(25, 6)) + 12 * c for c in np.eye(6)[:3]])
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    graph = keep(fuzzy_graph(knn_exact(pts, pts, k=8), 8), "graph")
    rows = {r.id: np.array(r.umap) for r in layout(pts, graph, n_epochs=8).collect()}
    y = np.stack([rows[i] for i in range(75)])
    assert np.isfinite(y).all()
    near = np.argsort(((y[:, None] - y[None]) ** 2).sum(-1), axis=1)[:, 1:6] // 25
    assert (near == (np.arange(75) // 25)[:, None]).mean() > 0.95


def test_model_with_outliers_labels_and_split(spark):
    words = {0: "sea fish boat", 1: "moon star sky", 2: "wheat corn farm"}
    rows = [(i, f"title {i}", words[i % 3], i % 3 if i >= 3 else -1, [float(i % 3), 0.01 * i]) for i in range(30)]
    docs = spark.createDataFrame(rows, "id long, title string, abstract string, cluster int, vec array<double>")
    model = model_topics(docs, outliers=True, threshold=0.5, min_df=0.0)
    model = {k: keep(v, k) for k, v in model.items()}
    ored = {r.id: r.topics_ored for r in model["doc_topics"].collect()}
    assert -1 not in ored.values() and ored[0] == ored[3]
    assert {r.topic for r in reduce_outliers(docs.withColumnRenamed("cluster", "topic"), "centroid", 0.5).collect()} >= {0, 1, 2}
    info, tree = label_model(model, threshold=0.0, levels=1)
    assert tree.count() == 2 and info.count() == 3
    halves = split_cluster(docs, 0, lambda part: part.select("id", (F.col("id") % 2).cast("int").alias("label")))
    got = {r.id: r.cluster for r in halves.collect()}
    assert got[4] == 1 and got[0] == -1 and {got[3], got[6]} == {1000, 1001}


def _refit_docs(spark):
    rnd = np.random.default_rng(3)
    vocab = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta", "the"]
    rows = []
    for i in range(120):
        cluster = [0, 0, 0, 1, 2, -1][i % 6]
        text = " ".join(rnd.choice(vocab, size=rnd.integers(0, 12)))
        rows.append((i, cluster, text if i % 17 else None))
    return spark.createDataFrame(rows, "id long, cluster int, abstract string")


def test_move_counts_equal_counting_again(spark):
    docs = _refit_docs(spark)
    counts = topics.term_counts(docs, "cluster", stop_words=["the"])
    moved = docs.where("id % 4 = 0").select(F.col("cluster").alias("old"), (F.col("cluster") + 10).alias("new"), "abstract")
    got = topics.move_counts(counts, moved, "old", "new", stop_words=["the"])
    after = docs.withColumn("cluster", F.when(F.col("id") % 4 == 0, F.col("cluster") + 10).otherwise(F.col("cluster")))
    want = topics.term_counts(after, "cluster", stop_words=["the"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_split_and_refit_equals_fit_from_scratch(spark):
    from topicloom.plans.topics import split_and_refit

    docs = _refit_docs(spark)
    counts = keep(topics.term_counts(docs, "cluster", stop_words=["the"]), "counts")

    def cluster_fn(part):  # three sub-clusters and some outliers
        return part.select("id", F.when(F.col("id") % 5 == 0, -1).otherwise(F.col("id") % 3).alias("label"))

    model = split_and_refit(docs, counts, 0, cluster_fn, stop_words=["the"], min_df=0.1)
    split = model["doc_topics"]
    moved = {r.id: r.cluster for r in split.collect()}
    assert {c for i, c in moved.items() if i % 6 in (0, 1, 2)} <= {1000, 1001, 1002, -1}
    assert all(moved[i] == c for i, c in {3: 1, 4: 2, 5: -1}.items())
    scratch = topics.fit_topics(split.drop("topic"), "cluster", stop_words=["the"], min_df=0.1)
    assert sorted(map(tuple, model["topic_info"].collect())) == sorted(map(tuple, scratch[1].collect()))
    got = {(r.topic, r.term): r.weight for r in model["ctfidf"].collect()}
    want = {(r.topic, r.term): r.weight for r in scratch[2].collect()}
    assert got.keys() == want.keys() and got == pytest.approx(want)


def test_subset_and_merge_with_100000_ids(spark):
    docs = spark.range(200_000).select(F.col("id"), (F.col("id") % 150_000).alias("cluster"))
    ids = list(range(0, 200_000, 2))  # 100,000 ids: a table, not literals
    got = refine.only_clusters(docs, ids)
    assert got.count() == docs.where(F.col("cluster") % 2 == 0).count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    table = spark.createDataFrame([(i,) for i in ids[:10]] * 3, "c long")
    assert refine.only_clusters(docs, table).count() == 20  # repeated ids repeat nothing
    groups = [[i, i + 1] for i in range(0, 100_000, 2)]  # 50,000 merges
    merged = refine.merge_topics(docs.withColumnRenamed("cluster", "topic"), groups)
    want = docs.select("id", F.when((F.col("cluster") < 100_000) & (F.col("cluster") % 2 == 1), F.col("cluster") - 1)
                       .otherwise(F.col("cluster")).alias("topic"))
    assert merged.select("id", "topic").exceptAll(want).count() == 0 and merged.count() == 200_000
    mapping = spark.createDataFrame([(1, 0), (1, 7), (3, 2)], "old long, new long")
    small_docs = spark.createDataFrame([(0, 1), (1, 3), (2, None)], "id long, topic long")
    assert sorted(map(tuple, refine.merge_topics(small_docs, mapping).collect())) == [(0, 0), (1, 2), (2, None)]


def test_default_labels_do_not_depend_on_the_template(spark):
    info = spark.createDataFrame(
        [(0, 5, "0_a_b", ["alpha", "beta", "gamma", "delta"]), (1, 2, "1", [])],
        "topic int, cnt long, name string, representation array<string>",
    )
    titled = spark.createDataFrame([(1, "A title", 0), (2, "Other", 1)], "id long, title string, topic int")
    for template in (labels.TOPIC_TEMPLATE, "Words {keywords} / {titles}"):
        got = {r.topic: r.llm_topic for r in labels.label_topics(info, titled, template=template).collect()}
        assert got == {0: "alpha beta gamma", 1: ""}


def test_epochs_broadcast_no_places(spark, monkeypatch):
    from topicloom.operators import layout as module

    plans = []

    def recorded(df, name):
        if name == "layout":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(module, "keep", recorded)
    rng = np.random.default_rng(2)
    points = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(20)], "id long, vec array<double>")
    graph = spark.createDataFrame([(i, i + 1, 1.0) for i in range(19)], "lo long, hi long, weight double")
    assert layout(points, graph, n_epochs=1).count() == 20
    assert len(plans) == 1 and "Broadcast" not in plans[0]


def test_hashed_words_are_held_in_pieces(monkeypatch):
    import regex

    from topicloom.operators import embedding

    monkeypatch.setattr(embedding, "PIECE_CHARS", 10)
    monkeypatch.setattr(embedding, "KNOWN_WORDS", 5)
    texts = ["aa bb", "", "cc dd ee ff gg", "aa", "aa bb cc", "hh"] * 3
    runs = list(embedding.pieces(texts))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(texts)))
    assert all(b - a == 1 or sum(map(len, texts[a:b])) <= 10 for a, b in runs)
    known, pattern = {}, regex.compile(embedding.TOKEN_PATTERN)
    counts = []
    for a, b in runs:
        counts.append(embedding.count_words(texts[a:b], pattern, known, 8))
        assert len(known) <= 5 + 10
    assert (np.concatenate(counts) == embedding.count_words(texts, pattern, {}, 8)).all()
