"""Queries over vectors: dedupe, neighbour joins, outlier reassignment, layout."""

import numpy as np
from pyspark.sql import functions as F

from topicloom.catalog.registry import VECTORS, query, table, vectors
from topicloom.functions.vectors import cosine, squared_distance, xy
from topicloom.operators import neighbours, outliers, views
from topicloom.operators.dedupe import dedupe_map, undo_dedupe, unique_rows
from topicloom.operators.fuzzy import fuzzy_graph, local_scales
from topicloom.operators.topics import centroids
from topicloom.plans.cluster import reduce_vectors
from topicloom.workspace import keep

KNN = VECTORS + """, pairs AS (
  SELECT a.id AS src, b.id AS dst, power(list_distance(a.vec, b.vec), 2) AS dist FROM emb a, emb b),
knn AS (
  SELECT src, dst, dist, rank FROM (
    SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pairs)
  WHERE rank <= 10)"""


def knn10(spark, folder):
    rows = vectors(spark, folder)
    return neighbours.knn_exact(rows, rows, 10)


def rounded(edges):
    return edges.select("src", "dst", "rank", (F.round("dist", 6) + 0.0).alias("dist"))


@query("j8_knn_exact", f"WITH {KNN} SELECT src, dst, rank, round(dist, 6) + 0.0 AS dist FROM knn")
def knn_exact(spark, folder):
    return rounded(knn10(spark, folder))


@query("w1_nearest_other", f"""WITH {VECTORS}, pairs AS (
  SELECT a.id AS src, b.id AS dst, power(list_distance(a.vec, b.vec), 2) AS dist FROM emb a, emb b
  WHERE a.topic = -1 AND b.topic <> -1)
SELECT src, dst, rank, round(dist, 6) AS dist FROM (
  SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pairs) WHERE rank <= 5""")
def knn_two_sided(spark, folder):
    rows = vectors(spark, folder)
    return rounded(neighbours.knn_exact(rows.where("topic = -1"), rows.where("topic <> -1"), 5))


@query("j9_knn_all_lists", f"WITH {KNN} SELECT src, dst, rank, round(dist, 6) + 0.0 AS dist FROM knn")
def knn_all_lists(spark, folder):
    rows = vectors(spark, folder)
    return rounded(neighbours.knn_lists(rows, rows, 10, n_lists=16, n_probe=16))


_LISTS = VECTORS + """, means AS (
  SELECT topic, list(m ORDER BY pos) AS c FROM (
    SELECT topic, pos, avg(vec[pos]) AS m FROM (SELECT topic, vec, unnest(range(1, 65)) AS pos FROM emb) GROUP BY topic, pos)
  GROUP BY topic),
routes AS (SELECT e.id, m.topic AS cell, row_number() OVER (PARTITION BY e.id ORDER BY list_distance(e.vec, m.c), m.topic) AS r
  FROM emb e, means m),
near AS (
  SELECT q.id AS src, t.id AS dst, power(list_distance(a.vec, b.vec), 2) AS dist
  FROM routes q JOIN routes t ON t.cell = q.cell AND q.r <= 3 AND t.r = 1 JOIN emb a ON a.id = q.id JOIN emb b ON b.id = t.id),
knn AS (SELECT src, dst, dist, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM near) WHERE rank <= 10)"""


def topic_means(rows):
    """One mean vector per topic (at most as many rows as topics), by topic."""
    return np.array([r["centroid"] for r in centroids(rows, "vec").orderBy("topic").collect()])


@query("j9_knn_ivf", f"WITH {_LISTS} SELECT src, dst, rank, round(dist, 6) + 0.0 AS dist FROM knn")
def knn_ivf(spark, folder):
    rows = vectors(spark, folder)
    return rounded(neighbours.knn_lists(rows, rows, 10, n_probe=3, centres=topic_means(rows)))


@query("s12_knn_lists", f"""WITH {KNN} SELECT src AS id, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY rank) AS knn_ind,
  round(sum(dist), 5) AS total FROM knn GROUP BY src""")
def knn_lists(spark, folder):
    lists = neighbours.as_lists(knn10(spark, folder))
    total = F.aggregate("knn_dist", F.lit(0.0), lambda a, x: a + x)
    return lists.select("id", F.array_join("knn_ind", ",").alias("knn_ind"), F.round(total, 5).alias("total"))


@query("p17_distance_cap", f"WITH {KNN} SELECT src, dst, round(dist, 6) + 0.0 AS dist FROM knn WHERE dist <= 1.3")
def capped(spark, folder):
    rows = vectors(spark, folder)
    return rounded(neighbours.knn_exact(rows, rows, 10, max_dist=1.3)).drop("rank")


# The given vectors are all different; (length, length mod 7) of the texts has copies.
_COPIES = """, shaped AS (SELECT doc_id AS id, [CAST(n_chars AS DOUBLE), CAST(length(text) % 7 AS DOUBLE)] AS vec FROM documents)"""


def shaped(spark, folder):
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.array(F.col("n_chars").cast("double"), (F.length("text") % 7).cast("double")).alias("vec"),
    )


@query("a1_dedupe", f"WITH {VECTORS}{_COPIES} SELECT id, min(id) OVER (PARTITION BY vec) AS rep_id FROM shaped")
def dedupe(spark, folder):
    return dedupe_map(shaped(spark, folder), "vec")


@query("w10_first_rows", f"WITH {VECTORS}{_COPIES} SELECT min(id) AS id, vec[1] AS chars FROM shaped GROUP BY vec")
def first_rows(spark, folder):
    rows = shaped(spark, folder)
    return unique_rows(rows, dedupe_map(rows, "vec")).select("id", F.get("vec", F.lit(0)).alias("chars"))


@query("j10_undo_dedupe", f"WITH {VECTORS}{_COPIES} SELECT id, 2 * (min(id) OVER (PARTITION BY vec)) AS value FROM shaped")
def undo(spark, folder):
    rows = shaped(spark, folder)
    copies = keep(dedupe_map(rows, "vec"), "dedupe")
    values = unique_rows(rows, copies).select("id", (2 * F.col("id")).alias("value"))
    return undo_dedupe(values, copies)


@query("f10_f11_distances", f"""WITH {VECTORS}, nxt AS (SELECT id - 1 AS id, vec AS other FROM emb)
SELECT e.id, round(power(list_distance(vec, other), 2), 6) AS dist, round(list_cosine_similarity(vec, other), 6) + 0.0 AS cos
FROM emb e JOIN nxt n ON n.id = e.id""")
def distances(spark, folder):
    rows = vectors(spark, folder)
    shifted = rows.select((F.col("id") - 1).alias("id"), F.col("vec").alias("other"))
    return rows.join(shifted, "id").select(
        "id",
        F.round(squared_distance(F.col("vec"), F.col("other")), 6).alias("dist"),
        (F.round(cosine(F.col("vec"), F.col("other")), 6) + 0.0).alias("cos"),
    )


_VOTES = """, near AS (
  SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank
  FROM (SELECT a.id AS src, b.id AS dst, power(list_distance(a.vec, b.vec), 2) AS dist
        FROM emb a, emb b WHERE a.topic = -1 AND b.topic <> -1)),
votes AS (
  SELECT n.src, e.topic, count(*) AS c, min(n.rank) AS r FROM near n JOIN emb e ON e.id = n.dst
  WHERE n.rank <= 10 AND n.dist <= 1.3 GROUP BY n.src, e.topic),
voted AS (SELECT src, topic FROM (
  SELECT src, topic, row_number() OVER (PARTITION BY src ORDER BY c DESC, r) AS p FROM votes) WHERE p = 1)"""


@query("a3_majority_vote", f"WITH {VECTORS}{_VOTES} SELECT src, topic FROM voted")
def majority(spark, folder):
    rows = vectors(spark, folder)
    edges = neighbours.knn_exact(rows.where("topic = -1"), rows.where("topic <> -1"), 10, max_dist=1.3)
    return outliers.majority_topic(edges, rows.select("id", "topic"))


@query("g13_reduce_outliers", f"WITH {VECTORS}{_VOTES} SELECT e.id, coalesce(v.topic, e.topic) AS topic FROM emb e LEFT JOIN voted v ON v.src = e.id")
def reduce_outliers(spark, folder):
    return outliers.reassign_by_neighbours(vectors(spark, folder), threshold=-0.3)


@query("j12_outliers_centroid", f"""WITH {VECTORS},
parts AS (SELECT topic, unnest(range(1, 65)) AS pos, unnest(vec) AS x FROM emb WHERE topic <> -1),
means AS (SELECT topic, list(x ORDER BY pos) AS c FROM (SELECT topic, pos, avg(x) AS x FROM parts GROUP BY topic, pos) GROUP BY topic),
sims AS (SELECT e.id, m.topic, list_cosine_similarity(e.vec, m.c) AS s FROM emb e, means m WHERE e.topic = -1),
best AS (SELECT id, topic FROM (SELECT id, topic, s, row_number() OVER (PARTITION BY id ORDER BY s DESC, topic) AS r FROM sims) WHERE r = 1 AND s >= 0.15)
SELECT e.id, coalesce(b.topic, e.topic) AS topic FROM emb e LEFT JOIN best b ON b.id = e.id""")
def by_centroid(spark, folder):
    return outliers.reassign_by_centroid(vectors(spark, folder), threshold=0.15)


_SCALES = """, near AS (
  SELECT src, dst, sqrt(dist) AS d, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pairs),
lists AS (SELECT src AS id, list(d ORDER BY rank) AS ds FROM near WHERE rank <= 15 AND src <> dst GROUP BY src),
rhos AS (SELECT id, ds, list_min(list_filter(ds, lambda d: d > 0)) AS rho FROM lists),
gaps AS (SELECT id, rho, list_transform(ds, lambda d: greatest(d - rho, 0.0)) AS gaps FROM rhos),
steps AS (
  SELECT id, gaps, 0.0::DOUBLE AS lo, 1e300::DOUBLE AS hi, 1.0::DOUBLE AS mid, 0 AS step FROM gaps
  UNION ALL
  SELECT id, gaps, nlo, nhi, CASE WHEN nhi >= 1e300 THEN mid * 2 ELSE (nlo + nhi) / 2 END, step + 1 FROM (
    SELECT id, gaps, mid, step,
           CASE WHEN s > log2(15) THEN lo ELSE mid END AS nlo,
           CASE WHEN s > log2(15) THEN mid ELSE hi END AS nhi
    FROM (SELECT *, list_sum(list_transform(gaps, lambda g: exp(-g / mid))) AS s FROM steps WHERE step < 64))),
scales AS (SELECT s.id, g.rho, s.mid AS sigma FROM steps s JOIN gaps g ON g.id = s.id WHERE s.step = 64)"""


@query("g1_local_scales", f"WITH RECURSIVE {KNN}{_SCALES} SELECT id, round(rho, 6) AS rho, round(sigma, 6) AS sigma FROM scales")
def scales(spark, folder):
    rows = vectors(spark, folder)
    found = local_scales(neighbours.knn_exact(rows, rows, 15), 15)
    return found.select("id", F.round("rho", 6).alias("rho"), F.round("sigma", 6).alias("sigma"))


@query("g1_fuzzy_graph", f"""WITH RECURSIVE {KNN}{_SCALES},
directed AS (SELECT n.src, n.dst, exp(-greatest(n.d - s.rho, 0.0) / s.sigma) AS v
  FROM near n JOIN scales s ON s.id = n.src WHERE n.rank <= 15 AND n.src <> n.dst)
SELECT least(src, dst) AS lo, greatest(src, dst) AS hi,
       round(sum(v) - CASE WHEN count(*) = 2 THEN min(v) * max(v) ELSE 0 END, 6) AS weight
FROM directed GROUP BY ALL""")
def fuzzy(spark, folder):
    rows = vectors(spark, folder)
    graph = fuzzy_graph(neighbours.knn_exact(rows, rows, 15), 15)
    return graph.withColumn("weight", F.round("weight", 6))


@query("g2_layout")
def laid_out(spark, folder):
    return reduce_vectors(vectors(spark, folder), vector_col="vec").select(
        "id", *xy(F.col("umap"))
    )


_FLAT = VECTORS + """, flat AS (SELECT id, topic, vec[1] * 20 AS x, vec[2] * 20 AS y FROM emb)"""


def flat(spark, folder):
    return vectors(spark, folder).select(
        "id", "topic", F.transform(F.slice("vec", 1, 2), lambda v: v * 20).alias("umap")
    )


@query("p8_crop", f"WITH {_FLAT} SELECT id, round(x, 6) AS x, round(y, 6) AS y FROM flat WHERE x > -2 AND x < 2.5 AND y > -3 AND y < 1.5")
def cropped(spark, folder):
    rows = views.crop(flat(spark, folder), (-2, 2.5, -3, 1.5))
    return rows.select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("p9_vector_xy", f"WITH {_FLAT} SELECT id, round(x, 6) AS x, round(y, 6) AS y FROM flat")
def placed(spark, folder):
    rows = flat(spark, folder).select("id", *xy(F.col("umap")))
    return rows.select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("a14_density_grid", f"WITH {_FLAT} SELECT CAST(floor(x) AS BIGINT) AS gx, CAST(floor(y) AS BIGINT) AS gy, count(*) AS cnt FROM flat WHERE x BETWEEN -20 AND 20 AND y BETWEEN -20 AND 20 GROUP BY ALL")
def grid(spark, folder):
    return views.density_grid(flat(spark, folder))


_LIST_VOTES = """, means AS (
  SELECT topic, list(m ORDER BY pos) AS c FROM (
    SELECT topic, pos, avg(vec[pos]) AS m FROM (SELECT topic, vec, unnest(range(1, 65)) AS pos FROM emb) GROUP BY topic, pos)
  GROUP BY topic),
routes AS (SELECT e.id, m.topic AS cell, row_number() OVER (PARTITION BY e.id ORDER BY list_distance(e.vec, m.c), m.topic) AS r
  FROM emb e, means m),
near AS (
  SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM (
    SELECT DISTINCT q.id AS src, t.id AS dst, power(list_distance(a.vec, b.vec), 2) AS dist
    FROM routes q JOIN routes t ON t.cell = q.cell AND q.r <= 3 AND t.r = 1 JOIN emb a ON a.id = q.id JOIN emb b ON b.id = t.id
    WHERE a.topic = -1 AND b.topic <> -1)),
votes AS (
  SELECT n.src, e.topic, count(*) AS c, min(n.rank) AS r FROM near n JOIN emb e ON e.id = n.dst
  WHERE n.rank <= 10 AND n.dist <= 1.3 GROUP BY n.src, e.topic),
voted AS (SELECT src, topic FROM (
  SELECT src, topic, row_number() OVER (PARTITION BY src ORDER BY c DESC, r) AS p FROM votes) WHERE p = 1)"""


@query(
    "g13_reduce_outliers_lists",
    f"WITH {VECTORS}{_LIST_VOTES} SELECT e.id, coalesce(v.topic, e.topic) AS topic FROM emb e LEFT JOIN voted v ON v.src = e.id",
)
def reduce_outliers_lists(spark, folder):
    """Outlier reduction by approximate neighbours: inverted lists of the topic means, three probed."""
    rows = vectors(spark, folder)
    return outliers.reassign_by_neighbours(rows, threshold=-0.3, approximate=True, n_probe=3, centres=topic_means(rows))
