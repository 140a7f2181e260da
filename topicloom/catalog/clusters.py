"""Queries over density clusters: reachability, trees, cuts, labels, search."""

from pyspark.sql import functions as F

from topicloom.catalog.registry import VECTORS, query, table, vectors
from topicloom.functions.sampling import sampled
from topicloom.operators import search
from topicloom.operators.dendrogram import merge_tree
from topicloom.operators.density import cluster_labels, clustering_metrics, hdbscan
from topicloom.operators.neighbours import knn_exact
from topicloom.operators.spanning import core_distances, density_cut, mutual_reachability, spanning_tree
from topicloom.workspace import keep


def reach_sql(min_samples: int) -> str:
    """Distances, core distances and mutual reachability over all pairs."""
    return f"""{VECTORS},
near AS MATERIALIZED (SELECT a.id AS s, b.id AS t, list_distance(a.vec, b.vec) AS d FROM emb a, emb b WHERE a.id <> b.id),
ranked AS (SELECT s, t, d, row_number() OVER (PARTITION BY s ORDER BY d, t) AS rank FROM near),
core AS MATERIALIZED (SELECT s AS id, max(d) AS core FROM ranked WHERE rank <= {min_samples} GROUP BY s),
reach AS MATERIALIZED (SELECT s, t, greatest(d, a.core, b.core) AS w FROM near JOIN core a ON a.id = s JOIN core b ON b.id = t)"""


# Prim's tree over the whole table: one step adds the nearest point not yet in the tree.
PRIM = """grow AS (
  SELECT id, CASE WHEN id = (SELECT min(id) FROM emb) THEN -1.0 ELSE 1e300 END AS best,
         CAST(NULL AS BIGINT) AS via, false AS taken FROM emb
  UNION ALL
  SELECT g.id,
         CASE WHEN g.taken OR g.id = v.id OR r.w IS NULL OR r.w >= g.best THEN g.best ELSE r.w END,
         CASE WHEN g.taken OR g.id = v.id OR r.w IS NULL OR r.w >= g.best THEN g.via ELSE v.id END,
         g.taken OR g.id = v.id
  FROM grow g
  CROSS JOIN (SELECT id FROM grow WHERE NOT taken ORDER BY best, id LIMIT 1) v
  LEFT JOIN reach r ON r.s = v.id AND r.t = g.id),
tree AS (SELECT least(id, via) AS lo, greatest(id, via) AS hi, max(best) AS w FROM grow WHERE taken AND via IS NOT NULL GROUP BY ALL)"""


def knn_others(spark, folder, k=10):
    rows = vectors(spark, folder)
    return knn_exact(rows, rows, k, exclude_self=True)


@query("g3_core_distance", f"WITH {reach_sql(5)} SELECT id, round(core, 6) AS core FROM core")
def core(spark, folder):
    return core_distances(knn_others(spark, folder), 5).withColumn("core", F.round("core", 6))


@query("g4_mutual_reachability", f"""WITH {reach_sql(5)}
SELECT DISTINCT least(r.s, r.t) AS lo, greatest(r.s, r.t) AS hi, round(w, 6) AS w
FROM reach r JOIN ranked k ON k.s = r.s AND k.t = r.t WHERE k.rank <= 10""")
def reachability(spark, folder):
    knn = keep(knn_others(spark, folder), "knn")
    edges = mutual_reachability(knn, core_distances(knn, 5))
    return edges.withColumn("w", F.round("w", 6))


@query("g5_mst_weight", f"WITH RECURSIVE {reach_sql(5)}, {PRIM} SELECT round(w, 6) AS w FROM tree")
def mst(spark, folder):
    return spanning_tree(vectors(spark, folder), 5).select(F.round("w", 6).alias("w"))


# With one sample all weights are plain distances, so the tree itself is unique.
@query("g5_mst_edges", f"WITH RECURSIVE {reach_sql(1)}, {PRIM} SELECT lo, hi, round(w, 6) AS w FROM tree")
def mst_edges(spark, folder):
    return spanning_tree(vectors(spark, folder), 1).select("lo", "hi", F.round("w", 6).alias("w"))


MERGES = """steps AS MATERIALIZED (SELECT lo, hi, w, row_number() OVER (ORDER BY w, lo, hi) AS e FROM tree),
joined AS (
  SELECT id, id AS comp, CAST(0 AS BIGINT) AS e, CAST(0 AS BIGINT) AS c1, CAST(0 AS BIGINT) AS c2 FROM emb
  UNION ALL
  SELECT j.id, CASE WHEN j.comp = y.comp THEN x.comp ELSE j.comp END, s.e, x.comp, y.comp
  FROM joined j
  JOIN steps s ON s.e = j.e + 1
  JOIN joined x ON x.id = s.lo
  JOIN joined y ON y.id = s.hi),
before AS (SELECT e + 1 AS e, comp, count(*) AS n FROM joined GROUP BY e, comp),
named AS (SELECT DISTINCT e, c1, c2 FROM joined WHERE e > 0),
merges AS MATERIALIZED (
  SELECT s.e, s.w, 1 / greatest(s.w, 1e-12) AS lam, k.c1, k.c2, a.n AS n1, b.n AS n2
  FROM named k JOIN steps s ON s.e = k.e JOIN before a ON a.e = k.e AND a.comp = k.c1 JOIN before b ON b.e = k.e AND b.comp = k.c2)"""


@query("g6_merge_sizes", f"""WITH RECURSIVE {reach_sql(1)}, {PRIM}, {MERGES}
SELECT e - 1 AS e, round(w, 6) AS w, least(n1, n2) AS small, greatest(n1, n2) AS large FROM merges""")
def merge_sizes(spark, folder):
    from topicloom.operators import dendrogram

    sizes = dendrogram.merge_sizes(merge_tree(keep(spanning_tree(vectors(spark, folder), 1), "tree")))
    return sizes.withColumn("w", F.round("w", 6))


@query("g9_density_cut", f"""WITH RECURSIVE {reach_sql(1)},
linked AS (SELECT s, t FROM reach WHERE w <= 1.06),
hop AS (SELECT id, id AS comp FROM emb UNION SELECT l.t, h.comp FROM hop h JOIN linked l ON l.s = h.id),
comps AS (SELECT id, min(comp) AS comp FROM hop GROUP BY id),
sized AS (SELECT id, comp, count(*) OVER (PARTITION BY comp) AS n FROM comps)
SELECT id, CASE WHEN n >= 3 THEN comp ELSE -1 END AS label FROM sized""")
def cut(spark, folder):
    rows = keep(vectors(spark, folder), "points")
    return density_cut(rows, keep(spanning_tree(rows, 1), "tree"), 1.06, 3)


@query("a6_validity", f"""WITH RECURSIVE {reach_sql(1)}, {PRIM},
ends AS (SELECT w, a.topic AS l1, b.topic AS l2 FROM tree JOIN emb a ON a.id = lo JOIN emb b ON b.id = hi),
sides AS (SELECT w, l1 AS label, l2 AS far FROM ends UNION ALL SELECT w, l2, l1 FROM ends),
widths AS (SELECT label, max(w) FILTER (label = far) AS inside, min(w) FILTER (label <> far) AS sep FROM sides WHERE label <> -1 AND far <> -1 GROUP BY label),
sizes AS (SELECT topic AS label, count(*) AS n FROM emb GROUP BY topic),
scored AS (SELECT s.label, s.n, coalesce(inside, 0.0) AS inside, coalesce(sep, 2 * (SELECT max(w) FROM tree)) AS sep FROM sizes s LEFT JOIN widths x ON x.label = s.label)
SELECT round(sum(CASE WHEN label <> -1 THEN n / (SELECT count(*) FROM emb) * (sep - inside) / greatest(sep, inside, 1e-12) END), 6) AS validity,
       max(label) + 1 AS topic_count, round(sum(CASE WHEN label <> -1 THEN n ELSE 0 END) / sum(n), 6) AS coverage FROM scored""")
def validity(spark, folder):
    rows = keep(vectors(spark, folder), "points")
    labels = rows.select("id", F.col("topic").alias("label"))
    metrics = clustering_metrics(labels, keep(spanning_tree(rows, 1), "tree"))
    return metrics.select(F.round("validity", 6).alias("validity"), "topic_count", F.round("coverage", 6).alias("coverage"))


def labels_sql(least: int, epsilon: float = 0.0, rows: str = "emb") -> str:
    """Density labels in SQL, from the merges of ``g6_merge_sizes``.

    A merge of two components of at least ``least`` points is a split: read downwards, two
    clusters are born there.  Every point passes a chain of clusters, from the deepest to the
    one below the root.
    """
    moved = f"""
picked AS (SELECT DISTINCT e, comp FROM (
  SELECT c.id, c.e, c.comp, row_number() OVER (PARTITION BY c.id ORDER BY c.e DESC) AS r
  FROM chain c JOIN wins w ON w.e = c.e AND w.comp = c.comp) WHERE r = 1),
chosen AS (SELECT DISTINCT
    CASE WHEN 1 / p.birth < {epsilon} THEN coalesce(above.e, high.e, p.e) ELSE p.e END AS e,
    CASE WHEN 1 / p.birth < {epsilon} THEN coalesce(above.comp, high.comp, p.comp) ELSE p.comp END AS comp
  FROM (SELECT c.e, c.comp, c.birth, min(c.id) AS id FROM chain c JOIN picked k ON k.e = c.e AND k.comp = c.comp GROUP BY ALL) p
  LEFT JOIN LATERAL (SELECT c.e, c.comp FROM chain c WHERE c.id = p.id AND c.e > p.e AND 1 / c.birth > {epsilon} ORDER BY c.e LIMIT 1) above ON true
  LEFT JOIN LATERAL (SELECT c.e, c.comp FROM chain c WHERE c.id = p.id AND c.e > p.e ORDER BY c.e DESC LIMIT 1) high ON true),"""
    return f"""{MERGES},
inside AS (
  SELECT j.id, m.e, j.comp, m.lam, least(m.n1, m.n2) >= {least} AS split, m.n1 + m.n2 AS size
  FROM joined j JOIN merges m ON m.e = j.e + 1 AND j.comp IN (m.c1, m.c2)),
entry AS (SELECT id, min(e) AS e0, arg_min(lam, e) AS lam0 FROM inside WHERE size >= {least} GROUP BY id),
chain AS MATERIALIZED (
  SELECT i.id, i.e, i.comp, i.lam AS birth, coalesce(lag(i.lam) OVER byid, t.lam0) AS leave,
         lead(i.e) OVER byid AS up_e, lead(i.comp) OVER byid AS up_comp
  FROM inside i JOIN entry t ON t.id = i.id WHERE i.split WINDOW byid AS (PARTITION BY i.id ORDER BY i.e)),
clusters AS MATERIALIZED (
  SELECT e, comp, sum(leave - birth) AS stab, min(up_e) AS up_e, min(up_comp) AS up_comp FROM chain GROUP BY e, comp),
fold AS (
  SELECT 0 AS k, c.*, CASE WHEN NOT EXISTS (SELECT 1 FROM clusters d WHERE d.up_e = c.e AND d.up_comp = c.comp) THEN stab END AS best
  FROM clusters c
  UNION ALL
  SELECT f.k + 1, f.e, f.comp, f.stab, f.up_e, f.up_comp, coalesce(f.best, CASE WHEN d.n = 2 THEN greatest(f.stab, d.s) END)
  FROM fold f LEFT JOIN (SELECT up_e, up_comp, count(best) AS n, sum(best) AS s FROM fold GROUP BY up_e, up_comp) d
    ON d.up_e = f.e AND d.up_comp = f.comp
  WHERE f.k < (SELECT count(*) FROM clusters)),
mass AS (SELECT * FROM fold WHERE k = (SELECT count(*) FROM clusters)),
wins AS (
  SELECT e, comp FROM mass f LEFT JOIN (SELECT up_e AS e, up_comp AS comp, sum(best) AS s FROM mass GROUP BY ALL) d USING (e, comp)
  WHERE d.s IS NULL OR f.stab >= d.s),{moved if epsilon > 0 else " chosen AS (SELECT e, comp FROM wins),"}
tops AS (SELECT id, e, comp FROM (
  SELECT c.id, c.e, c.comp, row_number() OVER (PARTITION BY c.id ORDER BY c.e DESC) AS r
  FROM chain c JOIN chosen w ON w.e = c.e AND w.comp = c.comp) WHERE r = 1),
ranks AS (
  SELECT e, comp, row_number() OVER (ORDER BY count(*) DESC, min(id)) - 1 AS label FROM tops GROUP BY e, comp),
labels AS (
  SELECT p.id, CAST(coalesce(r.label, -1) AS INTEGER) AS label
  FROM {rows} p LEFT JOIN tops t ON t.id = p.id LEFT JOIN ranks r ON r.e = t.e AND r.comp = t.comp)"""


@query("g7_hdbscan", f"WITH RECURSIVE {reach_sql(1)}, {PRIM}, {labels_sql(4)} SELECT id, label FROM labels")
def density_labels(spark, folder):
    return hdbscan(vectors(spark, folder), min_cluster_size=4, min_samples=1)


@query("g8_hdbscan_epsilon", f"WITH RECURSIVE {reach_sql(1)}, {PRIM}, {labels_sql(3, 0.99)} SELECT id, label FROM labels")
def density_labels_epsilon(spark, folder):
    return hdbscan(vectors(spark, folder), 3, 1, cluster_selection_epsilon=0.99)


@query("g7_hdbscan_samples", f"WITH RECURSIVE {reach_sql(2)}, {PRIM}, {labels_sql(5)} SELECT id, label FROM labels")
def density_labels_samples(spark, folder):
    """Density labels on core distances (two samples), ties of the tree by (w, lo, hi)."""
    return hdbscan(vectors(spark, folder), min_cluster_size=5, min_samples=2)


@query("g8_hdbscan_epsilon_samples", f"WITH RECURSIVE {reach_sql(2)}, {PRIM}, {labels_sql(4, 1.0)} SELECT id, label FROM labels")
def density_labels_epsilon_samples(spark, folder):
    """Selection with an epsilon of 1.0 on core distances of two samples."""
    return hdbscan(vectors(spark, folder), 4, 2, cluster_selection_epsilon=1.0)


# All with one sample, where the tree is unique.
SEARCH = {"min_samples": [1], "min_cluster_size": [3, 4, 5], "cluster_selection_epsilon": [0.0, 0.99]}


def _trial_sql(least: int, epsilon: float) -> str:
    return f"""SELECT * FROM (WITH RECURSIVE {reach_sql(1)}, {PRIM}, {labels_sql(least, epsilon)},
  ends AS (SELECT w, a.label AS l1, b.label AS l2 FROM tree JOIN labels a ON a.id = lo JOIN labels b ON b.id = hi),
  sides AS (SELECT w, l1 AS label, l2 AS far FROM ends UNION ALL SELECT w, l2, l1 FROM ends),
  widths AS (SELECT label, max(w) FILTER (label = far) AS inside, min(w) FILTER (label <> far) AS sep FROM sides WHERE label <> -1 AND far <> -1 GROUP BY label),
  sizes AS (SELECT label, count(*) AS n FROM labels GROUP BY label),
  scored AS (SELECT s.label, s.n, coalesce(inside, 0.0) AS inside, coalesce(sep, 2 * (SELECT max(w) FROM tree)) AS sep FROM sizes s LEFT JOIN widths x ON x.label = s.label)
  SELECT round(coalesce(sum(CASE WHEN label <> -1 THEN n / (SELECT count(*) FROM emb) * (sep - inside) / greatest(sep, inside, 1e-12) END), 0), 6) AS validity,
         max(label) + 1 AS topic_count, round(sum(CASE WHEN label <> -1 THEN n ELSE 0 END) / sum(n), 6) AS coverage,
         1 AS min_samples, {least} AS min_cluster_size, CAST({epsilon} AS DOUBLE) AS cluster_selection_epsilon,
         md5('123:1:{least}:{epsilon}') AS key FROM scored)"""


_TRIALS = " UNION ALL ".join(
    _trial_sql(least, epsilon)
    for least in SEARCH["min_cluster_size"]
    for epsilon in SEARCH["cluster_selection_epsilon"]
)


@query("g10_param_search", f"SELECT * EXCLUDE (key) FROM ({_TRIALS}) ORDER BY key LIMIT 4")
def parameter_search(spark, folder):
    found = search.parameter_search(vectors(spark, folder), SEARCH, 4)
    return found.withColumns({c: F.round(c, 6) for c in ("validity", "coverage")})


_GRID = """grid AS (
  SELECT min_samples, min_cluster_size, cluster_selection_epsilon FROM
    (SELECT DISTINCT CAST(label + 1 AS INTEGER) AS min_samples FROM embeddings) a,
    (SELECT DISTINCT CAST(25 * (quality + 1) AS INTEGER) AS min_cluster_size FROM labels) b,
    (SELECT unnest([0.0, 0.1, 0.2]) AS cluster_selection_epsilon) c)"""


def grid(spark, folder):
    """A grid whose value lists come from the tables: labels + 1, quality steps."""
    samples = table(spark, folder, "embeddings").select((F.col("label") + 1).alias("v")).distinct()
    sizes = table(spark, folder, "labels").select((25 * (F.col("quality") + 1)).alias("v")).distinct()
    return search.parameter_grid(
        spark,
        {
            "min_samples": sorted(r.v for r in samples.collect()),
            "min_cluster_size": sorted(r.v for r in sizes.collect()),
            "cluster_selection_epsilon": [0.0, 0.1, 0.2],
        },
    )


@query("j13_param_grid", f"WITH {_GRID} SELECT min_samples, min_cluster_size, CAST(cluster_selection_epsilon AS DOUBLE) AS cluster_selection_epsilon FROM grid")
def param_grid(spark, folder):
    return grid(spark, folder)


@query("w5_random_grid", f"""WITH {_GRID} SELECT min_samples, min_cluster_size, CAST(cluster_selection_epsilon AS DOUBLE) AS cluster_selection_epsilon FROM grid
ORDER BY md5('123:' || min_samples || ':' || min_cluster_size || ':' || CAST(cluster_selection_epsilon AS VARCHAR)), min_samples, min_cluster_size, cluster_selection_epsilon LIMIT 12""")
def random_grid(spark, folder):
    return search.random_parameters(grid(spark, folder), 12)


@query("w4_fraction_sample", """SELECT doc_id AS id FROM documents
WHERE CAST('0x' || substr(md5('123:' || doc_id), 1, 8) AS BIGINT) < 0.3 * 4294967296""")
def fraction(spark, folder):
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return search.sample_rows(rows, 0.3)


# Several sample counts: one neighbour search for the largest serves all trees.
SAMPLES_SEARCH = {"min_samples": [1, 3, 5], "min_cluster_size": [3, 5], "cluster_selection_epsilon": [0.0]}


def _samples_trial_sql(samples: int, least: int, epsilon: float) -> str:
    return _trial_sql(least, epsilon).replace(reach_sql(1), reach_sql(samples), 1).replace(
        "1 AS min_samples", f"{samples} AS min_samples", 1
    ).replace(f"md5('123:1:{least}:{epsilon}') AS key", f"{samples} AS key", 1)


_SAMPLES_TRIALS = " UNION ALL ".join(
    _samples_trial_sql(samples, least, epsilon)
    for samples in SAMPLES_SEARCH["min_samples"]
    for least in SAMPLES_SEARCH["min_cluster_size"]
    for epsilon in SAMPLES_SEARCH["cluster_selection_epsilon"]
)


@query("g10_param_search_samples", f"SELECT * EXCLUDE (key) FROM ({_SAMPLES_TRIALS})")
def parameter_search_samples(spark, folder):
    found = search.parameter_search(vectors(spark, folder), SAMPLES_SEARCH, 6)
    return found.withColumns({c: F.round(c, 6) for c in ("validity", "coverage")})
