"""Queries over the topic hierarchy."""

from pyspark.sql import functions as F

from topicloom.catalog.registry import COUNTS, DESCRIBE, query, topical, weights_sql
from topicloom.catalog.topics import DESCRIBED
from topicloom.operators import hierarchy, labels, topics
from topicloom.workspace import keep

DISTANCES = """units AS (
  SELECT topic, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY topic)) AS x FROM weights WHERE topic <> -1),
pairs AS MATERIALIZED (
  SELECT a.topic AS a, b.topic AS b, 1 - sum(a.x * b.x) AS dist FROM units a JOIN units b ON a.term = b.term AND a.topic <> b.topic GROUP BY ALL)"""

# One merge per step on the whole distance table: the nearest pair, Ward update.
WARD = """leaf AS (SELECT max(topic) AS last FROM units),
ward AS (
  SELECT CAST(0 AS BIGINT) AS step, a, b, dist * dist AS d2, 1.0::DOUBLE AS na, 1.0::DOUBLE AS nb,
         CAST(a AS BIGINT) AS ia, CAST(b AS BIGINT) AS ib FROM pairs
  UNION ALL
  SELECT w.step + 1, a, b, d2, na, nb, ia, ib FROM (
    WITH m AS (SELECT a AS lo, b AS hi, d2 AS d, na AS n1, nb AS n2, step FROM ward WHERE a < b ORDER BY d2, a, b LIMIT 1)
    SELECT w.step, w.a, w.b, w.na, w.nb, w.ia, w.ib, w.d2 FROM ward w, m WHERE w.a NOT IN (m.lo, m.hi) AND w.b NOT IN (m.lo, m.hi)
    UNION ALL
    SELECT m.step, m.lo, x.b, m.n1 + m.n2, x.nb, (SELECT last FROM leaf) + 1 + m.step, x.ib,
           ((m.n1 + x.nb) * x.d2 + (m.n2 + x.nb) * y.d2 - x.nb * m.d) / (m.n1 + m.n2 + x.nb)
    FROM m JOIN ward x ON x.a = m.lo AND x.b <> m.hi JOIN ward y ON y.a = m.hi AND y.b = x.b
    UNION ALL
    SELECT m.step, x.b, m.lo, x.nb, m.n1 + m.n2, x.ib, (SELECT last FROM leaf) + 1 + m.step,
           ((m.n1 + x.nb) * x.d2 + (m.n2 + x.nb) * y.d2 - x.nb * m.d) / (m.n1 + m.n2 + x.nb)
    FROM m JOIN ward x ON x.a = m.lo AND x.b <> m.hi JOIN ward y ON y.a = m.hi AND y.b = x.b) w),
merges AS (
  SELECT (SELECT last FROM leaf) + 1 + step AS parent, least(ia, ib) AS l, greatest(ia, ib) AS r, sqrt(d2) AS dist FROM (
    SELECT *, row_number() OVER (PARTITION BY step ORDER BY d2, a, b) AS p FROM ward WHERE a < b) WHERE p = 1)"""

# Leaf lists and names of the tree's nodes; a parent is named by its first two leaves.
TREE = """links AS (SELECT l AS node, parent FROM merges UNION ALL SELECT r, parent FROM merges),
up AS (SELECT node, parent FROM links UNION ALL SELECT u.node, k.parent FROM up u JOIN links k ON k.node = u.parent),
leaves AS (SELECT node AS topic, parent FROM up WHERE node <= (SELECT last FROM leaf)),
label AS (SELECT topic, array_to_string(string_split(representation, ',')[1:3], ' ') AS llm_topic, cnt FROM info),
parents AS (
  SELECT parent, array_to_string(list(llm_topic ORDER BY topic)[1:2], ' and ') AS name, string_agg(CAST(topic AS VARCHAR), ',' ORDER BY topic) AS topics,
         count(*) AS n FROM leaves JOIN label USING (topic) GROUP BY parent),
names AS (SELECT topic AS node, llm_topic AS name FROM label WHERE topic <> -1 UNION ALL SELECT parent, name FROM parents),
tree AS (
  SELECT CAST(m.parent AS VARCHAR) AS "Parent_ID", p.name AS "Parent_Name", p.topics AS "Topics",
         CAST(m.l AS VARCHAR) AS "Child_Left_ID", a.name AS "Child_Left_Name",
         CAST(m.r AS VARCHAR) AS "Child_Right_ID", b.name AS "Child_Right_Name", round(m.dist, 6) AS "Distance"
  FROM merges m JOIN parents p ON p.parent = m.parent LEFT JOIN names a ON a.node = m.l LEFT JOIN names b ON b.node = m.r)"""

FULL = f"WITH RECURSIVE {DESCRIBED}, {DISTANCES}, {WARD}, {TREE}"
THRESHOLD = 0.5


def weights(spark, folder):
    return keep(topics.describe(topical(spark, folder), **DESCRIBE)[1], "weights")


def name_map(info):
    return info.where("topic <> -1").select(F.col("topic").cast("string").alias("topic_id"), F.col("llm_topic").alias("name"))


def tree(spark, folder):
    """Labelled topic table, leaf names and hierarchy with labelled parents."""
    docs = keep(topical(spark, folder), "topical")
    info, term_weights = topics.describe(docs, **DESCRIBE)
    info = keep(labels.label_topics(info, docs), "labelled")
    names = name_map(info)
    built = keep(hierarchy.build_hierarchy(keep(term_weights, "weights"), names), "tree")
    return info, names, keep(hierarchy.label_parents(built, names), "labelled-tree")


def flat_tree(rows):
    return rows.withColumn("Topics", F.array_join("Topics", ",")).withColumn("Distance", F.round("Distance", 6))


@query("g15_distances", f"WITH {COUNTS}, {weights_sql()}, {DISTANCES} SELECT a, b, round(dist, 6) AS dist FROM pairs WHERE a < b")
def distances(spark, folder):
    return hierarchy.topic_distances(weights(spark, folder)).withColumn("dist", F.round("dist", 6))


@query("g15_hierarchy", f"""WITH RECURSIVE {COUNTS}, {weights_sql()}, {DISTANCES}, {WARD}
SELECT CAST(parent AS INTEGER) AS parent, CAST(l AS INTEGER) AS "left", CAST(r AS INTEGER) AS "right", round(dist, 6) AS dist FROM merges""")
def merges(spark, folder):
    return hierarchy.ward_merges(hierarchy.topic_distances(weights(spark, folder))).withColumn("dist", F.round("dist", 6))


@query("g19_parent_labels", f"{FULL} SELECT * FROM tree")
def parent_labels(spark, folder):
    return flat_tree(tree(spark, folder)[2])


@query("j5_hierarchy_names", f"{FULL} SELECT \"Parent_ID\", \"Child_Left_Name\", \"Child_Right_Name\" FROM tree")
def hierarchy_names(spark, folder):
    _, names, rows = tree(spark, folder)
    return hierarchy.attach_names(rows, names).select("Parent_ID", "Child_Left_Name", "Child_Right_Name")


@query("u2_extend_names", f"{FULL} SELECT CAST(node AS VARCHAR) AS topic_id, name FROM names")
def extended_names(spark, folder):
    _, names, rows = tree(spark, folder)
    added = rows.select(F.col("Parent_ID").alias("topic_id"), F.col("Parent_Name").alias("name"))
    return hierarchy.extend_names(names, added)


@query("a10_ancestors", f"""{FULL} SELECT CAST(l.topic AS VARCHAR) AS topic, string_agg(p.name, ' > ' ORDER BY m.dist, m.parent) AS parents
FROM leaves l JOIN merges m ON m.parent = l.parent JOIN parents p ON p.parent = l.parent WHERE m.dist >= {THRESHOLD} GROUP BY l.topic""")
def ancestor_lists(spark, folder):
    rows = hierarchy.ancestors(tree(spark, folder)[2], THRESHOLD)
    return rows.withColumn("parents", F.array_join("parents", " > "))


@query("j6_parent_inner", f"""{FULL}, listed AS (
  SELECT l.topic, list(p.name ORDER BY m.dist, m.parent) AS ps FROM leaves l JOIN merges m ON m.parent = l.parent
  JOIN parents p ON p.parent = l.parent WHERE m.dist >= {THRESHOLD} GROUP BY l.topic)
SELECT CAST(b.topic AS VARCHAR) AS "Topic", b.cnt AS "Count", ps[1] AS parent, ps[2] AS parent_parent, ps[3] AS parent_parent_parent
FROM label b JOIN listed x ON x.topic = b.topic""")
def parent_columns(spark, folder):
    info, _, rows = tree(spark, folder)
    info = info.select(F.col("topic").alias("Topic"), F.col("cnt").alias("Count"))
    return hierarchy.with_parents(info, rows, THRESHOLD)


@query("g20_topic_paths", f"""{FULL} SELECT CAST(l.topic AS INTEGER) AS topic, count(*) AS depth, string_agg(p.name, ' > ' ORDER BY p.n DESC, CAST(p.parent AS VARCHAR) DESC) AS path
FROM leaves l JOIN parents p ON p.parent = l.parent GROUP BY l.topic""")
def paths(spark, folder):
    rows = hierarchy.topic_paths(tree(spark, folder)[2])
    return rows.withColumn("depth", F.col("depth").cast("long"))


@query("w3_sample_subtopics", f"""{FULL}, keyed AS (
  SELECT l.parent, l.topic, b.llm_topic, row_number() OVER (PARTITION BY l.parent ORDER BY md5('123:' || l.parent || ':' || l.topic), l.topic) AS r
  FROM leaves l JOIN label b ON b.topic = l.topic)
SELECT CAST(parent AS VARCHAR) AS "Parent_ID", string_agg('- ' || llm_topic, chr(10) ORDER BY topic) AS subtopics FROM keyed WHERE r <= 3 GROUP BY parent""")
def sampled_subtopics(spark, folder):
    _, names, rows = tree(spark, folder)
    prompts = hierarchy.parent_prompts(rows, names, max_topics=3)
    listed = F.regexp_extract("prompt", r"(?s)Subtopics:\n(.*)\nTopic:", 1)
    return prompts.select("Parent_ID", listed.alias("subtopics"))
