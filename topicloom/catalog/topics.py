"""Queries over topics: fit, weights, changes, labels."""

from pyspark.sql import functions as F

from topicloom.catalog.registry import (
    COUNTS,
    DESCRIBE,
    TOPICAL,
    VECTORS,
    flat_info,
    info_sql,
    query,
    table,
    topical,
    vectors,
    weights_sql,
)
from topicloom.functions.text import bullets, clean_label, display_label, too_long
from topicloom.operators import labels, refine, topics, views
from topicloom.operators.density import coverage
from topicloom.plans.topics import split_and_refit, split_cluster
from topicloom.workspace import keep

DESCRIBED = f"{COUNTS}, {weights_sql()}, {info_sql()}"

# The same with topics renumbered by falling size, -1 kept.
_RENUMBER = """ranks AS (
  SELECT topic AS old, row_number() OVER (ORDER BY count(*) DESC, topic) - 1 AS new FROM {docs} WHERE topic <> -1 GROUP BY topic),
fitted AS (SELECT d.id, d.text, CAST(coalesce(r.new, -1) AS INTEGER) AS topic FROM {docs} d LEFT JOIN ranks r ON r.old = d.topic)"""


def _fit_sql(docs: str) -> str:
    from topicloom.catalog.registry import STOP_SQL

    return (
        _RENUMBER.format(docs=docs)
        + f""", fcounts AS (
  SELECT topic, term, count(*) AS n FROM (
    SELECT topic, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM fitted)
  WHERE term NOT IN ({STOP_SQL}) GROUP BY topic, term), """
        + weights_sql("fcounts", "fitted")
        + ", "
        + info_sql("fitted")
    )


_INFO = "SELECT topic, cnt, name, representation FROM info"


def _described(docs):
    return flat_info(topics.describe(docs, **DESCRIBE)[0])


@query("g11_topic_fit", f"WITH {TOPICAL}, {_fit_sql('docs')} {_INFO}")
def topic_fit(spark, folder):
    docs = topical(spark, folder).withColumnRenamed("topic", "cluster")
    return flat_info(topics.fit_topics(docs, **DESCRIBE)[1])


@query("g12_update_topics", f"WITH {DESCRIBED} {_INFO}")
def update_topics(spark, folder):
    return _described(topical(spark, folder))


@query("a8_ctfidf", f"WITH {COUNTS}, {weights_sql()} SELECT topic, term, n, round(weight, 6) AS weight FROM weights")
def ctfidf(spark, folder):
    weights = topics.describe(topical(spark, folder), **DESCRIBE)[1]
    return weights.withColumn("weight", F.round("weight", 6))


@query("w8_topic_terms", f"WITH {DESCRIBED} SELECT topic, r AS rank, term FROM ranked WHERE r <= 10")
def topic_terms(spark, folder):
    best = topics.top_terms(topics.describe(topical(spark, folder), **DESCRIBE)[1], 10)
    return best.select("topic", F.posexplode("representation").alias("pos", "term")).select(
        "topic", (F.col("pos") + 1).cast("long").alias("rank"), "term"
    )


@query("w9_renumber", f"WITH {TOPICAL}, {_RENUMBER.format(docs='docs')} SELECT id, topic FROM fitted")
def renumbered(spark, folder):
    docs = topical(spark, folder).withColumnRenamed("topic", "cluster")
    return topics.renumber(docs, "cluster").select("id", "topic")


@query("a2_topic_counts", f"WITH {TOPICAL} SELECT topic, count(*) AS cnt FROM docs GROUP BY topic")
def topic_counts(spark, folder):
    return topics.topic_counts(topical(spark, folder))


@query("a4_a5_coverage", f"WITH {VECTORS} SELECT max(topic) + 1 AS topic_count, round(avg(CASE WHEN topic <> -1 THEN 1.0 ELSE 0.0 END), 6) AS coverage FROM emb")
def covered(spark, folder):
    return coverage(vectors(spark, folder), "topic").withColumn("coverage", F.round("coverage", 6))


@query("a9_centroids", f"WITH {VECTORS}, parts AS (SELECT topic, unnest(range(64)) AS pos, unnest(vec) AS x FROM emb) SELECT topic, pos, round(avg(x), 6) + 0.0 AS x FROM parts GROUP BY topic, pos")
def centroids(spark, folder):
    means = topics.centroids(vectors(spark, folder), "vec")
    rows = means.select("topic", F.posexplode("centroid").alias("pos", "x"))
    return rows.select("topic", F.col("pos").cast("long").alias("pos"), (F.round("x", 6) + 0.0).alias("x"))


@query("a11_input_rows", "SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM embeddings) AS vectors")
def input_rows(spark, folder):
    docs = table(spark, folder, "documents").agg(F.count("*").alias("documents"))
    vecs = table(spark, folder, "embeddings").agg(F.count("*").alias("vectors"))
    return docs.select("documents", vecs.scalar().alias("vectors"))


@query("p11_cluster_subset", f"WITH {TOPICAL} SELECT id, title, topic FROM docs WHERE topic IN (0, 3, 5)")
def subset(spark, folder):
    return refine.only_clusters(topical(spark, folder), [0, 3, 5], "topic").select("id", "title", "topic")


@query("p12_fill_outliers", "SELECT d.doc_id AS id, coalesce(l.quality, -1) AS cluster FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def filled(spark, folder):
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    rows = docs.select(F.col("doc_id").alias("id"), F.col("quality").alias("cluster"))
    return refine.fill_outliers(rows)


@query("p13_split_outliers", f"WITH {VECTORS} SELECT topic = -1 AS outlier, count(*) AS cnt, min(id) AS first FROM emb GROUP BY 1")
def split_outliers(spark, folder):
    rows = vectors(spark, folder)
    return rows.groupBy((F.col("topic") == topics.OUTLIER).alias("outlier")).agg(
        F.count("*").alias("cnt"), F.min("id").alias("first")
    )


_TO_OUTLIER = ", gone AS (SELECT id, text, CASE WHEN topic IN (2, 4) THEN -1 ELSE topic END AS topic FROM docs)"


@query("p14_to_outlier", f"WITH {TOPICAL}{_TO_OUTLIER}, {_fit_sql('gone')} {_INFO}")
def to_outlier(spark, folder):
    docs = refine.to_outlier(topical(spark, folder), [2, 4]).withColumnRenamed("topic", "cluster")
    return flat_info(topics.fit_topics(docs, **DESCRIBE)[1])


@query("p15_offset_split", f"WITH {TOPICAL} SELECT id, CASE WHEN topic = -1 THEN -1 ELSE topic + 1000 END AS topic FROM docs")
def offset(spark, folder):
    return refine.offset_topics(topical(spark, folder)).select("id", "topic")


@query("p16_string_ids", f"WITH {TOPICAL} SELECT CAST(topic AS VARCHAR) AS topic_id, count(*) AS cnt FROM docs GROUP BY topic")
def string_ids(spark, folder):
    return topics.topic_counts(topical(spark, folder)).select(F.col("topic").cast("string").alias("topic_id"), "cnt")


@query("j2_remap_clusters", f"WITH {TOPICAL} SELECT d.id, l.quality AS dropped, coalesce(l.quality, d.topic) AS kept FROM docs d LEFT JOIN labels l ON l.doc_id = d.id")
def remap(spark, folder):
    docs = topical(spark, folder).select("id", F.col("topic").alias("cluster"))
    new = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("cluster"))
    dropped = refine.remap_clusters(docs, new).withColumnRenamed("cluster", "dropped")
    kept = refine.remap_clusters(docs, new, keep_unmapped=True).withColumnRenamed("cluster", "kept")
    return dropped.join(kept, "id")


_MERGED = ", merged AS (SELECT id, text, CASE WHEN topic IN (1, 5) THEN 1 WHEN topic IN (3, 6, 7) THEN 3 ELSE topic END AS topic FROM docs)"


def _merged_counts() -> str:
    return _fit_sql("merged").split(", fcounts AS", 1)[1]


@query(
    "a13_merge_topics",
    f"WITH {TOPICAL}{_MERGED}, fitted AS (SELECT * FROM merged), fcounts AS{_merged_counts()} {_INFO}",
)
def merged(spark, folder):
    return _described(refine.merge_topics(topical(spark, folder), [[1, 5], [3, 6, 7]]))


_SAMPLE = """, sampled AS (
  SELECT topic, id, title, row_number() OVER (PARTITION BY topic ORDER BY md5('123:' || CAST(id AS VARCHAR)), id) AS r FROM docs)"""
_BULLET = "'- ' || CASE WHEN length(title) > 200 THEN substr(title, 1, 200) || '...' ELSE title END"


@query("w2_sample_titles", f"WITH {TOPICAL}{_SAMPLE} SELECT topic, r AS rank, title FROM sampled WHERE r <= 30")
def sample_titles(spark, folder):
    rows = labels.sample_titles(topical(spark, folder))
    return rows.select("topic", F.posexplode("titles_sample").alias("pos", "title")).select(
        "topic", (F.col("pos") + 1).cast("long").alias("rank"), "title"
    )


@query("f2_bullets", f"WITH {TOPICAL}{_SAMPLE} SELECT topic, string_agg({_BULLET}, chr(10) ORDER BY r) AS titles FROM sampled WHERE r <= 30 GROUP BY topic")
def title_bullets(spark, folder):
    rows = labels.sample_titles(topical(spark, folder))
    return rows.select("topic", bullets(F.col("titles_sample"), 200).alias("titles"))


@query("j3_attach_topics", f"WITH {TOPICAL} SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS title, e.topic FROM documents d JOIN emb e ON e.id = d.doc_id")
def attach(spark, folder):
    titles = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.get(F.split("text", "\n", 2), F.lit(0)).alias("title")
    )
    return labels.attach_topics(titles, vectors(spark, folder))


def _prompt_sql() -> str:
    from topicloom.functions.prompts import TOPIC_TEMPLATE

    head, rest = TOPIC_TEMPLATE.split("{keywords}")
    middle, tail = rest.split("{titles}")
    return f"'{head}' || replace(i.representation, ',', ', ') || '{middle}' || t.titles || '{tail}'"


_PROMPTS = f"""{DESCRIBED}{_SAMPLE},
bulleted AS (SELECT topic, string_agg({_BULLET}, chr(10) ORDER BY r) AS titles, count(*) AS titles_n FROM sampled WHERE r <= 30 GROUP BY topic)"""


@query("f6_prompts", f"WITH {_PROMPTS} SELECT i.topic, {_prompt_sql()} AS prompt FROM info i JOIN bulleted t ON t.topic = i.topic")
def prompts(spark, folder):
    docs = keep(topical(spark, folder), "topical")
    info = topics.describe(docs, **DESCRIBE)[0]
    return labels.topic_prompts(info, labels.sample_titles(docs)).select("topic", "prompt")


@query("j4_label_inputs", f"WITH {_PROMPTS} SELECT i.topic, i.cnt, i.name, i.representation, t.titles_n FROM info i JOIN bulleted t ON t.topic = i.topic")
def label_inputs(spark, folder):
    docs = keep(topical(spark, folder), "topical")
    info = topics.describe(docs, **DESCRIBE)[0]
    rows = labels.topic_prompts(info, labels.sample_titles(docs))
    return flat_info(rows).select("topic", "cnt", "name", "representation", F.size("titles_sample").alias("titles_n"))


_LABELLED = f"{DESCRIBED}, labelled AS (SELECT topic, cnt, name, representation, array_to_string(string_split(representation, ',')[1:3], ' ') AS llm_topic FROM info)"


def labelled(spark, folder):
    docs = keep(topical(spark, folder), "topical")
    info = topics.describe(docs, **DESCRIBE)[0]
    return labels.label_topics(info, docs)


@query("g18_label_topics", f"WITH {_LABELLED} SELECT topic, cnt, name, representation, llm_topic FROM labelled")
def label_topics(spark, folder):
    return flat_info(labelled(spark, folder)).select("topic", "cnt", "name", "representation", "llm_topic")


@query("f4_display_label", f"WITH {_LABELLED} SELECT topic, llm_topic || ' (' || format('{{:,}}', cnt * 1000) || ')' AS label FROM labelled")
def display(spark, folder):
    return labelled(spark, folder).select("topic", display_label(F.col("llm_topic"), F.col("cnt") * 1000).alias("label"))


@query("j7_docs_topics", f"WITH {_LABELLED} SELECT d.id, d.title, d.topic AS topics, l.llm_topic FROM docs d LEFT JOIN labelled l ON l.topic = d.topic")
def docs_topics(spark, folder):
    docs = topical(spark, folder).select("id", "title", F.col("topic").alias("topics"))
    info = labelled(spark, folder).select(F.col("topic").alias("Topic"), "llm_topic")
    return views.cluster_view(docs, info).select("id", "title", "topics", "llm_topic")


@query("a12_label_mode", """WITH r AS (SELECT conv_id % 10 AS topic, role || CAST(turn AS VARCHAR) AS label FROM conversations),
v AS (SELECT topic, label, count(*) AS n FROM r GROUP BY ALL)
SELECT topic, label FROM (SELECT topic, label, row_number() OVER (PARTITION BY topic ORDER BY n DESC, label) AS p FROM v) WHERE p = 1""")
def label_mode(spark, folder):
    rounds = table(spark, folder, "conversations").select(
        (F.col("conv_id") % 10).alias("topic"), F.concat("role", F.col("turn").cast("string")).alias("label")
    )
    return labels.majority_label(rounds)


@query("f7_too_long", "SELECT conv_id, turn, len(string_split(text, ' ')) > 10 AS too_long FROM conversations")
def long_answers(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", too_long(F.col("text")).alias("too_long"))


@query("f8_clean_labels", r"""WITH a AS (
  SELECT conv_id, turn, 'ignored [/INST]' || chr(10) || ' Topic: "' || text || '": ' || role AS answer FROM conversations),
b AS (SELECT conv_id, turn, trim(string_split(answer, '[/INST]' || chr(10))[-1], ' ' || chr(10) || chr(9)) AS t FROM a),
c AS (SELECT conv_id, turn, CASE WHEN contains(t, ':') THEN trim(string_split(t, ':')[2], ' ' || chr(10) || chr(9)) ELSE t END AS t FROM b),
d AS (SELECT conv_id, turn, trim(replace(t, '"', ''), ' ' || chr(10) || chr(9)) AS t FROM c)
SELECT conv_id, turn, trim(string_split(t, chr(10))[1], ' ' || chr(10) || chr(9)) AS label FROM d""")
def cleaned(spark, folder):
    answer = F.concat(F.lit('ignored [/INST]\n Topic: "'), "text", F.lit('": '), "role")
    return table(spark, folder, "conversations").select("conv_id", "turn", clean_label(answer).alias("label"))


@query("g14_split_cluster")
def split(spark, folder):
    from topicloom.operators.density import hdbscan

    rows = vectors(spark, folder).withColumnRenamed("topic", "cluster")

    def cluster_fn(part):
        return hdbscan(keep(part.select("id", "vec"), "part"), min_cluster_size=3, min_samples=1)

    return split_cluster(rows, 0, cluster_fn).select("id", "cluster")


def _split_sql() -> str:
    """SQL of the split recipe from scratch: density labels of cluster 0's documents,
    sub-topics by size from 1000, written back, and a whole new fit."""
    import re

    from topicloom.catalog.clusters import PRIM, labels_sql, reach_sql

    density = f"{reach_sql(1)}, {PRIM}, {labels_sql(3)}"
    names = set(re.findall(r"(\w+) AS (?:MATERIALIZED )?\(", density)) | {"emb", "tree"}
    density = re.sub(r"\b(" + "|".join(sorted(names)) + r")\b", r"h_\1", density)
    density = density.replace("FROM embeddings)", "FROM embeddings WHERE label = 0 AND vec_id IN (SELECT doc_id FROM documents))", 1)
    return f"""WITH RECURSIVE {TOPICAL}, {density},
subrank AS (SELECT label AS old, row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS new FROM h_labels WHERE label <> -1 GROUP BY label),
moved AS (SELECT l.id, CASE WHEN l.label = -1 THEN -1 ELSE r.new + 1000 END AS topic FROM h_labels l LEFT JOIN subrank r ON r.old = l.label),
split AS (SELECT d.id, d.title, d.text, coalesce(m.topic, d.topic) AS topic FROM docs d LEFT JOIN moved m ON m.id = d.id),
{_fit_sql('split')} {_INFO}"""


@query("g14_split_refit", _split_sql())
def split_refit(spark, folder):
    from topicloom.operators.density import hdbscan

    vecs = vectors(spark, folder).select("id", "vec")
    docs = topical(spark, folder).withColumnRenamed("topic", "cluster").join(vecs, "id", "left")
    # The earlier fit's term counts per cluster; the split updates them instead of counting again.
    counts = keep(topics.term_counts(docs, "cluster", **DESCRIBE), "fit-counts")

    def cluster_fn(part):
        return hdbscan(keep(part.select("id", "vec"), "part"), min_cluster_size=3, min_samples=1)

    model = split_and_refit(docs, counts, 0, cluster_fn, **DESCRIBE)
    return flat_info(model["topic_info"])
