"""Queries that write a table into a fresh folder and read it back."""

import uuid

from pyspark.sql import functions as F

from topicloom.catalog.registry import RAW, VECTORS, query, raw, table, vectors
from topicloom.functions.text import leading_bytes
from topicloom.operators.dedupe import dedupe_map
from topicloom.sources import artifacts, columns, documents
from topicloom.workspace import scratch_root


def fresh(spark, name):
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@query("s5_write_years", f"WITH {RAW} SELECT id, title, year FROM raw")
def write_years(spark, folder):
    path = fresh(spark, "years")
    documents.write_years(raw(spark, folder), path)
    return spark.read.parquet(path).select("id", "title", F.col("year").cast("int").alias("year"))


@query("s4_year_folders", f"WITH {RAW} SELECT id, year, title FROM raw WHERE year >= 2005 AND year < 2012")
def year_folders(spark, folder):
    path = fresh(spark, "years")
    documents.write_years(raw(spark, folder), path)
    return documents.read_years(spark, path, 2005, 2012).select("id", "year", "title")


@query("s9_s10_csv", f"""WITH {RAW}
SELECT CAST(id AS INTEGER) AS "Topic", CAST(year AS BIGINT) AS "Count", title AS "Name", lang || '|' || title AS terms,
       CAST(NULL AS VARCHAR) AS llm_topic FROM raw""")
def csv_round_trip(spark, folder):
    rows = raw(spark, folder).select(
        F.col("id").cast("int").alias("Topic"), F.col("year").cast("long").alias("Count"), F.col("title").alias("Name"),
        F.array("lang", "title").alias("Representation"), F.array("title").alias("titles_sample"),
        F.lit(None).cast("string").alias("llm_topic"),
    )
    path = fresh(spark, "csv")
    artifacts.write_csv(rows, path)
    back = artifacts.read_csv(spark, path)
    return back.select("Topic", "Count", "Name", F.array_join("Representation", "|").alias("terms"), "llm_topic")


@query("s11_dedupe_map", f"WITH {VECTORS} SELECT id, min(id) OVER (PARTITION BY vec) AS rep_id FROM emb")
def stored_dedupe(spark, folder):
    path = fresh(spark, "map")
    artifacts.save_dedupe(dedupe_map(vectors(spark, folder), "vec"), path)
    return artifacts.load_dedupe(spark, path)


@query("s13_model", """SELECT 'doc_topics' AS tab, count(*) AS n, CAST(sum(label) AS BIGINT) AS total FROM embeddings
UNION ALL SELECT 'topic_info', count(DISTINCT label), CAST(sum(DISTINCT label) AS BIGINT) FROM embeddings
UNION ALL SELECT 'ctfidf', count(*), CAST(sum(quality) AS BIGINT) FROM labels""")
def stored_model(spark, folder):
    topics = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("x"))
    path = fresh(spark, "model")
    weights = table(spark, folder, "labels").select(F.col("quality").alias("x"))
    artifacts.save_model(path, topics, topics.select("x").distinct(), weights)
    tables = artifacts.load_model(spark, path)
    counted = [
        tables[name].agg(F.lit(name).alias("tab"), F.count("*").alias("n"), F.sum("x").cast("long").alias("total"))
        for name in ("doc_topics", "topic_info", "ctfidf")
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


_LABELLED = "FROM documents d LEFT JOIN (SELECT vec_id, max(label) AS label FROM embeddings GROUP BY vec_id) e ON e.vec_id = d.doc_id"


@query("s14_topics", f"SELECT d.doc_id AS id, d.lang, e.label AS topic {_LABELLED}")
def stored_topics(spark, folder):
    values = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("topic"))
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang")
    path = fresh(spark, "topics")
    columns.save_column(docs, values, "topic", path)
    return spark.read.parquet(path)


@query("s15_clusters", f"SELECT d.doc_id AS id, coalesce(e.label, -1) AS cluster_50mcs_25ms {_LABELLED}")
def stored_clusters(spark, folder):
    # Every value twice: a repeated id must not multiply documents.
    values = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster"))
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    path = fresh(spark, "clusters")
    columns.save_column(docs, values.unionAll(values), "cluster", path, na_value=-1, mcs=50, ms=25)
    return spark.read.parquet(path)


@query("f12_leading_bytes", """SELECT doc_id AS id, substr(text, 1, list_max(list_filter(range(0, 101),
  lambda i: octet_length(encode(substr(text, 1, i))) <= 100))) AS head FROM documents""")
def heads(spark, folder):
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), leading_bytes(F.col("text"), 100).alias("head")
    )
