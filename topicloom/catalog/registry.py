"""Query registry and the input frames that the queries share.

Each frame has a Spark form and an SQL form (a CTE) with the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators.refine import fill_outliers
from topicloom.workspace import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Words left out of topic terms, in the queries and in their SQL alike.
STOP_WORDS = (
    "the and of to in is it for on with as at by an be or that this from are was "
    "der die das und ist von mit den le la les des et en que qui el los las de un"
).split()
STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


def query(name: str, sql: str | None = None):
    def add(func):
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = sql
        return func

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """id, title (first line), abstract (the rest, null if there is none), year, lang."""
    lines = F.split("text", "\n", 2)
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.get(lines, F.lit(0)).alias("title"),
        F.get(lines, F.lit(1)).alias("abstract"),
        (2000 + F.col("doc_id") % 20).cast("int").alias("year"),
        "lang",
    )


RAW = """raw AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS abstract,
         CAST(2000 + doc_id % 20 AS INTEGER) AS year, lang
  FROM documents)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """id, vec (double), topic (label, 9 standing for outlier)."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.when(F.col("label") == 9, -1).otherwise(F.col("label")).alias("topic"),
    )


VECTORS = """emb AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec,
         CASE WHEN label = 9 THEN -1 ELSE label END AS topic
  FROM embeddings)"""


def topical(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their topic: id, title, text, topic; without a vector an outlier."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.get(F.split("text", "\n", 2), F.lit(0)).alias("title"), "text"
    )
    named = docs.join(vectors(spark, folder).select("id", "topic"), "id", "left")
    return fill_outliers(named, "topic")


TOPICAL = VECTORS + """, docs AS (
  SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS title, d.text, coalesce(e.topic, -1) AS topic
  FROM documents d LEFT JOIN emb e ON e.id = d.doc_id)"""

COUNTS = TOPICAL + f""", counts AS (
  SELECT topic, term, count(*) AS n FROM (
    SELECT topic, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM docs)
  WHERE term NOT IN ({STOP_SQL}) GROUP BY topic, term)"""


def weights_sql(counts: str = "counts", docs: str = "docs") -> str:
    return f"""kept AS (
  SELECT topic, term, n, f FROM (
    SELECT topic, term, n, sum(n) OVER (PARTITION BY term) AS f,
           count(*) OVER (PARTITION BY term) AS df FROM {counts})
  WHERE df >= 0.1 * (SELECT count(DISTINCT topic) FROM {docs})),
totals AS (SELECT topic, sum(n) AS total FROM kept GROUP BY topic),
weights AS (
  SELECT k.topic, k.term, k.n,
         sqrt(k.n / t.total) * ln(1 + (SELECT floor(sum(total) / (SELECT count(DISTINCT topic) FROM {docs})) FROM totals) / k.f) AS weight
  FROM kept k JOIN totals t ON t.topic = k.topic)"""


def info_sql(docs: str = "docs") -> str:
    return f"""sizes AS (SELECT topic, count(*) AS cnt FROM {docs} GROUP BY topic),
ranked AS (
  SELECT topic, term, row_number() OVER (PARTITION BY topic ORDER BY round(weight, 9) DESC, term) AS r FROM weights),
info AS (
  SELECT s.topic, s.cnt,
         CAST(s.topic AS VARCHAR) || '_' || (SELECT string_agg(term, '_' ORDER BY r) FROM ranked x WHERE x.topic = s.topic AND r <= 4) AS name,
         (SELECT string_agg(term, ',' ORDER BY r) FROM ranked x WHERE x.topic = s.topic AND r <= 10) AS representation
  FROM sizes s)"""


DESCRIBE = {"text_col": "text", "stop_words": STOP_WORDS}


def flat_info(info: DataFrame) -> DataFrame:
    return info.withColumn("representation", F.array_join("representation", ","))
