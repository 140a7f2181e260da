"""Queries over document tables: scans, cleaning, language, embedding, columns."""

from pyspark.sql import functions as F

from topicloom.catalog.registry import RAW, VECTORS, query, raw, table, vectors
from topicloom.functions.text import truncate, word_count
from topicloom.functions.vectors import mean_pool, normalise
from topicloom.operators import cleaning, language
from topicloom.operators.embedding import hashed_embedding
from topicloom.sources import columns, documents

CLEAN = RAW + """, kept AS (
  SELECT id, title, abstract, year, lang,
         len(list_filter(string_split_regex(abstract, '\\s+'), lambda w: w <> ''))
         + len(list_filter(string_split_regex(title, '\\s+'), lambda w: w <> '')) AS length
  FROM raw
  WHERE NOT (title IS NULL AND abstract IS NULL)
    AND abstract IS DISTINCT FROM '' AND title IS DISTINCT FROM ''),
clean AS (
  SELECT id, coalesce(title, '') AS title, coalesce(abstract, '') AS abstract, year, lang, length,
         coalesce(title, '') || ' ' || coalesce(abstract, '') AS text
  FROM kept WHERE length >= 20)"""


@query("s1_scan_multi", """SELECT doc_id AS id, text, lang, NULL::VARCHAR AS role FROM documents
UNION ALL SELECT conv_id, text, NULL, role FROM conversations
UNION ALL SELECT item_id, text, NULL, NULL FROM benchmark""")
def scan_multi(spark, folder):
    return documents.concat(
        [
            documents.scan(spark, [f"{folder}/documents.parquet"]).select(F.col("doc_id").alias("id"), "text", "lang"),
            table(spark, folder, "conversations").select(F.col("conv_id").alias("id"), "text", "role"),
            table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text"),
        ]
    )


@query("s2_load_pruned", f"WITH {RAW} SELECT id, title, abstract FROM raw WHERE id IS NOT NULL AND title IS NOT NULL AND abstract IS NOT NULL")
def load_pruned(spark, folder):
    return documents.load_columns(raw(spark, folder), ["title", "abstract"], "id")


@query("s3_schema_scan", f"WITH {VECTORS} SELECT id, topic, len(vec) AS dims, round(list_sum(vec), 6) AS total FROM emb")
def schema_scan(spark, folder):
    schema = "vec_id long, embedding array<float>, label int"
    rows = documents.scan(spark, f"{folder}/embeddings.parquet", schema)
    vec = F.col("embedding").cast("array<double>")
    return rows.select(
        F.col("vec_id").alias("id"),
        F.when(F.col("label") == 9, -1).otherwise(F.col("label")).alias("topic"),
        F.size(vec).alias("dims"),
        F.round(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


@query("s4_year_range", f"WITH {RAW} SELECT id, year, title FROM raw WHERE year >= 2005 AND year < 2012")
def year_range(spark, folder):
    return documents.year_range(raw(spark, folder), 2005, 2012).select("id", "year", "title")


@query("s6_append_column", """SELECT d.doc_id AS id, d.lang, l.quality AS quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def append_column(spark, folder):
    values = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality")
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang")
    return columns.append_column(docs, values, "quality")


@query("s7_column_suffix", """SELECT d.doc_id AS id, coalesce(l.toxic, -1) AS toxic_50mcs_25ms FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def column_suffix(spark, folder):
    values = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "toxic")
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return columns.append_column(docs, values, "toxic", na_value=-1, mcs=50, ms=25)


@query("s17_titles", f"WITH {RAW} SELECT id, title FROM raw WHERE title IS NOT NULL")
def titles(spark, folder):
    return documents.load_titles(raw(spark, folder), "id")


@query("s17_abstracts", f"WITH {RAW} SELECT abstract FROM raw WHERE abstract IS NOT NULL")
def abstracts(spark, folder):
    return documents.load_abstracts(raw(spark, folder))


@query("p1_p6_clean_text", f"WITH {CLEAN} SELECT id, title, abstract, year, length, text FROM clean")
def clean_text(spark, folder):
    return cleaning.clean_documents(raw(spark, folder)).select("id", "title", "abstract", "year", "length", "text")


@query("p2_blank_rows", f"WITH {RAW} SELECT id, title, abstract FROM raw WHERE NOT (title IS NULL AND abstract IS NULL) AND abstract IS DISTINCT FROM '' AND title IS DISTINCT FROM ''")
def blank_rows(spark, folder):
    return cleaning.drop_blank(raw(spark, folder)).select("id", "title", "abstract")


@query("f1_word_count", """SELECT doc_id AS id, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS words FROM documents""")
def words(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), word_count(F.col("text")).alias("words"))


@query("f3_truncate", """SELECT doc_id AS id, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS label FROM documents""")
def truncated(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), truncate(F.col("text"), 100).alias("label"))


@query("f9_normalise", f"WITH {VECTORS} SELECT id, round(list_sum(list_transform(vec, lambda v: 3 * v)) / sqrt(list_sum(list_transform(vec, lambda v: 9 * v * v))), 6) AS total FROM emb")
def normalised(spark, folder):
    scaled = normalise(F.transform("vec", lambda v: 3 * v))
    total = F.aggregate("unit", F.lit(0.0), lambda a, x: a + x)
    return vectors(spark, folder).select("id", scaled.alias("unit")).select("id", F.round(total, 6).alias("total"))


_GRAMS = r"""letters AS (
  SELECT doc_id AS id, lang, string_split(' ' || lower(regexp_replace(text, '[^\p{L}]+', ' ', 'g')) || ' ', '') AS c FROM documents),
grams AS (
  SELECT id, lang, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM letters),
counted AS (SELECT lang, gram, count(*) AS n FROM grams GROUP BY lang, gram),
profiles AS (
  SELECT lang, gram, ln(n / total) + 15.0 AS weight FROM (
    SELECT lang, gram, n, sum(n) OVER (PARTITION BY lang) AS total,
           row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS r FROM counted)
  WHERE r <= 300),
scores AS (
  SELECT g.id, p.lang, sum(p.weight) AS score FROM grams g JOIN profiles p ON p.gram = g.gram GROUP BY g.id, p.lang),
best AS (
  SELECT id, lang AS language, score FROM (
    SELECT id, lang, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) AS r FROM scores) WHERE r = 1)"""


@query("g16_language_id", f"WITH {_GRAMS} SELECT d.doc_id AS id, language, round(score, 3) AS score FROM documents d LEFT JOIN best b ON b.id = d.doc_id")
def language_id(spark, folder):
    docs = table(spark, folder, "documents").withColumnRenamed("doc_id", "id")
    profiles = language.train_profiles(docs)
    return language.detect_language(docs, profiles).withColumn("score", F.round("score", 3))


@query("p7_language_filter", f"WITH {_GRAMS} SELECT d.doc_id AS id, d.lang, b.language FROM documents d JOIN best b ON b.id = d.doc_id WHERE b.language = 'en'")
def language_filter(spark, folder):
    docs = table(spark, folder, "documents").withColumnRenamed("doc_id", "id")
    return language.language_filter(docs, language.train_profiles(docs), "en", "text").select("id", "lang", "language")


@query("a7_mean_pool", f"""WITH {VECTORS},
t AS (SELECT id, list_transform(range(8), lambda i: vec[8 * i + 1 : 8 * i + 8]) AS toks,
             list_transform(range(8), lambda i: CASE WHEN (id + i) % 3 = 0 OR id % 7 = 0 THEN 0 ELSE 1 END) AS mask FROM emb),
d AS (SELECT id, toks, mask, unnest(range(1, 9)) AS pos FROM t)
SELECT id, pos, round(list_sum(list_transform(range(1, 9), lambda i: toks[i][pos] * mask[i])) / greatest(list_sum(mask), 1e-9), 6) + 0.0 AS value FROM d""")
def pooled(spark, folder):
    starts = F.sequence(F.lit(0), F.lit(7))
    tokens = F.transform(starts, lambda i: F.slice("vec", i * 8 + 1, 8))
    masked = F.transform(
        starts,
        lambda i: F.when(((F.col("id") + i) % 3 == 0) | (F.col("id") % 7 == 0), 0).otherwise(1),
    )
    rows = vectors(spark, folder).select("id", tokens.alias("tokens"), masked.alias("mask"))
    pooled = rows.select("id", mean_pool(F.col("tokens"), F.col("mask")).alias("v"))
    return pooled.select("id", F.posexplode("v").alias("pos", "x")).select(
        "id", (F.col("pos") + 1).cast("long").alias("pos"), (F.round("x", 6) + 0.0).alias("value")
    )


@query("g17_embed_text", r"""WITH words AS (
  SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
counted AS (
  SELECT id, CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 64 AS bucket, count(*) AS n FROM words GROUP BY ALL),
norms AS (SELECT id, sqrt(sum(n * n)) AS norm FROM counted GROUP BY id)
SELECT c.id, c.bucket, round(c.n / m.norm, 6) AS value FROM counted c JOIN norms m ON m.id = c.id""")
def embedded(spark, folder):
    docs = table(spark, folder, "documents").withColumnRenamed("doc_id", "id")
    rows = hashed_embedding(docs, 64, "text").select("id", F.posexplode("embedding").alias("bucket", "x"))
    return rows.where("x > 0").select("id", F.col("bucket").cast("long").alias("bucket"), F.round("x", 6).alias("value"))
