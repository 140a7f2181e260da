"""Registered queries of the training-data operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import (
    alignment,
    bpe_automaton,
    embedding_dedup,
    fingerprints,
    jaccard_join,
    licenses,
    mixing,
    pii_crf,
    quality_classifier,
    quality_rules,
    spelling,
    toxicity,
    warc,
)
from topicloom.workspace import scratch_root, ship

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(func):
        LLM_QUERIES[name] = func
        if sql is not None:
            LLM_ORACLES[name] = sql
        return func

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


SPACE_SQL = r"[\x20\x09-\x0D]"
STOP_SQL = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
RULES_SQL = f"""
WITH base AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT rn, doc_id, t,
         list_filter(regexp_split_to_array(t, '{SPACE_SQL}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM base),
windows AS (
  SELECT rn, i, array_to_string(w[i:i+4], ' ') AS win
  FROM (SELECT rn, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
starts AS (
  SELECT rn, i, lead(i) OVER (PARTITION BY rn ORDER BY i) AS nxt
  FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, win) AS c FROM windows) WHERE c > 1),
repeats AS (SELECT rn, sum(least(5, coalesce(nxt - i, 5))) AS n FROM starts GROUP BY rn),
metrics AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{SPACE_SQL}+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(list_filter(w, lambda x: list_contains([{STOP_SQL}], lower(x)))) AS BIGINT) AS n_stop_words
  FROM split LEFT JOIN repeats USING (rn)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, greatest(n_words, 1) AS n FROM metrics)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, base_failed,
       NOT base_failed AND n_words BETWEEN 10 AND 10000000 AND word_chars / n BETWEEN 1.5 AND 25
       AND n_symbols / n <= 0.25 AND (n_stop_words + 1) / n >= 0.02
       AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AND n_repeat_words / n <= 0.2 AS kept
FROM judged"""


@query("op1_quality_rules", RULES_SQL)
def op1(spark, folder):
    return quality_rules.apply_rules(table(spark, folder, "documents"))


MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(list_filter(regexp_split_to_array(text, '{SPACE_SQL}+'), lambda x: x <> '')), 0)::BIGINT AS size,
         md5('mix-' || coalesce(doc_id::VARCHAR, md5(text), '')) AS digest,
         coalesce('s' || source, 'null') AS grp FROM documents),
totals AS (
  SELECT source, grp, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source, grp),
-- Sources reach their cap in the order of cap by weight; the level follows from those that stay below.
filled AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, (SELECT sum(source_size) FROM totals)::DOUBLE * 1.5 AS budget FROM totals),
steps AS (
  SELECT *, coalesce(sum(cap) OVER earlier, 0.0) AS full_before, sum(weight) OVER later AS weight_left,
         row_number() OVER (ORDER BY cap / weight, grp) AS k
  FROM filled
  WINDOW earlier AS (ORDER BY cap / weight, grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         later AS (ORDER BY cap / weight, grp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT coalesce(arg_min((budget - full_before) / weight_left, k) FILTER (
           WHERE cap > weight * ((budget - full_before) / weight_left)), 0) AS l FROM steps),
targets AS (SELECT grp, source_size, least(cap, weight * l) AS target FROM filled, level),
placed AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.grp ORDER BY digest, size ROWS UNBOUNDED PRECEDING) AS cum
  FROM sized s JOIN targets t ON t.grp = s.grp),
served AS (
  SELECT *, CASE WHEN target > 0 THEN (turn * source_size + cum)::DOUBLE / target ELSE 0.0 END AS finish
  FROM placed, (SELECT unnest([0, 1]) AS turn)),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, grp, digest, size, turn ROWS UNBOUNDED PRECEDING) AS total FROM served)
SELECT doc_id, size, source_size, target,
       sum(CASE WHEN total <= (SELECT sum(size) * 1.5 FROM sized) THEN size ELSE 0 END)::BIGINT AS taken
FROM ordered GROUP BY doc_id, size, source_size, target, grp, digest, cum"""


@query("op4_mix_sources", MIX_SQL)
def op4(spark, folder):
    return mixing.mix(table(spark, folder, "documents")).drop("source")


B32 = " || ".join(
    f"substr('{warc.BASE32}', 1 + (((('0x' || substr(h, {1 + 5 * p}, 5))::BIGINT >> {s}) & 31))::INTEGER, 1)"
    for p in range(8)
    for s in (15, 10, 5, 0)
)
WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(t::BLOB)::BIGINT AS payload_bytes, {B32} AS payload_digest FROM
  (SELECT page_id, encode(t) AS t, h FROM p)),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM d JOIN k USING (payload_digest)"""


@query("op9_warc_salvage", WARC_SQL)
def op9(spark, folder):
    path = f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, folder, "pages"), path)
    records = warc.read_archives(spark, path, with_payload=False)
    return records.where(F.col("record_type") != "gap").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op10_bpe_automaton")
def op10(spark, folder):
    out = bpe_automaton.encode_decode(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op7_quality_classifier")
def op7(spark, folder):
    return quality_classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_toxicity")
def op2(spark, folder):
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_pii_skip_chain")
def op6(spark, folder):
    found = pii_crf.find_pii(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans",
    )


JACCARD_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE_SQL}+'),
           lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 5 THEN range(1, len(w) - 3) ELSE range(1, least(len(w), 1) + 1) END) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * p.c >= 80 * (x.n + y.n - p.c)),
r AS (SELECT doc_id AS v, doc_id AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.v AND r.c < l.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, min(r.c)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.v = d.doc_id GROUP BY d.doc_id, n.n"""


@query("op5_ngram_jaccard_join", JACCARD_SQL)
def op5(spark, folder):
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


EMBEDDING_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) >= 0.93 * (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)))),
r AS (SELECT vec_id AS v, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.v AND r.c < l.b),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT m.vec_id, coalesce(n.n, 0) AS n_links, least(m.vec_id, min(r.c)) AS component_id, m.vec_id = least(m.vec_id, min(r.c)) AS kept
FROM embeddings m LEFT JOIN n ON n.a = m.vec_id LEFT JOIN r ON r.v = m.vec_id GROUP BY m.vec_id, n.n"""


@query("op8_embedding_near_dedup", EMBEDDING_SQL)
def op8(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def _license_sql() -> str:
    cases = " ".join(f"WHEN regexp_matches(s, '{p}') THEN '{n}'" for n, p in licenses.SENTENCES)
    matched = "' ' || array_to_string(ids, '  ') || ' '"
    for name, run in licenses.RULES:
        matched = f"replace({matched}, '{''.join(f' {i} ' for i in run)}', ' ={name} ')"
    return f"""
WITH parts AS (
  SELECT row_number() OVER () AS rn, doc_id, CASE WHEN regexp_matches(text, '(?i){licenses.GATE}') THEN
    list_filter(string_split(regexp_replace(text, '([.;!?])\\s+|\\n\\s*\\n', '\\1' || chr(1), 'g'), chr(1)),
      lambda x: regexp_matches(x, '(?i){licenses.GATE}')) ELSE [] END AS p FROM documents),
named AS (
  SELECT doc_id, list_filter(list_transform(list_transform(p, lambda x:
      regexp_replace(trim(regexp_replace(lower(x), '[^a-z0-9.+/-]+|[.]+(?: |$)|(?:^| )[./*#-]+(?: |$)', ' ', 'g')),
        '(cc|commons)-(by|attribution)', '\\1 \\2', 'g')),
    lambda s: CASE {cases} END), lambda x: x IS NOT NULL) AS ids FROM parts),
done AS (SELECT doc_id, ids, list_filter(regexp_split_to_array({matched}, ' +'), lambda x: x <> '') AS items FROM named)
SELECT doc_id, array_to_string(ids, ' ') AS sentences,
       array_to_string(list_sort(list_distinct(list_transform(list_filter(items, lambda i: starts_with(i, '=')), lambda i: substr(i, 2)))), ' ') AS licenses,
       array_to_string(list_filter(items, lambda i: NOT starts_with(i, '=')), ' ') AS unmatched
FROM done"""


@query("op3_license_sentences", _license_sql())
def op3(spark, folder):
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select("doc_id", *[F.array_join(c, " ").alias(c) for c in ("sentences", "licenses", "unmatched")])


@query("op13_ctph_fingerprints")
def op13(spark, folder):
    return fingerprints.fingerprint_edits(table(spark, folder, "documents"))


@query("op12_token_alignment")
def op12(spark, folder):
    return alignment.align_documents(
        table(spark, folder, "documents"),
        public_tokenizers.path(alignment.A_FILE),
        public_tokenizers.path(alignment.B_FILE),
    )


@query("op11_spelling_variants")
def op11(spark, folder):
    return spelling.variant_groups(table(spark, folder, "documents"))
