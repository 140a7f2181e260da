"""The corpus pipeline: five stages from raw documents to token ids, each written and reread.

Stages work on all their predecessor kept.  All but the last return the columns of documents.
Repeated ids are separate rows except where a stage's operator says otherwise; extra columns
of the input are dropped, missing ones are an error.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import bpe_automaton, jaccard_join, mixing, pii_crf, quality_classifier
from topicloom.workspace import scratch_root, ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
QUALITY = 0.3
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model is fitted on ``labels``.

    Null and empty texts are scored like others.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    vectors, network = quality_classifier.fit(docs, labels)
    scored = quality_classifier.score(docs, vectors, network, carry=COLUMNS[1:])
    return scored.where(F.col("score") >= QUALITY).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one whose id names the group.

    Of rows that share that id (one document, by the operator) one with the least text stays,
    null first.  Rows with a null id belong to no group and all stay.
    """
    ship(spark)
    found = jaccard_join.near_duplicates(docs)
    heads = found.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.select(*COLUMNS).join(heads, "doc_id", "left_semi")
    # Ids that occur once need no choice; only repeated ones are grouped.
    repeated = docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    single = named.join(repeated, "doc_id", "left_anti")
    row = F.struct("text", "lang", "source", "n_chars")
    several = named.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("r"))
    chosen = several.select("doc_id", "r.*")
    return single.union(chosen).union(docs.select(*COLUMNS).where("doc_id IS NULL"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    ship(spark)
    found = pii_crf.find_pii(docs, carry=("lang", "source"), redacted=True)
    text = F.col("redacted")
    return found.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice.

    Documents without words take no share of the budget and stay once.
    """
    return mixing.repeat(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the token ids (little-endian unsigned 32-bit) of every row.

    The ids are decoded again as well; ids that do not read back are an error.
    """
    ship(spark)
    return read_back(bpe_automaton.encode_decode(docs, TOKENIZER, carry=("source",)))


def read_back(found: DataFrame) -> DataFrame:
    """The rows without ``decoded``; an error where it does not hold one label for every id."""
    labels = F.when(F.col("decoded") == "", 0).otherwise(F.size(F.split("decoded", " ")))
    wrong = F.raise_error(F.concat(F.lit("ids do not read back: "), F.coalesce(F.hex("ids"), F.lit("null"))))
    ids = F.when(F.coalesce(labels == F.col("n_tokens"), F.lit(False)), F.col("ids")).otherwise(wrong.cast("binary"))
    return found.withColumn("ids", ids).drop("decoded")


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", pii),
    ("mix_sources", mixed),
    ("bpe_encode", tokens),
]
# The classifier cannot be said in SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every result but the last is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{scratch_root(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
