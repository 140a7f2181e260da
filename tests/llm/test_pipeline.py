"""Stages against plain versions of what they decide."""

import random

import corpus_pipeline as pipeline
import numpy as np
import pytest
from llm_tables import FOLDER
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from test_jaccard import brute
from test_pii import plain_spans
from topicloom.llm import pii_crf


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "pii", "mix_sources", "bpe_encode",
    ]


def test_run_over_the_small_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    after = docs
    kept = [docs.count()]
    for _, stage in pipeline.STAGES[:3]:
        after = stage(spark, after, FOLDER).cache()
        assert after.columns == list(pipeline.COLUMNS) and after.schema["doc_id"] == docs.schema["doc_id"]
        kept.append(after.count())
    assert kept[0] > kept[1] > kept[2] == kept[3] > 0.5 * kept[0]
    out = pipeline.run(spark, FOLDER).collect()
    library = Tokenizer.from_file(pipeline.TOKENIZER)
    text = {r["doc_id"]: r["text"] for r in after.collect()}
    for row in random.Random(1).sample(out, 20):
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode(text[row["doc_id"]], add_special_tokens=False).ids
    times = {}
    for row in out:
        times[row["doc_id"]] = times.get(row["doc_id"], 0) + 1
    assert max(times.values()) <= 2


def test_quality_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = pipeline.quality(spark, docs, FOLDER).select("doc_id", F.lit(1).alias("k"))
    rows = docs.join(labels, "doc_id").join(kept, "doc_id", "left").select("quality", "k").collect()
    good = [r["k"] for r in rows if r["quality"] == 1]
    assert sum(k == 1 for k in good) >= 0.97 * len(good)
    bad = [r["k"] for r in rows if r["quality"] == 0]
    assert sum(k is None for k in bad) >= 0.7 * len(bad)


def test_near_duplicates_keep_one_of_each_group(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r["doc_id"] for r in pipeline.near_duplicates(spark, docs, FOLDER).collect()}
    label = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert kept == {i for i, (_, component) in label.items() if i == component}


def test_pii_is_gone(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {r["doc_id"]: r for r in pipeline.pii(spark, docs, FOLDER).collect()}
    hits = 0
    for row in docs.collect():
        spans = plain_spans(row["text"])
        after = out[row["doc_id"]]
        assert after["n_chars"] == len(after["text"])
        hits += bool(spans)
        assert not plain_spans(after["text"])
        assert spans or after["text"] == row["text"]
    assert hits and "[EMAIL]" == f"[{pii_crf.KINDS[0].upper()}]"


@pytest.mark.parametrize("number", range(5))
def test_edges_through_every_stage(spark, edge_docs, no_docs, number):
    stage = pipeline.STAGES[number][1]
    out = stage(spark, edge_docs, FOLDER)
    columns = list(pipeline.COLUMNS) if number < 4 else ["doc_id", "source", "n_tokens", "ids"]
    assert out.columns == columns and out.count() > 0
    assert stage(spark, no_docs, FOLDER).count() == 0


def test_tokens_are_decoded_and_read_back(spark, edge_docs, monkeypatch):
    asked = []
    encode_decode = pipeline.bpe_automaton.encode_decode

    def spied(*args, **options):
        asked.append(encode_decode(*args, **options))
        return asked[-1]

    monkeypatch.setattr(pipeline.bpe_automaton, "encode_decode", spied)
    pipeline.tokens(spark, edge_docs, FOLDER).collect()
    library = Tokenizer.from_file(pipeline.TOKENIZER)
    rows = asked[0].collect()
    assert rows
    for row in rows:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)
    schema = "doc_id long, source string, n_tokens long, ids binary, decoded string"
    for decoded in (None, "", "a b"):
        short = spark.createDataFrame([(1, "s", 1, b"\x01\x00\x00\x00", decoded)], schema)
        with pytest.raises(Exception, match="read back"):
            pipeline.read_back(short).collect()
