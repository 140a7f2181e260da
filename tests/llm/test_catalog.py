"""Registered queries against DuckDB, and the held-out quality of the classifiers."""

import pytest
from check_oracle import compare, connect
from llm_tables import FOLDER, MEDIUM

from topicloom.llm.catalog import LLM_ORACLES, LLM_QUERIES


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_matches_sql(spark, db, name):
    rows, problem = compare(spark, db, FOLDER, name, LLM_QUERIES[name], LLM_ORACLES[name])
    assert problem is None
    assert rows > 0


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES)
    assert numbers == list(range(1, 14))


# The toxic rows of the small table are few (33 to fit on), so more of them may be missed there.
@pytest.mark.parametrize(
    "name, label, least", [("op7_quality_classifier", "quality", 0.95), ("op2_toxicity", "toxic", 0.9)]
)
def test_held_out_accuracy(spark, name, label, least):
    scored = LLM_QUERIES[name](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", label).collect()
    right = sum(r["predicted"] == r[label] for r in rows) / len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert right >= least, right
    clean = 1 if label == "quality" else 0  # rows that a filter would have to keep
    assert sum(r["predicted"] != r[label] for r in rows if r[label] == clean) <= 0.02 * len(rows)
