from pyspark.sql import functions as F

from topicloom.llm import mixing


def test_targets_near_and_twice_at_most(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.expr("case when id % 3 = 0 then 'hot' else concat('s', id % 7) end").alias("source"),
        F.expr("repeat('w ', cast(1 + id % 9 as int))").alias("text"),
    )
    rows = mixing.mix(docs).collect()
    total = sum(r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) - 1.5 * total) <= 40
    by = {}
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by.setdefault(r["source"], [0, r["target"], r["source_size"]])[0] += r["taken"]
    for taken, target, size in by.values():
        assert abs(taken - target) <= 20 and target <= 2 * size
    again = mixing.mix(docs.repartition(13)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_weights_and_refill(spark):
    # Weights 5, 2, 1 by source; the first stops at twice its size and the rest is shared again.
    docs = spark.createDataFrame(
        [(i, s, "w " * 10) for i, s in enumerate("a" * 2 + "b" * 10 + "c" * 10)], "doc_id long, source string, text string"
    )
    target = {r["source"]: r["target"] for r in mixing.mix(docs).collect()}
    assert target == {"a": 40.0, "b": 290 * 2 / 3, "c": 290 / 3}


def test_edges(edge_docs, no_docs):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["size"] == 0 and r["taken"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert mixing.mix(no_docs).count() == 0
    plain = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    served = mixing.repeat(plain)
    assert served.columns == plain.columns
    words = sum(r["taken"] for r in rows)
    assert served.select(F.sum(mixing.word_number(F.col("text")))).first()[0] == words
    plan = mixing.mix(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
