import pytest
from pyspark.sql import functions as F

from topicloom.operators.dedupe import dedupe_map
from topicloom.operators.neighbours import as_lists, from_lists
from topicloom.sources import artifacts, columns, documents


def test_year_folders(spark, tmp_path):
    df = spark.createDataFrame([(i, 2000 + i % 4) for i in range(40)], "id long, year int")
    documents.write_years(df, f"{tmp_path}/y")
    got = documents.read_years(spark, f"{tmp_path}/y", 2001, 2003)
    assert {r.year for r in got.collect()} == {2001, 2002} and got.count() == 20
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_scan_pruned_with_schema(spark, tmp_path):
    for name, rows in (("a", [("1", "x", [1.0], 1)]), ("b", [("2", None, [2.0], 2)])):
        spark.createDataFrame(rows, "publication_id string, title string, emb array<double>, c int").write.parquet(f"{tmp_path}/{name}")
    schema = documents.topic_schema("emb", "umap", "c")
    table = documents.scan(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], schema)
    assert table.count() == 2 and table.schema["umap"].dataType.simpleString() == "array<double>"
    loaded = documents.load_columns(table, ["title"])
    assert [tuple(r) for r in loaded.collect()] == [("1", "x")]
    assert "ReadSchema: struct<publication_id:string,title:string>" in loaded._jdf.queryExecution().toString()


def test_append_and_guard(spark, tmp_path):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string")
    values = spark.createDataFrame([(1, 7)], "id long, labels int")
    columns.save_column(table, values, "labels", f"{tmp_path}/v2", mcs=50, ms=25)
    got = {r.id: r.labels_50mcs_25ms for r in spark.read.parquet(f"{tmp_path}/v2").collect()}
    assert got == {1: 7, 2: None}
    with pytest.raises(ValueError):
        columns.save_column(table, values, "umap", f"{tmp_path}/v3")


def test_csv_round_trip(spark, tmp_path):
    row = (0, 5, '0_a_b', ["a", 'b"c'], ["line one\nline two", "x, y"], "Topic, with comma")
    df = spark.createDataFrame([row], artifacts.TOPIC_INFO)
    artifacts.write_csv(df, f"{tmp_path}/info")
    assert [tuple(r) for r in artifacts.read_csv(spark, f"{tmp_path}/info").collect()] == [row]


def test_dedupe_map_and_graph_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [1.0])], "id long, vec array<double>")
    artifacts.save_dedupe(dedupe_map(rows, "vec"), f"{tmp_path}/d")
    assert {(r.id, r.rep_id) for r in artifacts.load_dedupe(spark, f"{tmp_path}/d").collect()} == {(1, 1), (2, 2), (3, 1)}
    edges = spark.createDataFrame([(1, 2, 1, 0.5), (1, 3, 2, 0.7)], "src long, dst long, rank int, dist double")
    as_lists(edges).write.parquet(f"{tmp_path}/g")
    assert sorted(map(tuple, from_lists(spark.read.parquet(f"{tmp_path}/g")).collect())) == sorted(map(tuple, edges.collect()))


def test_model_round_trip(spark, tmp_path):
    t = spark.range(3)
    artifacts.save_model(f"{tmp_path}/m", t, t, t)
    model = artifacts.load_model(spark, f"{tmp_path}/m")
    assert set(model) == {"doc_topics", "topic_info", "ctfidf"} and model["ctfidf"].count() == 3
    assert artifacts.load_model(spark, model) is model
    with pytest.raises(TypeError):
        artifacts.load_model(spark, 3)
