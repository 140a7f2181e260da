"""Repeated ids, null clusters, zero vectors and unknown languages have defined rows."""

from pyspark.sql import functions as F

from topicloom.functions.prompts import TOPIC_EXAMPLE_TEMPLATE
from topicloom.operators.cleaning import clean_documents
from topicloom.operators.dedupe import dedupe_map
from topicloom.operators.embedding import hashed_embedding
from topicloom.operators.labels import topic_prompts
from topicloom.operators.language import detect_language, language_filter, train_profiles
from topicloom.operators.outliers import reassign_by_centroid
from topicloom.operators.refine import remap_clusters
from topicloom.operators.topics import fit_topics
from topicloom.plans.cluster import reduce_vectors
from topicloom.plans.embed import embed_years
from topicloom.sources.columns import append_column
from topicloom.sources.documents import read_years, write_years


def test_repeated_ids_do_not_multiply_rows(spark):
    docs = spark.createDataFrame([(1, 0), (2, 0)], "id long, cluster int")
    values = spark.createDataFrame([(1, 5), (1, 7)], "id long, x int")
    rows = append_column(docs, values, "x").select("id", "x").collect()
    assert sorted(map(tuple, rows), key=str) == [(1, 7), (2, None)]
    mapped = remap_clusters(docs, values.withColumnRenamed("x", "cluster"), keep_unmapped=True)
    assert sorted(map(tuple, mapped.select("id", "cluster").collect())) == [(1, 7), (2, 0)]


def test_null_cluster_is_the_outlier(spark):
    docs = spark.createDataFrame([(1, 3, "cat dog"), (2, None, "cat sun"), (3, -1, "sun dog")], "id long, cluster int, abstract string")
    assigned, _, _ = fit_topics(docs, stop_words=[])
    assert {r["id"]: r["topic"] for r in assigned.collect()} == {1: 0, 2: -1, 3: -1}


def test_zero_vector_stays_an_outlier(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 1), (3, [0.0, 0.0], -1), (4, [0.9, 0.1], -1)]
    docs = spark.createDataFrame(rows, "id long, vec array<double>, topic int")
    got = {r["id"]: r["topic"] for r in reassign_by_centroid(docs, 0.4).collect()}
    assert got == {1: 0, 2: 1, 3: -1, 4: 0}


def test_every_document_gets_a_language_row(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "日本", None), (4, None, None), (5, "", None)],
        "id long, text string, lang string",
    )
    profiles = train_profiles(docs.where("lang IS NOT NULL"))
    got = {r["id"]: r["language"] for r in detect_language(docs, profiles).collect()}
    assert got == {1: "en", 2: "de", 3: None, 4: None, 5: None}


def _raw(spark, n=60):
    words = "the cat and the dog went over a hill with many other words in the long text of this paper " * 2
    return spark.range(n).select(
        "id", F.lit("A title").alias("title"), F.lit(words).alias("abstract"), (2000 + F.col("id") % 4).cast("int").alias("year")
    )


def test_text_stage_has_no_exchange(spark):
    docs = _raw(spark)
    profiles = train_profiles(docs.select(F.col("abstract").alias("text"), F.lit("en").alias("lang")))
    staged = language_filter(clean_documents(docs), profiles)
    staged = hashed_embedding(staged, 16)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert staged.count() == 60
    cleaned = clean_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert cleaned.count("split(abstract") <= 1


def test_embed_years_over_year_folders(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    write_years(_raw(spark), source)
    profiles = train_profiles(_raw(spark).select(F.col("abstract").alias("text"), F.lit("en").alias("lang")))
    embed_years(spark, source, target, 2001, 2003, profiles, dim=8)
    out = spark.read.parquet(target)
    assert {r["year"] for r in out.select("year").distinct().collect()} == {2001, 2002}
    assert out.count() == 30 and out.where("size(embeddings) = 8").count() == 30


def test_bare_year_folders(spark, tmp_path):
    docs = _raw(spark)
    for year in (2000, 2002):
        docs.where(F.col("year") == year).drop("year").write.parquet(f"{tmp_path}/{year}")
    got = read_years(spark, str(tmp_path), 2001, 2004, bare=True)
    assert {r["year"] for r in got.select("year").distinct().collect()} == {2002} and got.count() == 15


def test_topics_without_titles_and_own_templates(spark):
    info = spark.createDataFrame([(0, ["cat", "dog"]), (1, ["sun"])], "topic int, representation array<string>")
    samples = spark.createDataFrame([(0, ["A title"])], "topic int, titles_sample array<string>")
    rows = {r["topic"]: r["prompt"] for r in topic_prompts(info, samples, "K {keywords} T {titles}").collect()}
    assert rows == {0: "K cat, dog T - A title", 1: "K sun T "}
    shown = topic_prompts(info, samples, TOPIC_EXAMPLE_TEMPLATE).where("topic = 0").first()["prompt"]
    assert shown.count("Topic:") == 2 and shown.endswith("Topic:")


def test_saved_copies_and_neighbours(spark, tmp_path):
    rows = [(i, [float(i % 5), float(i % 3), 1.0]) for i in range(40)]
    docs = spark.createDataFrame(rows, "id long, embeddings array<double>")
    copies = dedupe_map(docs.withColumnRenamed("embeddings", "vec"), "vec")
    path = f"{tmp_path}/knn"
    placed = reduce_vectors(docs, n_neighbors=4, n_epochs=1, copies=copies, save_knn=path)
    assert placed.count() == 40
    assert spark.read.parquet(path).select("src").distinct().count() == copies.select("rep_id").distinct().count()
