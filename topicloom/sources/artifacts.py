"""Stored results: CSV tables, dedupe maps, neighbour graphs, topic models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOPIC_INFO = T.StructType(
    [
        T.StructField("Topic", T.IntegerType()),
        T.StructField("Count", T.LongType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Representation", T.ArrayType(T.StringType())),
        T.StructField("titles_sample", T.ArrayType(T.StringType())),
        T.StructField("llm_topic", T.StringType()),
    ]
)

# Options that let quotes, commas and line breaks inside a value survive.
_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def write_csv(table: DataFrame, path: str) -> None:
    """CSV with a header; arrays are stored as JSON text."""
    columns = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in table.schema.fields
    ]
    table.select(*columns).write.options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TOPIC_INFO) -> DataFrame:
    """Read a table written by ``write_csv`` back into its schema."""
    text = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType)
            for f in schema.fields
        ]
    )
    rows = spark.read.options(**_CSV).schema(text).csv(path)
    return rows.select(
        *[
            F.from_json(f.name, f.dataType).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def save_dedupe(dedupe: DataFrame, path: str) -> None:
    dedupe.select("id", "rep_id").write.parquet(path)


def load_dedupe(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(
    path: str,
    doc_topics: DataFrame,
    topic_info: DataFrame,
    ctfidf: DataFrame,
    topic_embeddings: DataFrame | None = None,
    topic_map: DataFrame | None = None,
) -> None:
    """A topic model is a folder of parquet tables."""
    tables = {
        "doc_topics": doc_topics,
        "topic_info": topic_info,
        "ctfidf": ctfidf,
        "topic_embeddings": topic_embeddings,
        "topic_map": topic_map,
    }
    for name, table in tables.items():
        if table is not None:
            table.write.parquet(f"{path}/{name}")


def load_model(spark: SparkSession, model) -> dict[str, DataFrame]:
    """A model given as a folder or as an already loaded dict of tables."""
    if isinstance(model, dict):
        return model
    if not isinstance(model, str):
        raise TypeError("a topic model is a folder path or a dict of tables")
    root = spark._jvm.org.apache.hadoop.fs.Path(model)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
    return {name: spark.read.parquet(f"{model}/{name}") for name in names}
