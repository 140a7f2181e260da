"""Reading document tables: many inputs, pruned columns, schemas, year ranges."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def topic_schema(embedding_col: str, reduced_col: str, cluster_col: str) -> T.StructType:
    """Explicit schema of an embedded document table."""
    vector = T.ArrayType(T.DoubleType())
    return T.StructType(
        [
            T.StructField("publication_id", T.StringType()),
            T.StructField("abstract", T.StringType()),
            T.StructField("title", T.StringType()),
            T.StructField(embedding_col, vector),
            T.StructField(reduced_col, vector),
            T.StructField(cluster_col, T.IntegerType()),
        ]
    )


def scan(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType | None = None) -> DataFrame:
    """One table from one or many parquet paths; columns are matched by name."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    return reader.parquet(*paths)


def concat(tables: Iterable[DataFrame]) -> DataFrame:
    """Rows of all tables; a column some of them lack is null there."""
    tables = list(tables)
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def load_columns(
    table: DataFrame, columns: Iterable[str], id_col: str = "publication_id"
) -> DataFrame:
    """Id (renamed to ``id``) and the given columns; rows with any null are dropped."""
    picked = table.select(F.col(id_col).alias("id"), *[c for c in columns if c != id_col])
    return picked.na.drop("any")


def load_titles(table: DataFrame, id_col: str = "publication_id") -> DataFrame:
    return load_columns(table, ["title"], id_col)


def load_abstracts(table: DataFrame) -> DataFrame:
    return table.select("abstract").na.drop("any")


def year_range(table: DataFrame, start: int, end: int) -> DataFrame:
    """Rows with start <= year < end; prunes folders when ``year`` is a partition column."""
    return table.where((F.col("year") >= start) & (F.col("year") < end))


def read_years(spark: SparkSession, root: str, start: int, end: int, bare: bool = False) -> DataFrame:
    """Year range of a table with one ``year=`` folder per year, or one ``2001``-like if ``bare``.

    Bare folders are named in one path pattern, which skips years that are missing; the year
    column comes from the file's path.  Without any folder in the range it fails like a
    missing table.
    """
    if not bare:
        return year_range(spark.read.parquet(root), start, end)
    years = ",".join(str(year) for year in range(start, end))
    rows = spark.read.parquet(f"{root}/{{{years}}}")
    year = F.regexp_extract("_metadata.file_path", r"/([0-9]{4})/[^/]+$", 1).cast("int")
    return rows.select("*", year.alias("year"))


def write_years(docs: DataFrame, path: str) -> None:
    """One folder per year; years without rows write nothing.

    Rows are not shuffled to one task per year: a year may hold a third of them.
    """
    docs.write.partitionBy("year").parquet(path)
