"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.workspace import drop_kept, keep


def _round(edges: DataFrame) -> DataFrame:
    """A large star, then a small star: edges that point down (u > v), ``_new`` where one was moved.

    Every edge gives one edge, so the table never grows.  Only a join, which may split a key,
    brings together the many edges that point at one vertex.
    """
    down = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # The larger neighbours of each vertex are linked to its least one or to itself.
    low = down.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    large = down.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("_new"))
    # Its smaller neighbours and the vertex itself are linked to the least of them; equal edges become one.
    small = large.repartition("u").groupBy("u", "v").agg(F.max("_new").alias("_new"))
    small = small.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    moved = F.col("v") != F.col("m")
    return small.select(F.when(moved, F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"), (F.col("_new") | moved).alias("_new"))


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs -> (vertex, component): the least vertex reachable, for vertices with an edge.

    Every round is three shuffles, written to the shared folder, so no lineage grows; the rounds
    end with the first that moves no edge.  Only that answer reaches the driver.
    """
    current, moved = None, True
    while moved:
        after = keep(_round(edges if current is None else current), "edges")
        moved = after.agg(F.max("_new")).first()[0]
        drop_kept(current)
        current = after
    # No edge moved: every vertex but the least has one edge, to the least.
    roots = current.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
