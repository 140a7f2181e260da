"""Density clusters from a merge tree: condensing, excess of mass, labels, validity.

The merge tree is condensed by ``min_cluster_size``: a merge is a true split if both
sides reach that size; otherwise the larger side carries the cluster on and the
points of the smaller one leave it.  True splits cut the chains of the merge tree
into segments, so clusters are found per segment: at most n / min_cluster_size
splits remain to be followed, whatever the number of points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.operators.dendrogram import ROOT_CHAIN, MergeTree, merge_sides, merge_tree
from topicloom.operators.spanning import flatten, spanning_tree
from topicloom.workspace import drop_kept, global_index, keep, running_sum

NOISE = -1
# Merges at distance zero (copies) get the density of this distance.
_MIN_DISTANCE = 1e-12


@dataclass
class Condensed:
    """``clusters``: cid, parent (null for the root), birth (density), stability.
    ``members``: (id, cid), the cluster each point belonged to last."""

    clusters: DataFrame
    members: DataFrame


def condense(tree: MergeTree, min_cluster_size: int) -> Condensed:
    first, second = merge_sides()
    split = F.least("s1", "s2") >= min_cluster_size
    sided = tree.merges.withColumns({"s1": first, "s2": second}).withColumns(
        {
            "split": split,
            "density": 1.0 / F.greatest("w", F.lit(_MIN_DISTANCE)),
            "big": F.col("size") >= min_cluster_size,
        }
    )
    merges = keep(
        running_sum(sided, "chain", "e", F.col("split").cast("long"), "seg").select(
            "e", "density", "chain", "seg", "size", "s1", "s2", "split", "big"
        ),
        "segments",
    )
    large = merges.where("big")
    named = large.groupBy("chain", "seg").agg(F.max("e").alias("sid"))
    large = keep(large.join(named, ["chain", "seg"]), "large-merges")

    # A segment starts below the next split of its chain, or below the edge that
    # names the chain; there it is a cluster of its own only if that edge splits.
    below_split = large.where("split").select(
        "chain",
        (F.col("seg") - 1).alias("seg"),
        F.col("sid").alias("p1"),
        F.col("density").alias("b1"),
    )
    below_name = large.select(
        F.col("e").alias("named_by"),
        F.col("sid").alias("p2"),
        F.col("density").alias("b2"),
        F.col("split").alias("named_splits"),
    )
    segments = keep(
        named.join(below_split, ["chain", "seg"], "left")
        .withColumn(
            "named_by",
            F.when(F.col("p1").isNull() & (F.col("chain") != ROOT_CHAIN), F.expr("chain div 2")),
        )
        .join(below_name, "named_by", "left")
        .select(
            "sid",
            F.coalesce("p1", "p2").alias("up"),
            F.coalesce("b1", "b2", F.lit(0.0)).alias("birth"),
            (F.col("p1").isNull() & F.col("p2").isNotNull() & ~F.col("named_splits")).alias("carries"),
        ),
        "segment-tree",
    )
    carried = flatten(segments.where("carries").select(F.col("sid").alias("v"), F.col("up").alias("p")))
    cluster_of = carried.select(F.col("v").alias("sid"), F.col("p").alias("cid"))
    own = segments.where(~F.coalesce("carries", F.lit(False)))
    parents = cluster_of.select(F.col("sid").alias("up"), F.col("cid").alias("_up"))
    shape = own.join(parents, "up", "left").select(
        F.col("sid").alias("cid"), F.coalesce("_up", "up").alias("parent"), "birth"
    )

    clustered = large.join(cluster_of, "sid", "left").withColumn("cid", F.coalesce("cid", "sid"))
    clustered = keep(clustered.select("e", "cid", "density", "size", "s1", "s2", "split"), "clustered")
    leaving = F.when(F.col("split"), F.col("size")).otherwise(
        F.when(F.col("s1") < min_cluster_size, F.col("s1")).otherwise(0)
        + F.when(F.col("s2") < min_cluster_size, F.col("s2")).otherwise(0)
    )
    mass = clustered.groupBy("cid").agg(
        F.sum(leaving * F.col("density")).alias("left_at"), F.sum(leaving).alias("left")
    )
    stability = F.col("left_at") - F.col("left") * F.col("birth")
    clusters = keep(
        shape.join(mass, "cid").select("cid", "parent", "birth", stability.alias("stability")),
        "clusters",
    )
    return Condensed(clusters, keep(_members(tree, merges, clustered), "members"))


def _members(tree: MergeTree, merges: DataFrame, clustered: DataFrame) -> DataFrame:
    """(id, cid): the cluster of the first large merge above each point."""
    big = merges.where("big")
    crossing = big.groupBy("chain").agg(F.min("e").alias("x"))
    # The root chain is small only if there are too few points for any cluster.
    chains = merges.where(F.col("chain") != ROOT_CHAIN).select("chain").distinct()
    small_chains = chains.join(crossing, "chain", "left_anti")
    above = merges.select(F.col("e").alias("a"), F.col("chain").alias("next"), F.col("big").alias("a_big"))
    climbing = keep(
        small_chains.withColumn("a", F.expr("chain div 2"))
        .join(above, "a")
        .join(crossing.withColumnRenamed("chain", "next"), "next", "left")
        .select("chain", F.when(F.col("a_big"), F.col("a")).otherwise(F.col("x")).alias("target"), "next"),
        "climbing",
    )
    open_ends = climbing.where(F.col("target").isNull())
    jumps = flatten(open_ends.select(F.col("chain").alias("v"), F.col("next").alias("p")))
    ends = climbing.select(F.col("chain").alias("p"), "target").where(F.col("target").isNotNull())
    entered = (
        climbing.where(F.col("target").isNotNull())
        .select("chain", "target")
        .unionByName(jumps.join(ends, "p").select(F.col("v").alias("chain"), "target"))
        .unionByName(crossing.select("chain", F.col("x").alias("target")))
    )
    start = tree.leaf.join(merges.select("e", "chain", "big"), "e")
    return (
        start.join(entered, "chain")
        .select(F.col("v").alias("id"), F.when(F.col("big"), F.col("e")).otherwise(F.col("target")).alias("e"))
        .join(clustered.select("e", "cid"), "e")
        .select("id", "cid")
    )


def select_by_mass(clusters: DataFrame) -> DataFrame:
    """(cid, selected): a cluster wins if its stability is at least its children's value.

    value = max(stability, sum of the children's values), from the leaves up; the
    root is never selected.  A cluster with one resolved child has the value
    max(top, x + add) of the other child's value x.  Such functions compose, so
    runs of them are shortened by doubling, and the number of rounds grows with
    the log of the tree, not with its height.
    """
    inner = clusters.where(F.col("parent").isNotNull())
    inside = inner.select(F.col("parent").alias("cid")).distinct().withColumn("_inside", F.lit(True))
    nothing = F.lit(None)
    state = keep(
        inner.join(inside, "cid", "left").select(
            "cid",
            "parent",
            "stability",
            F.when(F.col("_inside").isNull(), F.col("stability")).alias("value"),
            nothing.cast("long").alias("down"),
            nothing.cast("double").alias("top"),
            nothing.cast("double").alias("add"),
        ),
        "mass",
    )
    while not state.where(F.col("value").isNull()).isEmpty():
        children = state.groupBy(F.col("parent").alias("cid")).agg(
            F.count("value").alias("n"),
            F.sum("value").alias("below"),
            F.max(F.when(F.col("value").isNull(), F.col("cid"))).alias("open"),
        )
        ahead = state.select(
            F.col("cid").alias("down"),
            *[F.col(c).alias(f"d_{c}") for c in ("value", "down", "top", "add")],
        )
        joined = state.join(children, "cid", "left").join(ahead, "down", "left")
        starts = F.col("down").isNull() & (F.col("n") == 1)
        jumps = F.col("d_down").isNotNull()
        value = F.coalesce(
            "value",
            F.when(F.col("n") == 2, F.greatest("stability", "below")),
            F.when(F.col("d_value").isNotNull(), F.greatest(F.col("top"), F.col("d_value") + F.col("add"))),
        )
        further = F.greatest(F.col("top"), F.col("d_top") + F.col("add"))
        following = keep(
            joined.select(
                "cid",
                "parent",
                "stability",
                value.alias("value"),
                F.when(starts, F.col("open")).when(jumps, F.col("d_down")).otherwise(F.col("down")).alias("down"),
                F.when(starts, F.col("stability")).when(jumps, further).otherwise(F.col("top")).alias("top"),
                F.when(starts, F.col("below"))
                .when(jumps, F.col("add") + F.col("d_add"))
                .otherwise(F.col("add"))
                .alias("add"),
            ),
            "mass",
        )
        drop_kept(state)
        state = following
    below = state.groupBy(F.col("parent").alias("cid")).agg(F.sum("value").alias("below"))
    wins = F.col("below").isNull() | (F.col("stability") >= F.col("below"))
    return keep(state.join(below, "cid", "left").select("cid", wins.alias("selected")), "selected")


def _inner_tree(clusters: DataFrame) -> DataFrame:
    """(cid, up, birth) without the root; ``up`` is null right below it."""
    root = clusters.where(F.col("parent").isNull()).select(
        F.col("cid").alias("parent"), F.lit(True).alias("_root")
    )
    return clusters.where(F.col("parent").isNotNull()).join(root, "parent", "left").select(
        "cid", F.when(F.col("_root").isNull(), F.col("parent")).alias("up"), "birth"
    )


def _climb(rows: DataFrame, merge: dict[str, tuple[str, str]]) -> DataFrame:
    """Pointer doubling over (cid, up, ...): ``merge`` names, per carried column, which
    value wins: the ``near`` (own part of the path) or the ``far`` one."""
    current = keep(rows, "climb")
    while not current.where(F.col("up").isNotNull()).isEmpty():
        far = current.select(
            F.col("cid").alias("up"),
            F.col("up").alias("_up"),
            *[F.col(c).alias(f"_{c}") for c in merge],
        )
        carried = [
            F.coalesce(c, f"_{c}").alias(c) if first == "near" else F.coalesce(f"_{c}", c).alias(c)
            for c, first in merge.items()
        ]
        following = keep(
            current.join(far, "up", "left").select("cid", F.col("_up").alias("up"), *carried), "climb"
        )
        drop_kept(current)
        current = following
    return current.drop("up")


def topmost(clusters: DataFrame, chosen: DataFrame) -> DataFrame:
    """(cid, top): the highest chosen cluster among each cluster and its ancestors."""
    rows = _inner_tree(clusters).join(chosen, "cid", "left").select(
        "cid", "up", F.when(F.col("selected"), F.col("cid")).alias("top")
    )
    return _climb(rows, {"top": "far"})


def merge_below(clusters: DataFrame, chosen: DataFrame, epsilon: float) -> DataFrame:
    """Replace chosen clusters born at a distance below ``epsilon`` by the nearest
    ancestor born above it (the highest ancestor below the root if there is none)."""
    inner = keep(_inner_tree(clusters), "inner-clusters")
    far = inner.select(F.col("cid").alias("up"), (1.0 / F.col("birth")).alias("up_dist"))
    rows = inner.join(far, "up", "left").select(
        "cid",
        "up",
        F.when(F.col("up_dist") > epsilon, F.col("up")).alias("above"),
        F.col("up").alias("high"),
    )
    paths = _climb(rows, {"above": "near", "high": "far"})
    tops = topmost(clusters, chosen)
    picked = tops.where(F.col("top") == F.col("cid")).select("cid")
    moved = (
        picked.join(inner.select("cid", "birth"), "cid")
        .join(paths, "cid")
        .select(
            F.when(1.0 / F.col("birth") < epsilon, F.coalesce("above", "high", "cid"))
            .otherwise(F.col("cid"))
            .alias("cid")
        )
    )
    return moved.distinct().withColumn("selected", F.lit(True))


def cluster_labels(tree: MergeTree, min_cluster_size: int, epsilon: float = 0.0) -> DataFrame:
    """(id, label): clusters numbered from 0 by falling size, noise -1."""
    condensed = condense(tree, min_cluster_size)
    chosen = select_by_mass(condensed.clusters)
    if epsilon > 0:
        chosen = merge_below(condensed.clusters, chosen, epsilon)
    tops = topmost(condensed.clusters, chosen)
    named = keep(condensed.members.join(tops, "cid", "left").select("id", "top"), "labelled")
    sizes = named.where(F.col("top").isNotNull()).groupBy("top").agg(
        F.count("*").alias("n"), F.min("id").alias("first")
    )
    ranks = global_index(sizes, [F.col("n").desc(), F.col("first")], "label").select("top", "label")
    labelled = named.join(ranks, "top", "left").select(
        "id", F.coalesce("label", F.lit(NOISE)).cast("int").alias("label")
    )
    # Points without a large merge above them exist only if all of them are too few.
    return tree.leaf.select(F.col("v").alias("id")).join(labelled, "id", "left").select(
        "id", F.coalesce("label", F.lit(NOISE)).alias("label")
    )


def hdbscan(
    points: DataFrame,
    min_cluster_size: int = 50,
    min_samples: int = 50,
    cluster_selection_epsilon: float = 0.0,
    id_col: str = "id",
    vector_col: str = "vec",
    tree: DataFrame | None = None,
) -> DataFrame:
    """(id, label) by hierarchical density clustering; ``tree`` may be computed already."""
    if tree is None:
        tree = spanning_tree(points, min_samples, id_col, vector_col)
    return cluster_labels(
        merge_tree(keep(tree, "spanning-tree")), min_cluster_size, cluster_selection_epsilon
    )


def clustering_metrics(labels: DataFrame, tree: DataFrame) -> DataFrame:
    """One row: validity, topic_count, coverage.

    validity = sum over clusters of size share * (sep - inside) / max(sep, inside):
    inside is the longest tree edge within the cluster, sep the shortest tree edge
    to another cluster (twice the longest tree edge where there is none).
    """
    ends = tree.join(labels.select(F.col("id").alias("lo"), F.col("label").alias("l1")), "lo").join(
        labels.select(F.col("id").alias("hi"), F.col("label").alias("l2")), "hi"
    )
    pair = F.explode(F.array(F.struct(F.col("l1").alias("label"), F.col("l2").alias("far")),
                             F.struct(F.col("l2").alias("label"), F.col("l1").alias("far")))).alias("p")
    sides = ends.select("w", pair).select("w", "p.label", "p.far").where(
        (F.col("label") != NOISE) & (F.col("far") != NOISE)
    )
    widths = sides.groupBy("label").agg(
        F.max(F.when(F.col("label") == F.col("far"), F.col("w"))).alias("inside"),
        F.min(F.when(F.col("label") != F.col("far"), F.col("w"))).alias("sep"),
    )
    sizes = labels.groupBy("label").agg(F.count("*").alias("n"))
    longest = tree.agg(F.max("w").alias("longest"))
    total = sizes.agg(F.sum("n").alias("total"))
    inside = F.coalesce("inside", F.lit(0.0))
    sep = F.coalesce("sep", 2.0 * longest.scalar())
    score = F.col("n") / total.scalar() * (sep - inside) / F.greatest(sep, inside, F.lit(1e-12))
    return sizes.join(widths, "label", "left").agg(
        F.coalesce(F.sum(F.when(F.col("label") != NOISE, score)), F.lit(0.0)).alias("validity"),
        (F.max("label") + 1).alias("topic_count"),
        (F.sum(F.when(F.col("label") != NOISE, F.col("n")).otherwise(0)) / F.sum("n")).alias("coverage"),
    )


def coverage(rows: DataFrame, label_col: str = "label") -> DataFrame:
    """One row: label count (largest label + 1) and share of rows that are not noise."""
    return rows.agg(
        (F.max(label_col) + 1).alias("topic_count"),
        F.avg((F.col(label_col) != NOISE).cast("double")).alias("coverage"),
    )
