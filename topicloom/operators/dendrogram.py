"""Merge tree of a spanning tree, built by contraction instead of one sorted scan.

Edges are numbered by weight (``e`` = position in the order w, lo, hi).  Adding them
in that order merges components; edge ``e`` is the tree node of its merge.

Level by level, each vertex picks its lightest incident edge and the picked edges
are contracted; edges nobody picked stay for the next level, so there are at most
log2(n) levels.  An edge belongs to the *chain* of the first lighter-than-outside
component that holds it: go up the levels until the component's lightest remaining
edge is heavier than ``e``; that edge and its side name the chain.  Along a chain,
in edge order, each edge is the parent of the one before, and the chain as a whole
hangs under the edge that names it.  Sizes are then running sums along chains.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.operators.spanning import contract, relabel
from topicloom.workspace import drop_kept, global_index, keep, keep_all, range_placed, running_sum

ROOT_CHAIN = -1


@dataclass
class MergeTree:
    """``merges``: e, w, chain, size, prev (size before this merge), leaves, hang0, hang1;
    ``leaf``: (v, e), the first merge of each point; ``n``: the number of points."""

    merges: DataFrame
    leaf: DataFrame
    n: int


def _ends(edges: DataFrame) -> DataFrame:
    """Both directions of (e, a, b): (v, other, e, side)."""
    pair = F.explode(
        F.array(
            F.struct(F.col("a").alias("v"), F.col("b").alias("other"), F.lit(0).alias("side")),
            F.struct(F.col("b").alias("v"), F.col("a").alias("other"), F.lit(1).alias("side")),
        )
    )
    return edges.select("e", pair.alias("x")).select("x.v", "x.other", "e", "x.side")


def _contract_levels(numbered: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(e, chain, level) of every edge, (v, e) of every point, and the level count."""
    edges = keep(numbered.select("e", F.col("lo").alias("a"), F.col("hi").alias("b")), "level")
    waiting = None
    placed: list[DataFrame] = []
    leaf = None
    level = 0
    while True:
        picks = (
            _ends(edges)
            .groupBy("v")
            .agg(F.min(F.struct("e", "other", "side")).alias("m"))
            .select("v", "m.e", "m.other", "m.side")
        )
        picked, labels = contract(picks)
        if level == 0:
            leaf = picked.select("v", "e")
        still = None
        if waiting is not None:
            named = picked.select(F.col("v").alias("s"), F.col("e").alias("_a"), "side")
            tried = waiting.join(named, "s")
            chained = F.col("_a") > F.col("e")
            placed.append(
                tried.where(chained).select(
                    "e", (F.col("_a") * 2 + F.col("side")).alias("chain"), "level"
                )
            )
            still = tried.where(~chained).select("e", "s", "level")
        used = picked.select("e").distinct()
        fresh = edges.join(used, "e").select("e", F.col("a").alias("s"), F.lit(level).alias("level"))
        up = relabel(fresh if still is None else fresh.unionByName(still), labels, "s")
        rest = edges.join(used, "e", "left_anti")
        rest = relabel(relabel(rest, labels, "a"), labels, "b").select("e", "a", "b")
        waiting, following = keep_all(waiting=up.select("e", "s", "level"), level=rest)
        drop_kept(edges, labels)
        edges = following
        level += 1
        if edges.isEmpty():
            break
    placed.append(waiting.select("e", F.lit(ROOT_CHAIN).cast("long").alias("chain"), "level"))
    chains = placed[0]
    for part in placed[1:]:
        chains = chains.unionByName(part)
    return keep(chains, "chains"), leaf, level


def merge_tree(tree: DataFrame) -> MergeTree:
    """Merge tree of a spanning tree (lo, hi, w) that connects all its points."""
    numbered = keep(
        global_index(tree, [F.col("w"), F.col("lo"), F.col("hi")], "e"), "numbered"
    )
    chains, leaf, levels = _contract_levels(numbered)
    leaves = leaf.groupBy("e").agg(F.count("*").alias("leaves"))
    rows = keep(
        chains.join(numbered.select("e", "w"), "e")
        .join(leaves, "e", "left")
        .withColumn("leaves", F.coalesce("leaves", F.lit(0))),
        "merges",
    )

    # What hangs under an edge: its leaves, and the chains it names.  A chain holds
    # only edges of lower levels than its naming edge, so levels go bottom-up.
    done = rows.where(F.col("level") == 0).select(
        "*", F.lit(0).cast("long").alias("hang0"), F.lit(0).cast("long").alias("hang1")
    )
    for level in range(1, levels):
        here = rows.where(F.col("level") == level)
        weight = F.col("leaves") + F.col("hang0") + F.col("hang1")
        totals = (
            done.withColumn("_e", F.expr("chain div 2"))
            .join(here.select(F.col("e").alias("_e")), "_e", "left_semi")
            .groupBy("_e")
            .agg(
                F.sum(F.when(F.col("chain") % 2 == 0, weight)).alias("hang0"),
                F.sum(F.when(F.col("chain") % 2 == 1, weight)).alias("hang1"),
            )
        )
        zero = F.lit(0).cast("long")
        ready = here.join(totals.withColumnRenamed("_e", "e"), "e", "left").select(
            *rows.columns,
            F.coalesce("hang0", zero).alias("hang0"),
            F.coalesce("hang1", zero).alias("hang1"),
        )
        done = keep(done.unionByName(ready), "hanging")

    placed = range_placed(done, "chain", "e", "placed-merges")
    weight = F.col("leaves") + F.col("hang0") + F.col("hang1")
    sized = running_sum(placed, "chain", "e", weight, "size").withColumn(
        "prev", F.col("size") - weight
    )
    merges = keep(sized.drop("level"), "merge-tree")
    return MergeTree(merges, leaf, merges.count() + 1)


def merge_sizes(tree: MergeTree) -> DataFrame:
    """(e, w, small, large): sizes of the two components each edge joins."""
    first, second = merge_sides()
    return tree.merges.select(
        "e", "w", F.least(first, second).alias("small"), F.greatest(first, second).alias("large")
    )


def merge_sides():
    """Sizes of the two sides of a merge.

    Not first in its chain: the chain so far, and the one thing that hangs here.
    First in its chain: the two things that hang here (leaves count one each).
    """
    hang = F.col("leaves") + F.col("hang0") + F.col("hang1")
    first_in_chain = F.col("prev") == 0
    chain0, chain1 = F.col("hang0"), F.col("hang1")
    one = F.when(F.col("leaves") > 0, F.lit(1)).otherwise(chain0)
    return (
        F.when(first_in_chain, one).otherwise(F.col("prev")),
        F.when(first_in_chain, hang - one).otherwise(hang),
    )
