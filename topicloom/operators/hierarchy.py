"""Topic hierarchy: distances, Ward tree, ancestor lists, parent labels, paths.

The tree is built from rounds of mutually nearest clusters.  Ward linkage never
lets a merge bring a third cluster nearer, so merging all such pairs of a round at
once gives the same tree as one merge at a time.  The state is the table of
cluster distances, as large as the number of topics squared (not of documents).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.prompts import PARENT_TEMPLATE, fill
from topicloom.functions.sampling import shuffle_key
from topicloom.functions.text import bullets, clean_label
from topicloom.operators.labels import LabelFn, first_keywords, run_labels
from topicloom.operators.neighbours import MAX_CELLS, pair_blocks
from topicloom.operators.topics import OUTLIER
from topicloom.workspace import drop_kept, global_index, keep

_TERMS = 4096
_TOPIC_BLOCK = 1024


def topic_distances(weights: DataFrame) -> DataFrame:
    """(a, b, dist) for a < b: 1 - cosine of the term weights, without the outlier topic.

    The vocabulary is cut into slices of a few thousand terms.  A task multiplies
    one slice of two topic blocks as dense matrices, so a term that all topics use
    does not blow up a join; slice products are summed per pair.
    """
    rows = weights.where(F.col("topic") != OUTLIER)
    lengths = rows.groupBy("topic").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("len"))
    scaled = rows.join(lengths, "topic").select("topic", "term", (F.col("weight") / F.col("len")).alias("x"))
    terms = global_index(rows.select("term").distinct(), [F.col("term")], "t")
    terms = keep(terms, "vocabulary")
    per_slice = max(_TERMS, -(-terms.count() // MAX_CELLS))
    placed = scaled.join(terms, "term").select(
        F.col("topic").alias("id"),
        F.expr(f"cast(t div {per_slice} as int)").alias("cell"),
        F.struct((F.col("t") % per_slice).cast("int").alias("t"), "x").alias("e"),
    )
    # A zero entry for every topic in the first slice: so every pair has a product.
    blank = F.struct(F.lit(0).alias("t"), F.lit(0.0).alias("x"))
    everyone = lengths.select(F.col("topic").alias("id"), F.lit(0).alias("cell"), blank.alias("e"))
    placed = placed.unionByName(everyone)
    packed = placed.groupBy("id", "cell").agg(F.collect_list("e").alias("l")).select(
        "id", "cell", F.col("l.t").alias("ts"), F.col("l.x").alias("xs")
    )
    packed = keep(packed, "topic-slices")

    def dense(side: pa.Table) -> np.ndarray:
        ts, xs = side["ts"].combine_chunks(), side["xs"].combine_chunks()
        out = np.zeros((side.num_rows, per_slice))
        row = np.repeat(np.arange(side.num_rows), np.diff(ts.offsets.to_numpy()))
        np.add.at(out, (row, ts.flatten().to_numpy()), xs.flatten().to_numpy())
        return out

    def products(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        gram = dense(left) @ dense(right).T
        r, c = np.nonzero(a[:, None] < b[None, :])
        return pa.table(
            {"a": a[r].astype(np.int32), "b": b[c].astype(np.int32), "dot": gram[r, c]}
        )

    schema = T.StructType(
        [
            T.StructField("a", T.IntegerType()),
            T.StructField("b", T.IntegerType()),
            T.StructField("dot", T.DoubleType()),
        ]
    )
    dots = pair_blocks(packed, packed, products, schema, _TOPIC_BLOCK)
    return dots.groupBy("a", "b").agg((1.0 - F.sum("dot")).alias("dist"))


def ward_merges(distances: DataFrame) -> DataFrame:
    """(parent, left, right, dist): the Ward tree over (a, b, dist) with leaf ids a, b.

    Parents are numbered from the largest leaf id + 1 by rising distance; the
    smaller child id is on the left.
    """
    # A cluster is known by its smallest leaf; na and nb are cluster sizes.
    one = F.lit(1)
    pairs = distances.select("a", "b", (F.col("dist") * F.col("dist")).alias("d2"), one.alias("na"), one.alias("nb"))
    state = keep(_mirrored(pairs), "ward")
    last_leaf = state.agg(F.max("a")).first()[0]
    rounds: list[DataFrame] = []
    while not state.isEmpty():
        pair = F.struct("d2", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        nearest = state.groupBy("a").agg(F.min(pair).alias("m"), F.first("na").alias("n"))
        mutual = (
            nearest.groupBy("m")
            .agg(F.count("*").alias("c"), F.sum("n").alias("n"),
                 F.max(F.when(F.col("a") == F.col("m.lo"), F.col("n"))).alias("n_lo"),
                 F.max(F.when(F.col("a") == F.col("m.hi"), F.col("n"))).alias("n_hi"))
            .where(F.col("c") == 2)
            .select("m.lo", "m.hi", "m.d2", "n", "n_lo", "n_hi")
        )
        merges = keep(mutual, "ward-merges")
        rounds.append(merges)
        if merges.isEmpty():
            raise RuntimeError("no mutually nearest pair: distances are not numbers")
        merged = _merge_side(_merge_side(state, merges, "a", "b"), merges, "b", "a")
        # The two directions of a pair may round differently; one of them counts.
        following = keep(_mirrored(merged.where(F.col("a") < F.col("b"))), "ward")
        drop_kept(state)
        state = following
    if not rounds:
        return distances.sparkSession.createDataFrame([], "parent int, left int, right int, dist double")
    merges = rounds[0]
    for part in rounds[1:]:
        merges = merges.unionByName(part)
    numbered = keep(global_index(merges, [F.col("d2"), F.col("lo"), F.col("hi")], "k"), "ward-numbered")
    numbered = numbered.withColumn("parent", (F.col("k") + last_leaf + 1).cast("int"))
    # A child of size one is its leaf; a larger one is the merge that gave it its size.
    made = numbered.select(F.col("lo").alias("rep"), F.col("n").alias("size"), F.col("parent").alias("id"))

    def child(rows: DataFrame, rep: str, size: str, out: str) -> DataFrame:
        named = made.select(F.col("rep").alias(rep), F.col("size").alias(size), F.col("id").alias("_id"))
        return rows.join(named, [rep, size], "left").withColumn(out, F.coalesce("_id", rep)).drop("_id")

    rows = child(child(numbered, "lo", "n_lo", "c1"), "hi", "n_hi", "c2")
    return rows.select(
        "parent",
        F.least("c1", "c2").alias("left"),
        F.greatest("c1", "c2").alias("right"),
        F.sqrt("d2").alias("dist"),
    )


def _mirrored(pairs: DataFrame) -> DataFrame:
    swapped = F.struct(
        F.col("b").alias("a"), F.col("a").alias("b"), "d2", F.col("nb").alias("na"), F.col("na").alias("nb")
    )
    both = F.array(F.struct("a", "b", "d2", "na", "nb"), swapped)
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def _merge_side(state: DataFrame, merges: DataFrame, side: str, far: str) -> DataFrame:
    """Lance-Williams update of one side of the distance table, on squared distances."""
    member = F.explode(
        F.array(F.struct(F.col("lo").alias("x"), F.col("n_lo").alias("nx")),
                F.struct(F.col("hi").alias("x"), F.col("n_hi").alias("nx")))
    ).alias("e")
    into = merges.select(member, "lo", F.col("n").alias("_n"), F.col("d2").alias("_d2")).select(
        F.col("e.x").alias(side), F.col("lo").alias("_to"), "_n", "_d2"
    )
    size, far_size = f"n{side}", f"n{far}"
    moved = state.join(into, side, "left").withColumn("_to", F.coalesce("_to", side)).where(
        F.col("_to") != F.col(far)
    )
    if side == "a":
        # Drop the other row inside the merged pair (its far end is the larger leaf).
        inner = merges.select(F.col("lo").alias("_to"), F.col("hi").alias(far))
        moved = moved.join(inner, ["_to", far], "left_anti")
    total = F.max(F.coalesce("_n", size))
    weighted = F.sum((F.col(size) + F.col(far_size)) * F.col("d2"))
    merged = (weighted - F.max(far_size) * F.max("_d2")) / (total + F.max(far_size))
    return moved.groupBy("_to", far).agg(
        F.when(F.max("_n").isNull(), F.max("d2")).otherwise(merged).alias("d2"),
        total.alias(size),
        F.max(far_size).alias(far_size),
    ).select(F.col("_to").alias(side), far, "d2", size, far_size).select("a", "b", "d2", "na", "nb")


def hierarchy_table(merges: DataFrame, names: DataFrame) -> DataFrame:
    """Hierarchy rows with string ids, leaf lists and the names known so far.

    ``names``: (topic_id string, name).  Leaf lists come from doubling the ancestor
    relation, so the number of joins is the log of the tree height.
    """
    links = merges.select(F.explode(F.array("left", "right")).alias("node"), F.col("parent").alias("up"))
    reach = keep(links.select("node", "up", F.lit(1).alias("step")), "ancestors")
    width = 1
    while True:
        far = reach.where(F.col("step") <= width)
        longer = (
            reach.where(F.col("step") == width)
            .join(far.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("step").alias("_s")), "up")
            .select("node", F.col("_up").alias("up"), (F.col("step") + F.col("_s")).alias("step"))
        )
        longer = keep(longer, "ancestors-more")
        if longer.isEmpty():
            break
        reach = keep(reach.unionByName(longer), "ancestors")
        width *= 2
    leaves = reach.join(merges.select(F.col("parent").alias("node")), "node", "left_anti")
    lists = leaves.groupBy(F.col("up").alias("parent")).agg(F.array_sort(F.collect_list("node")).alias("Topics"))
    rows = merges.join(lists, "parent").select(
        F.col("parent").cast("string").alias("Parent_ID"),
        F.lit(None).cast("string").alias("Parent_Name"),
        "Topics",
        F.col("left").cast("string").alias("Child_Left_ID"),
        F.col("right").cast("string").alias("Child_Right_ID"),
        F.col("dist").alias("Distance"),
    )
    return attach_names(rows, names)


def attach_names(hierarchy: DataFrame, names: DataFrame) -> DataFrame:
    """Fill the child names; the parents' own names join the map first, so inner nodes resolve."""
    known = extend_names(names, hierarchy.select(
        F.col("Parent_ID").alias("topic_id"), F.col("Parent_Name").alias("name")
    ))
    rows = hierarchy.drop("Child_Left_Name", "Child_Right_Name")
    for side in ("Left", "Right"):
        named = known.select(
            F.col("topic_id").alias(f"Child_{side}_ID"), F.col("name").alias(f"Child_{side}_Name")
        )
        rows = rows.join(named, f"Child_{side}_ID", "left")
    return rows.select(
        "Parent_ID", "Parent_Name", "Topics", "Child_Left_ID", "Child_Left_Name",
        "Child_Right_ID", "Child_Right_Name", "Distance",
    )


def extend_names(names: DataFrame, added: DataFrame) -> DataFrame:
    """Name map with the added entries; an added key replaces an existing one."""
    return names.join(added.select("topic_id"), "topic_id", "left_anti").unionByName(added)


def parent_prompts(
    hierarchy: DataFrame,
    names: DataFrame,
    max_topics: int = 100,
    seed: int = 123,
    template: str = PARENT_TEMPLATE,
) -> DataFrame:
    """(Parent_ID, prompt) listing up to ``max_topics`` subtopic names of each node.

    ``template`` has the place ``{subtopics}``.  A node none of whose topics has a name keeps
    an empty list.
    """
    parts = hierarchy.select("Parent_ID", F.explode("Topics").alias("topic")).withColumn(
        "topic_id", F.col("topic").cast("string")
    )
    order = Window.partitionBy("Parent_ID").orderBy("_key", "topic")
    picked = (
        parts.withColumn("_key", shuffle_key(seed, F.col("Parent_ID"), F.col("topic")))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= max_topics)
    )
    named = picked.join(names, "topic_id", "left")
    listed = F.sort_array(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("topic", "name"))))
    return named.groupBy("Parent_ID").agg(listed["name"].alias("names")).select(
        "Parent_ID", fill(template, subtopics=bullets(F.col("names"))).alias("prompt")
    )


def label_parents(
    hierarchy: DataFrame, names: DataFrame, label_fn: LabelFn = first_keywords, max_topics: int = 100,
    template: str = PARENT_TEMPLATE, **options
) -> DataFrame:
    """Hierarchy with labelled parents and resolved child names."""
    answers = run_labels(parent_prompts(hierarchy, names, max_topics, template=template), label_fn, **options)
    labels = answers.select("Parent_ID", clean_label(F.col("answer")).alias("Parent_Name"))
    return attach_names(hierarchy.drop("Parent_Name").join(labels, "Parent_ID"), names)


def ancestors(hierarchy: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(topic string, parents): names of the ancestors at or above ``threshold``, nearest first."""
    parts = hierarchy.where(F.col("Distance") >= threshold).select(
        F.explode("Topics").alias("topic"), "Distance", "Parent_ID", "Parent_Name"
    ).withColumn("topic", F.col("topic").cast("string"))
    listed = F.sort_array(F.collect_list(F.struct("Distance", "Parent_ID", "Parent_Name")))
    return parts.groupBy("topic").agg(listed["Parent_Name"].alias("parents"))


def with_parents(info: DataFrame, hierarchy: DataFrame, threshold: float = 0.5, levels: int = 3) -> DataFrame:
    """Topic table with ``parent``, ``parent_parent``, ...; topics without a parent vanish."""
    parents = ancestors(hierarchy, threshold)
    joined = info.withColumn("Topic", F.col("Topic").cast("string")).join(
        parents.withColumnRenamed("topic", "_t"), F.col("Topic") == F.col("_t")
    )
    named = [
        F.get("parents", F.lit(i)).alias("parent" + "_parent" * i) for i in range(levels)
    ]
    return joined.select(*info.columns, *named)


def topic_paths(hierarchy: DataFrame) -> DataFrame:
    """(topic, depth, path): the parents of each topic from the root down."""
    parts = hierarchy.select(F.explode("Topics").alias("topic"), F.size("Topics").alias("n"), "Parent_ID", "Parent_Name")
    order = F.sort_array(F.collect_list(F.struct("n", "Parent_ID", "Parent_Name")), asc=False)
    return parts.groupBy("topic").agg(order.alias("l")).select(
        "topic", F.size("l").alias("depth"), F.array_join(F.col("l.Parent_Name"), " > ").alias("path")
    )


def build_hierarchy(weights: DataFrame, names: DataFrame) -> DataFrame:
    """Hierarchy over the topics of a term-weight table."""
    return hierarchy_table(keep(ward_merges(topic_distances(weights)), "ward-tree"), names)
