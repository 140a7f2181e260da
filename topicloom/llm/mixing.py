"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source shuffles its documents by a seeded digest.  A document's virtual finish time is
the words its source has handed out so far, this document included, divided by the source's
target.  All documents are then served in the order of their finish times until the total
budget is spent, so that sources advance in proportion to their weights.  A source that must
give more than it has is read again in the same order, up to ``passes`` times.

Running sums are taken inside range buckets and carried across them: a source that holds a
third of all rows spreads over many tasks, and so does the global order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.text import inputs, words_of
from topicloom.workspace import global_index, keep, range_placed, running_sum

WEIGHTS = (5, 2, 1)


def word_number(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.size(words_of(text)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, passes: int = 2) -> DataFrame:
    """Targets by water filling: ``_source``, ``_source_size`` -> the same with ``_weight``, ``_target``.

    ``sources`` has one row per source.  Sources in code point order, null last, take the
    weights in turn.  The level (words per unit of weight) rises until the targets use up
    ``share`` of all words; sources above ``passes`` times their size stop there and the rest is
    shared again.  Each round is one small aggregate; only its three sums reach the driver.
    """
    ordered = global_index(sources, [F.col("_source").asc_nulls_last()], "_place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    # One row per source; kept so that each round rereads a small table.
    table = keep(
        ordered.select(
            "_source", "_source_size",
            F.get(cycle, (F.col("_place") % len(weights)).cast("int")).alias("_weight"),
            (F.col("_source_size") * float(passes)).alias("_cap"),
        ),
        "mix-sources",
    )
    level = 0.0
    budget = float(table.agg(F.sum("_source_size")).first()[0] or 0) * min(share, passes)
    while True:
        capped = F.col("_cap") <= F.col("_weight") * level
        n, full, weight = table.agg(
            F.count(F.when(capped, 1)),
            F.coalesce(F.sum(F.when(capped, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0.0)),
        ).first()
        risen = (budget - full) / weight if weight else level
        if risen <= level:
            break
        level = risen
    return table.select(
        "_source", "_source_size", "_weight", F.least("_cap", F.col("_weight") * level).alias("_target")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    passes: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """How often each row enters the mix: id, source, size, source_size, target, taken.

    ``taken`` is ``size`` times the number of passes in which the document comes before the
    budget ends.  Documents without words have size 0 and take 0.  A null source is a source
    of its own, last in order; null ids shuffle by their text.  Repeated rows are separate
    documents; equal keys have equal sizes, so reruns give equal rows.  An empty table gives
    no rows, further columns are ignored.
    """
    name = F.coalesce(F.col("_id").cast("string"), F.md5("_text"), F.lit(""))
    rows = inputs(docs, _id=id_col, _source=source_col, _text=text_col).select(
        "_id", "_source", word_number(F.col("_text")).alias("_size"),
        F.md5(F.concat(F.lit(f"{seed}-"), name)).alias("_digest"),
    )
    # The group key must not be null for joins and running sums.
    group = F.coalesce(F.concat(F.lit("s"), F.col("_source")), F.lit("null"))
    sized = keep(rows.withColumn("_group", group).withColumn("_key", F.struct("_digest", "_size")), "mix-sized")
    totals = sized.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    targets = source_targets(totals, weights, share, passes)
    taken = fair_queue(sized, targets.withColumn("_group", group).drop("_source"), share, passes)
    return taken.select(
        F.col("_id").alias(id_col), F.col("_source").alias("source"), F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"),
    )


def repeat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (see ``mix``).

    Rows without words cost nothing and stay once.  Repeated rows share what they take as
    evenly as it goes.
    """
    plan = mix(docs, id_col, text_col, source_col, **options)
    turns = F.when(F.col("size") == 0, 1).otherwise(F.col("taken") / F.col("size")).cast("long")
    plan = plan.groupBy(F.col(id_col).alias("_pi"), F.col("source").alias("_ps"), F.col("size").alias("_pz")).agg(
        F.sum(turns).alias("_t"), F.count("*").alias("_k")
    )
    sized = docs.withColumn("_size", word_number(F.col(text_col)))
    same = sized[id_col].eqNullSafe(plan["_pi"]) & sized[source_col].eqNullSafe(plan["_ps"]) & (F.col("_size") == F.col("_pz"))
    joined = sized.join(plan, same)
    each = F.floor(F.col("_t") / F.col("_k")).cast("int")
    even = joined.where("_t % _k = 0").withColumn("_n", each)
    place = F.row_number().over(Window.partitionBy("_pi", "_ps", "_pz").orderBy(text_col))
    uneven = joined.where("_t % _k != 0").withColumn("_n", each + (place <= F.col("_t") % F.col("_k")).cast("int"))
    rows = even.unionByName(uneven).where("_n > 0")
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*docs.columns)


def fair_queue(sized: DataFrame, targets: DataFrame, share: float = 1.5, passes: int = 2) -> DataFrame:
    """Serve documents by virtual finish time until the budget ends; adds the targets and ``_taken``.

    ``sized``: ``_group``, ``_key`` (place in the shuffle), ``_size`` and columns to carry along;
    ``targets``: ``_group``, ``_source_size``, ``_target``.
    """
    placed = range_placed(sized, "_group", "_key", "mix-placed")
    places = running_sum(placed, "_group", "_key", F.col("_size"), "_sum")
    queued = keep(places.join(targets, "_group"), "mix-queued")

    def order(turn: Column) -> Column:
        words = turn * F.col("_source_size") + F.col("_sum")
        finish = F.when(F.col("_target") > 0, words / F.col("_target")).otherwise(F.lit(0.0))
        return F.struct(finish.alias("finish"), "_group", "_key", turn.alias("turn"))

    turns = [F.lit(i) for i in range(passes)]
    served = queued.select(
        F.explode(F.array(*[order(t) for t in turns])).alias("_order"), "_size", F.lit(0).alias("_all")
    )
    total = running_sum(range_placed(served, "_all", "_order", "mix-served"), "_all", "_order", F.col("_size"), "_sum")
    budget = (targets.agg(F.sum("_source_size")).first()[0] or 0) * min(share, passes)
    # The last place served within the budget: one row, after which nobody is served any more.
    last = total.where(F.col("_sum") <= budget).agg(F.max("_order.finish").alias("f")).first()["f"]
    if last is None:
        return queued.withColumn("_taken", F.lit(0).cast("long"))
    edge = (
        total.where((F.col("_sum") <= budget) & (F.col("_order.finish") == last))
        .agg(F.max(F.struct("_order._group", "_order._key", "_order.turn")).alias("e"))
        .first()["e"]
    )
    cut = F.struct(
        F.lit(last).alias("finish"), F.lit(edge["_group"]).alias("_group"),
        F.struct(F.lit(edge["_key"]["_digest"]).alias("_digest"), F.lit(edge["_key"]["_size"]).cast("long").alias("_size")).alias("_key"),
        F.lit(edge["turn"]).alias("turn"),
    )
    rounds = sum((F.when(order(t) <= cut, 1).otherwise(0) for t in turns), F.lit(0))
    return queued.withColumn("_taken", F.col("_size") * rounds)
