"""Topic labels: sampled titles, prompts, a label function, clean-up, majority."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.prompts import RETRY_TEMPLATE, TOPIC_TEMPLATE, fill
from topicloom.functions.sampling import shuffle_key
from topicloom.functions.text import bullets, clean_label

LabelFn = Callable[[pd.Series], pd.Series]


def attach_topics(titles: DataFrame, doc_topics: DataFrame, id_col: str = "id") -> DataFrame:
    return titles.join(doc_topics.select(id_col, "topic"), id_col)


def sample_titles(titled: DataFrame, n: int = 30, seed: int = 123, id_col: str = "id") -> DataFrame:
    """(topic, titles_sample): up to ``n`` titles per topic in hash order.

    The rank limit is applied before the shuffle too, so a hot topic sends at most
    ``n`` rows per task.
    """
    order = Window.partitionBy("topic").orderBy("_key", id_col)
    picked = (
        titled.withColumn("_key", shuffle_key(seed, F.col(id_col)))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= n)
    )
    listed = F.sort_array(F.collect_list(F.struct("_rank", "title")))
    return picked.groupBy("topic").agg(listed["title"].alias("titles_sample"))


def topic_prompts(info: DataFrame, samples: DataFrame, template: str = TOPIC_TEMPLATE) -> DataFrame:
    """Topic table with sampled titles and the filled prompt.

    ``template`` has the places ``{keywords}`` and ``{titles}``.  A topic without titled
    documents has an empty sample.
    """
    sample = F.coalesce("titles_sample", F.array().cast("array<string>"))
    return info.join(samples, "topic", "left").withColumn("titles_sample", sample).withColumn(
        "prompt",
        fill(
            template,
            keywords=F.array_join("representation", ", "),
            titles=bullets(F.col("titles_sample"), 200),
        ),
    )


def first_keywords(prompts: pd.Series) -> pd.Series:
    """Default label function: the first three keywords, else the first listed items."""
    keywords = prompts.str.extract(r"Keywords: ([^\n]*)", expand=False)
    items = prompts.str.findall(r"(?m)^- (.*)$").str[:2].str.join(" and ")
    return keywords.str.split(", ").str[:3].str.join(" ").fillna(items).fillna("")


def run_labels(
    prompts: DataFrame,
    label_fn: LabelFn = first_keywords,
    max_retries: int = 3,
    threshold: int = 10,
    output_col: str = "answer",
) -> DataFrame:
    """Ask ``label_fn`` for each prompt; too long an answer is asked again up to
    ``max_retries`` times, quoting it."""

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompt in batches:
            answer = label_fn(prompt)
            for _ in range(max_retries):
                long = answer.str.count(" ") + 1 > threshold
                if not long.any():
                    break
                again = [
                    RETRY_TEMPLATE.replace("{prompt}", p).replace("{response}", a)
                    for p, a in zip(prompt[long], answer[long])
                ]
                answer[long] = label_fn(pd.Series(again)).to_numpy()
            yield answer.str.strip()

    return prompts.withColumn(output_col, ask("prompt"))


def label_topics(
    info: DataFrame,
    titled: DataFrame,
    label_fn: LabelFn = first_keywords,
    n_titles: int = 30,
    random_state: int = 123,
    template: str = TOPIC_TEMPLATE,
    **options,
) -> DataFrame:
    """Topic table with ``titles_sample`` and the cleaned label ``llm_topic``."""
    prompts = topic_prompts(info, sample_titles(titled, n_titles, random_state), template)
    if label_fn is first_keywords:
        # The default needs no model: its keywords come from the representation, not the prompt,
        # so any template works and no Python worker runs.
        keywords = F.slice(F.coalesce("representation", F.array().cast("array<string>")), 1, 3)
        answered = prompts.withColumn("answer", F.trim(F.array_join(keywords, " ")))
    else:
        answered = run_labels(prompts, label_fn, **options)
    return answered.withColumn("llm_topic", clean_label(F.col("answer"))).select(
        *info.columns, "titles_sample", "llm_topic"
    )


def majority_label(rounds: DataFrame) -> DataFrame:
    """(topic, label) from several rounds: the most frequent, a tie to the smallest."""
    votes = rounds.groupBy("topic", "label").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("label").alias("label")))
    return votes.groupBy("topic").agg(best["label"].alias("label"))
