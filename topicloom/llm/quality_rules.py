"""Quality rules: a threshold table compiled into one projection of built-in expressions.

``text_metrics`` gives the raw counts of a text, ``RULES`` names ratios of them with their
bounds, and ``apply_rules`` turns the table into one select without user functions and
without a shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.text import SPACE, inputs, let, words_of

# Very frequent function words of the languages the rules know.
STOP_WORDS = (
    "the and of to in is it for on with as at by an be or that this from are was "
    "der die das und ist von mit den ein eine nicht le la les des et en que un une est pour dans "
    "el los las de por con se su"
).split()


class Rule(NamedTuple):
    """Keep a text when ``low <= metric <= high``; a bound of None is open."""

    name: str
    metric: str
    low: float | None
    high: float | None


RULES = (
    Rule("words", "n_words", 10, 10_000_000),
    Rule("word_length", "mean_word_length", 1.5, 25.0),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("dup_lines", "dup_line_ratio", None, 0.5),
    Rule("repeats", "repeat_word_ratio", None, 0.2),
)


def _repeat_words(words: Column) -> Column:
    """Words lying in a window of five words that occurs at least twice in the text."""

    def covered(hashes: Column) -> Column:
        # Positions of repeated windows: sort (hash, position), keep rows equal to a neighbour.
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(rows: Column) -> Column:
            def repeated(row: Column, k: Column) -> Column:
                same = (F.get(rows, k - 1)["h"] == row["h"]) | (F.get(rows, k + 1)["h"] == row["h"])
                return F.when(F.coalesce(same, F.lit(False)), row["i"])

            return F.array_sort(F.array_compact(F.transform(rows, repeated)))

        def total(starts: Column) -> Column:
            # Each window adds five words, fewer where the next one starts within them.
            return F.aggregate(
                F.transform(
                    starts, lambda p, k: F.least(F.lit(5), F.coalesce(F.get(starts, k + 1) - p, F.lit(5)))
                ),
                F.lit(0),
                lambda a, b: a + b,
            )

        return let(let(pairs, positions), total)

    def of_hashes(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 5),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(5)]),
        )
        # Most texts repeat nothing: the cheap distinct count decides before any sort.
        return let(
            windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > 5, let(hashes, of_hashes)).otherwise(0)


def text_metrics(text: Column) -> Column:
    """Raw counts of a text as a struct of longs; a null text counts as an empty one.

    Stop words are whole words, matched without regard to case.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))

    def counts(words: Column) -> Column:
        values = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.length(whole) - F.length(F.regexp_replace(whole, r"[#*$%&|<>]", "")),
            "n_lines": F.size(lines),
            "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))),
            "n_repeat_words": _repeat_words(words),
            "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
        }
        return F.struct(*[value.cast("long").alias(name) for name, value in values.items()])

    return let(words_of(whole), counts)


def _ratios() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_length": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        # One more than counted, so that a text of under 50 words cannot fail for having none.
        "stop_word_ratio": (F.col("n_stop_words") + 1) / n,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_word_ratio": F.col("n_repeat_words") / n,
    }


def compile_rules(rules=RULES) -> Column:
    """One boolean column: every rule of the table holds."""
    ratios = _ratios()
    verdict = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            verdict = verdict & (ratios[rule.metric] >= rule.low)
        if rule.high is not None:
            verdict = verdict & (ratios[rule.metric] <= rule.high)
    return verdict


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Metrics and verdict per row: id, the counts, ``base_failed``, ``kept``.

    A text fails the base rule with fewer than 10 words or with more than 20 words in 100
    inside repeated five-word windows.  ``kept`` needs the base rule and every row of the
    table.  Null and empty texts have zero counts and fail; a null id stays null; repeated
    rows and ids give one result row each; further columns are ignored.
    """
    rows = inputs(docs, _id=id_col, _text=text_col)
    counted = rows.select("_id", text_metrics(F.col("_text")).alias("_m")).select("_id", "_m.*")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.select(
        F.col("_id").alias(id_col),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
        failed.alias("base_failed"),
        (~failed & compile_rules(rules)).alias("kept"),
    )
