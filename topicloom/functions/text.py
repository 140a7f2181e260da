"""Text column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split() and str.strip() treat as white space.
_SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(text, f"^[{_SPACE}]+|[{_SPACE}]+$", "")


def word_count(text: Column) -> Column:
    """Number of white-space separated words; null stays null."""
    return F.size(F.array_remove(F.split(text, f"[{_SPACE}]+", -1), ""))


def truncate(text: Column, limit: int) -> Column:
    """First ``limit`` characters and ``...`` where the text is longer."""
    cut = F.concat(F.substring(text, 1, limit), F.lit("..."))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def bullets(texts: Column, limit: int | None = None) -> Column:
    """Array of strings -> one ``- item`` line each, long items truncated."""
    def line(item: Column) -> Column:
        return F.concat(F.lit("- "), truncate(item, limit) if limit else item)

    return F.array_join(F.transform(texts, line), "\n")


def display_label(label: Column, count: Column, limit: int = 100) -> Column:
    """``label (12,345)`` with the label truncated."""
    return F.concat(truncate(label, limit), F.lit(" ("), F.format_number(count, 0), F.lit(")"))


def too_long(label: Column, threshold: int = 10) -> Column:
    """More than ``threshold`` pieces between single spaces."""
    return F.size(F.split(label, " ", -1)) > threshold


def clean_label(label: Column) -> Column:
    """Reduce a generated answer to the bare label.

    In order: the part after the last instruction mark, the second ``:`` piece if
    there is one, no double quotes, first line only; stripped at every step.
    """
    answer = strip(F.element_at(F.split(label, r"\[/INST\]\n", -1), -1))
    body = F.when(answer.contains(":"), strip(F.get(F.split(answer, ":", -1), F.lit(1))))
    unquoted = strip(F.replace(F.coalesce(body, answer), F.lit('"'), F.lit("")))
    return strip(F.get(F.split(unquoted, "\n", -1), F.lit(0)))


def leading_bytes(text: Column, limit: int) -> Column:
    """The longest character prefix that fits into ``limit`` UTF-8 bytes.

    The first ``limit`` bytes are decoded; if the next byte continues a character, that
    character was cut and its replacement mark at the end is not counted.  A genuine
    U+FFFD of the text stays.
    """
    data = F.encode(text, "UTF-8")
    decoded = F.length(F.make_valid_utf8(F.substring(data, 1, limit).cast("string")))
    following = F.conv(F.hex(F.substring(data, limit + 1, 1)), 16, 10).cast("int")
    cut = F.coalesce((F.shiftright(following, 6) == 2).cast("int"), F.lit(0))  # 10xxxxxx
    return F.when(F.octet_length(text) <= limit, text).otherwise(text.substr(F.lit(1), decoded - cut))


def tokens(text: Column) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
