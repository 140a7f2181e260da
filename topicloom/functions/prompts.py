"""Prompt templates and their filling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOPIC_TEMPLATE = """Name the research topic shared by the documents below.
Answer with the name alone, in ten words or fewer. Base it on the keywords and on
the sample as a whole, not on any single document.

Keywords: {keywords}
Documents:
{titles}
Topic:"""

PARENT_TEMPLATE = """Name the broader field that covers all of the subtopics below.
Answer with the name alone, in ten words or fewer.

Subtopics:
{subtopics}
Topic:"""

# The topic template after a worked example, for models that keep to a shown form.
TOPIC_EXAMPLE_TEMPLATE = """Keywords: glacier, snow, melt, basin, runoff
Documents:
- Seasonal snow storage in a high valley
- A gauge record of glacier fed streams
Topic: Snow and glacier hydrology

""" + TOPIC_TEMPLATE

RETRY_TEMPLATE = """{prompt}

This answer is too long: {response}
Give a shorter topic name and nothing else."""


def fill(template: str, **values: Column) -> Column:
    """Put columns into the ``{name}`` places of a template.

    The template is cut at its places first, so text that comes in through one
    column is never searched for the name of another.
    """
    parts: list[Column] = []
    rest = template
    while rest:
        places = [(rest.find("{" + name + "}"), name) for name in values]
        found = sorted((at, name) for at, name in places if at >= 0)
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = found[0]
        parts += [F.lit(rest[:at]), values[name]]
        rest = rest[at + len(name) + 2:]
    return F.concat(*parts)
