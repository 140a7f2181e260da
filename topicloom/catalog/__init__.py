"""Registered queries and their SQL counterparts on the given tables."""

from topicloom.catalog import clusters, documents, hierarchy, neighbours, sinks, topics  # noqa: F401
from topicloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
