"""Registered queries over the given tables."""

from rigwatch.plans import cycles, ingestion, monitoring, streams, synchronised  # noqa: F401
from rigwatch.plans.registry import QUERIES, SQL  # noqa: F401
