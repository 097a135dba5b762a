"""Operators for training-data pipelines, and their queries."""

from rigwatch.llm import queries  # noqa: F401
from rigwatch.llm.registry import QUERIES, SQL  # noqa: F401
