"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from sahaf.llm import queries
from sahaf.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "queries"]
