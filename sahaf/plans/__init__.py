"""Queries that run the operators over whole tables."""

from __future__ import annotations

from sahaf.plans import cells, retrieval, sentence_ends, stemming, tables, texts, token_level  # noqa: F401  (they register queries)
from sahaf.plans.registry import QUERIES, SQL


def all_queries():
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
