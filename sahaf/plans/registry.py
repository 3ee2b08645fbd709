"""Queries over the given tables, each with the SQL that states the same result.

A query is a function (spark, folder) -> DataFrame. The SQL runs in another engine on
the same tables and shares the fixed values (patterns, word lists), not the plans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sahaf.sources.files import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def replace_all(column: str, rules: list[tuple[str, str]]) -> str:
    """Nested global replacements in SQL; ``$1`` becomes ``\\1``."""
    for pattern, replacement in rules:
        target = replacement.replace("$", "\\")
        column = f"regexp_replace({column}, {quoted(pattern)}, {quoted(target)}, 'g')"
    return column


def java_lower_words(column: str, pattern: str) -> str:
    return (
        f"list_filter(string_split_regex(lower(regexp_replace({column}, {quoted(pattern)}, '', 'g')), '\\s+'),"
        " lambda w: w <> '')"
    )
