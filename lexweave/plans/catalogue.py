"""All queries of the core, by name, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import nested_queries, parser_queries, text_queries

_MODULES = [nested_queries, text_queries, parser_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLES", {}).items()}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return parser_queries.document_chunks(spark, d)
