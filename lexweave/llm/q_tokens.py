"""Queries of problems 2 and 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, budget


def p2_budget(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of chunks by source, language and domain."""
    read = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    return budget.token_budget(read("chunks"), read("metadata"), read("lang_codes"), bpe.vocabulary())


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of every document's text."""
    return bpe.encode(spark.read.parquet(f"{d}/documents.parquet"), bpe.vocabulary())


QUERIES = {"p2_budget": p2_budget, "p6_ids": p6_ids}
