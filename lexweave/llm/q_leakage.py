"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import leakage


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Every leak with the share of the item's own words and the number of places."""
    return leakage.leaks(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/eval_items.parquet"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Each document that reproduces an item."""
    return p7_leaks(spark, d).select("doc_id", "item_id").distinct()


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items with the number of documents and the greatest share."""
    return p7_leaks(spark, d).groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("share").alias("share"))


QUERIES = {"p7_found": p7_found, "p7_leaks": p7_leaks, "p7_items": p7_items}
