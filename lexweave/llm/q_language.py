"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language


def _by_document(spark: SparkSession, d: str) -> DataFrame:
    documents, codes = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "lang_codes"))
    return language.document_languages(language.languages(documents, language.train(documents, codes)), codes)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages of documents whose label is missing or wrong, or that mix languages."""
    return language.relabelled(_by_document(spark, d))


def p8_languages(spark: SparkSession, d: str) -> DataFrame:
    """The languages of every document, its main one first, with the number of whole sentences and a confidence."""
    langs = F.when(F.size("langs") > 0, F.col("langs")).otherwise(F.array("main"))
    return _by_document(spark, d).select("doc_id", "label", F.explode_outer(langs).alias("l")).select("doc_id", "label", "l.*")


def p8_passages(spark: SparkSession, d: str) -> DataFrame:
    """Every passage of one language, with its place and confidence."""
    documents, codes = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "lang_codes"))
    found = language.languages(documents, language.train(documents, codes))
    return found.select("doc_id", F.posexplode("passages").alias("passage", "p")).select("doc_id", "passage", "p.*")


QUERIES = {"p8_found": p8_found, "p8_languages": p8_languages, "p8_passages": p8_passages}
