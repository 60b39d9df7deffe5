"""Queries of problems 3, 4 and 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.current import current_chunks, current_structure
from ..operators.texts import block_texts, chunk_texts, paragraph_texts
from . import lookalikes, markup, splitting


def _items(spark: SparkSession, d: str, paragraphs: bool = False, once: bool = False) -> DataFrame:
    """Chunks and current blocks, and paragraphs if asked for; ``once`` leaves out chunks that were delivered again."""
    current = current_structure(spark.read.parquet(f"{d}/structure.parquet"))
    chunks = spark.read.parquet(f"{d}/chunks.parquet")
    out = chunk_texts(current_chunks(chunks) if once else chunks).unionByName(block_texts(current))
    return out.unionByName(paragraph_texts(current)) if paragraphs else out


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of chunks, blocks and paragraphs longer than the limit."""
    return splitting.pieces(_items(spark, d, paragraphs=True, once=True))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Each text longer than the limit."""
    return splitting.oversized(splitting.pieces(_items(spark, d, paragraphs=True)))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of items whose texts look the same but are not the same string."""
    return lookalikes.same_look(_items(spark, d))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """The items of each look that more than one string has."""
    return lookalikes.look_classes(_items(spark, d))


def p4_forms(spark: SparkSession, d: str) -> DataFrame:
    """The consistent form of every chunk and block."""
    return lookalikes.forms(_items(spark, d, once=True))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks and blocks that hold markup."""
    return markup.converted(_items(spark, d)).select("item_kind", "item_id").distinct()


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    """Clean text of the chunks and blocks that hold markup, with the places of what is kept recognisable."""
    return markup.converted(_items(spark, d, once=True)).withColumn("marks", F.to_json("marks"))


QUERIES = {"p3_found": p3_found, "p3_pieces": p3_pieces, "p4_found": p4_found, "p4_classes": p4_classes, "p4_forms": p4_forms, "p5_found": p5_found, "p5_clean": p5_clean}
