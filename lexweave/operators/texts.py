"""The texts of chunks, blocks and paragraphs as one table (item_kind, item_id, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_text(b: Column) -> Column:
    """Text of a block: its ``text``; of a list its items, null ones left out, one a line, led by ``- `` unless ordered; of a table null."""
    dash = F.when(F.coalesce(b["ordered"], F.lit(False)), F.lit("")).otherwise(F.lit("- "))
    lines = F.array_join(F.transform(F.filter(b["items"], lambda x: x.isNotNull()), lambda x: F.concat(dash, x)), "\n")
    return F.when(b["type"] == "list", lines).when(b["type"] == "table", F.lit(None)).otherwise(b["text"])


def chunk_texts(chunks: DataFrame) -> DataFrame:
    """(item_kind, item_id, text) of chunks; redelivered chunks are still repeated."""
    return chunks.select(F.lit("chunk").alias("item_kind"), F.col("chunk_id").alias("item_id"), "text")


def block_texts(current: DataFrame) -> DataFrame:
    """(item_kind, item_id, text) of the blocks of current records; null entries and tables are left out."""
    e = current.select(F.explode("elements").alias("e"))
    b = e.select(F.explode("e.blocks").alias("b")).where("b is not null")
    return b.select(F.lit("block").alias("item_kind"), F.col("b.id").alias("item_id"), block_text(F.col("b")).alias("text")).where("text is not null")


def paragraph_texts(current: DataFrame) -> DataFrame:
    """(item_kind, item_id, text) of the paragraphs of current records, under their node ids."""
    rec = F.concat_ws("|", "doc_id", F.col("volume").cast("string"))
    e = current.select(rec.alias("rec"), F.posexplode("elements").alias("ei", "e"))
    p = e.select("rec", "ei", F.posexplode("e.paragraphs").alias("pi", "p")).where("p.text is not null")
    node = F.concat("rec", F.lit("/e"), F.col("ei") + 1, F.lit("/p"), F.col("pi") + 1)
    return p.select(F.lit("paragraph").alias("item_kind"), node.alias("item_id"), F.col("p.text").alias("text"))
