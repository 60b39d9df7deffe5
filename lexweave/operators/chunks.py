"""Blocks packed into retrieval chunks, within one row an element; nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textnorm import let
from .tables import row_text

MAX_CHARS = 1200
_CHUNK = "struct<chunk_id:string,block_ids:array<string>,text:string>"


def block_chunk_text(b: Column) -> Column:
    """Text of a block in a chunk; null for tables, whose rows are chunks of their own."""
    lines = F.transform(b["items"], lambda x: F.when(F.coalesce(b["ordered"], F.lit(False)), x).otherwise(F.concat(F.lit("- "), x)))
    return F.when(b["type"] == "list", F.array_join(lines, "\n")).when(b["type"] == "paragraph", b["text"])


def packed(element_id: Column, blocks: Column, max_chars: int = MAX_CHARS) -> Column:
    """Chunks of an element's blocks, by one fold.

    Texts are gathered while their lengths, separators not counted, stay within ``max_chars``; a block is never split. A
    table ends the gathering and gives one chunk for every row that says something; skipped rows count in the row number.
    Chunks of gathered text are numbered by all chunks of the element before them.
    """
    zero = F.struct(F.array().cast(f"array<{_CHUNK}>").alias("done"), F.array().cast("array<string>").alias("ids"), F.array().cast("array<string>").alias("texts"), F.lit(0).alias("size"))
    state = lambda done, ids, texts, size: F.struct(done.alias("done"), ids.alias("ids"), texts.alias("texts"), size.alias("size"))
    no_text = F.array().cast("array<string>")

    def flushed(a: Column) -> Column:
        chunk = F.struct(F.concat(element_id, F.lit("#"), (F.size(a["done"]) + 1).cast("string")).alias("chunk_id"), a["ids"].alias("block_ids"), F.array_join(a["texts"], "\n\n").alias("text"))
        return F.when(F.size(a["ids"]) > 0, F.concat(a["done"], F.array(chunk))).otherwise(a["done"])

    def step(a: Column, b: Column) -> Column:
        rows = F.transform(b["rows"], lambda r, i: F.struct(F.concat(b["id"], F.lit(".r"), (i + 1).cast("string")).alias("chunk_id"), F.array(b["id"]).alias("block_ids"), row_text(r).alias("text")))
        said = F.filter(F.coalesce(rows, F.array().cast(f"array<{_CHUNK}>")), lambda r: r["text"] != "")

        def prose(t: Column) -> Column:
            full = (F.size(a["ids"]) > 0) & (a["size"] + F.length(t) > max_chars)
            new = state(flushed(a), F.array(b["id"]), F.array(t), F.length(t))
            more = state(a["done"], F.concat(a["ids"], F.array(b["id"])), F.concat(a["texts"], F.array(t)), a["size"] + F.length(t))
            return F.when(F.coalesce(t, F.lit("")) == "", a).when(full, new).otherwise(more)

        return F.when(b["type"] == "table", state(F.concat(flushed(a), said), no_text, no_text, F.lit(0))).otherwise(let(block_chunk_text(b), prose))

    return F.aggregate(blocks, zero, step, flushed)


def chunks(elements: DataFrame, titles: DataFrame | None = None, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row a chunk with the citation fields of its element.

    The document's title is the elements' ``doc_title`` if they have one, else that of ``titles`` (doc_id, title), else null.
    Empty paths and missing chapters are null. An element without blocks has no chunks.
    """
    df = elements
    if "doc_title" not in df.columns:
        df = df.join(titles.select("doc_id", F.col("title").alias("doc_title")), "doc_id", "left") if titles is not None else df.withColumn("doc_title", F.lit(None).cast("string"))
    path = F.when(F.size("path") > 0, F.col("path"))
    df = df.select("doc_id", "doc_title", F.col("id").alias("element_id"), F.col("type").alias("element_type"), F.col("number").alias("element_number"), F.col("title").alias("element_title"), path.alias("section_path"), "chapter", F.explode(packed(F.col("id"), F.col("blocks"), max_chars)).alias("c"))
    return df.select("doc_id", "doc_title", "element_id", "element_type", "element_number", "element_title", "section_path", "chapter", "c.*")
