"""The stages in a row: cleaned documents, elements, blocks, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textnorm import clean_markdown
from . import generic, legal
from .chunks import MAX_CHARS, chunks
from .metadata import routed, with_metadata
from .tables import BLOCK

_COMMON = ("doc_id", "seq", "id", "type", "number", "level", "title", "path", "chapter", "parsed", "blocks")
_CHAPTER = "struct<number:string,title:string>"
_PART = f"array<struct<seq:int,type:string,number:string,chapter:{_CHAPTER},lines:array<string>,level:int,title:string,path:array<string>,blocks:array<{BLOCK}>>>"


def cleaned(docs: DataFrame) -> DataFrame:
    """Documents with cleaned text; additional columns are kept.

    The text is generated, not projected, so that a filter on what follows from it does not clean it once more.
    """
    once = F.explode(F.array(clean_markdown(F.col("text")))).alias("text")
    return docs.select(*(once if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def with_sidecars(docs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Documents with what their current sidecars say of them: title, source type, declared structure type, and whether there is none.

    A document without a sidecar has its doc_id as title, and its article lines decide how it is parsed.
    """
    df = with_metadata(docs, metadata)
    explicit = F.try_element_at("extra", F.lit("structure_type"))
    return df.select(*(f"`{c}`" for c in docs.columns), F.col("title").alias("doc_title"), "source_type", explicit.alias("explicit"), "placeholder")


def elements(docs: DataFrame, tree: bool = True) -> DataFrame:
    """Elements of cleaned documents, each document by the parser that fits it; ``doc_title`` is kept if there is one.

    Without ``tree`` the column ``parsed`` is null.

    One pass: a document is cut up by its own parser, its parts are generated once, and each is parsed where it stands.
    """
    df = routed(docs)
    law = F.col("structure_type") == "legal"
    kept = [c for c in ("doc_title",) if c in docs.columns]
    df = df.select("doc_id", *kept, F.when(law, legal.cleaned_lines(F.col("text"))).alias("lines"), F.when(~law, generic.heads()).alias("heads"))
    df = generic.with_sections(legal.with_parts(df))
    no = lambda *ks: [F.lit(None)] * len(ks)
    from_law = F.transform("parts", lambda p, i: F.struct(i + 1, p["type"], p["number"], p["chapter"], p["lines"], *no("level", "title", "path", "blocks"))).cast(_PART)
    from_rest = F.transform("sections", lambda x, i: F.struct(i + 1, F.lit("section"), *no("number", "chapter", "lines"), x["level"], x["title"], x["path"], x["blocks"])).cast(_PART)
    parts = df.select("doc_id", *kept, F.explode(F.coalesce(from_law, from_rest)).alias("p")).select("doc_id", *kept, "p.*")
    return legal.parsed_parts(parts, tree=tree).select(*_COMMON, *kept)


def document_chunks(docs: DataFrame, metadata: DataFrame | None = None, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunks of raw documents (doc_id string, text); with current sidecars, by their declared types and with their titles."""
    return chunks(elements(cleaned(docs if metadata is None else with_sidecars(docs, metadata)), tree=False), max_chars=max_chars)


def document_totals(elements_df: DataFrame) -> DataFrame:
    """(doc_id, elements, blocks): how many elements and blocks each document has."""
    return elements_df.groupBy("doc_id").agg(F.count("*").alias("elements"), F.sum(F.size("blocks")).cast("bigint").alias("blocks"))


def blocks(elements_df: DataFrame) -> DataFrame:
    """(doc_id, element_id, block_no, block fields) of elements."""
    b = elements_df.select("doc_id", F.col("id").alias("element_id"), F.posexplode("blocks").alias("block_no", "b"))
    return b.select("doc_id", "element_id", (F.col("block_no") + 1).alias("block_no"), "b.*")
