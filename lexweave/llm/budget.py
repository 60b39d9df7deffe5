"""Token budget per source, language and domain (problem 2).

Texts are hashed; of each distinct text one row is encoded, where it stands, and its exact count is joined back to the
multiplicities of that text by source, language and domain. Only hashes and keys are shuffled: which row of a text is
encoded is found on hashes and places in files (``current_rows``), so no text moves and none is encoded twice. Copies never
meet in one task: multiplicities are summed before the join, so a text that makes up a third of all rows is one row per
slice on one side and one row on the other.

Defined results: a chunk delivered again counts once (the latest delivery's doc_id and text, by loaded_at); a chunk with
a null id counts as one row per different text; a chunk without a current sidecar has null source, language and domain;
languages are the two-letter code of their notation in ``lang_codes``, any other notation, blank or null is ``und``;
blank sources and domains are null; null and empty texts count as chunks of 0 tokens. Additional columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.current import current_chunks, current_metadata, current_rows
from ..operators.partitioning import bounded_broadcast, spread
from . import bpe


def text_key(text: Column) -> Column:
    """A 128-bit key of a text: two independent 64-bit hashes."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(17), text).alias("b"))


def token_budget(chunks: DataFrame, metadata: DataFrame, lang_codes: DataFrame, path: str) -> DataFrame:
    """(source, language, domain, n_docs, n_chunks, n_texts, n_tokens): exact token counts of chunks by slice."""
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    codes = lang_codes.groupBy(F.col("alias")).agg(F.min("code").alias("code"))
    meta = current_metadata(metadata).select("doc_id", blank(F.col("source")).alias("source"), F.trim("language").alias("alias"), blank(F.try_element_at("extra", F.lit("domain"))).alias("domain"))
    meta = meta.join(bounded_broadcast(codes, 64), "alias", "left").select("doc_id", "source", F.coalesce("code", F.lit("und")).alias("language"), "domain")

    once = current_chunks(chunks.select("chunk_id", "doc_id", "loaded_at", "text")).select("doc_id", text_key(F.col("text")).alias("k"))
    per_doc = once.groupBy("doc_id", "k").agg(F.count("*").alias("n"))
    slices = ["source", "language", "domain"]
    placed = per_doc.join(meta, "doc_id", "left").withColumn("language", F.coalesce("language", F.lit("und")))
    sliced = placed.groupBy(*slices, "k").agg(F.sum("n").alias("n"))

    key = text_key(F.col("text"))
    texts = spread(current_rows(chunks.select("text").where("text is not null"), [key["a"], key["b"]], []))
    counted = texts.select(key.alias("k"), bpe.count_tokens(F.col("text"), path).alias("tokens"))
    total = sliced.join(counted, "k", "left").groupBy(*slices)
    tokens = F.sum(F.coalesce(F.col("n") * F.col("tokens"), F.lit(0))).cast("long")
    sums = total.agg(F.sum("n").alias("n_chunks"), F.count("*").alias("n_texts"), tokens.alias("n_tokens"))
    docs = placed.groupBy(*slices, "doc_id").agg(F.lit(1)).groupBy(*slices).agg(F.count("*").alias("n_docs"))
    same = [docs[c].eqNullSafe(sums[c]) for c in slices]
    joined = sums.join(docs, same[0] & same[1] & same[2])
    return joined.select(*(sums[c] for c in slices), "n_docs", "n_chunks", "n_texts", "n_tokens")
