"""Files in and out: whole texts, sidecars, structures and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metadata import parse_sidecar, sidecar_json
from ..operators.legal import PARSED
from ..operators.tables import BLOCK

SIDECAR = ".meta.json"
_TREE = ("intro", "text", "references", "paragraphs", "items", "sections", "closing")
STRUCTURE = (
    "instrument struct<celex:string,eli:string,title:string,language:string,publication_date:string>, structure_type string, elements array<struct<"
    f"id:string,type:string,number:string,level:int,title:string,path:array<string>,chapter:struct<number:string,title:string>,{PARSED[len('struct<') : -1]},blocks:array<{BLOCK}>>>"
)


def _stem(column: str = "path"):
    return F.regexp_replace(F.regexp_extract(column, r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", "")


def _path():
    """The file of a row as it is written; Spark gives it as an address."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def read_binary(spark: SparkSession, directory: str) -> DataFrame:
    """(stem, path, content) of all files but sidecars."""
    df = spark.read.format("binaryFile").load(directory).where(~F.col("path").endswith(SIDECAR))
    return df.select(_stem().alias("stem"), "path", "content")


def read_documents(spark: SparkSession, pattern: str) -> DataFrame:
    """(doc_id, text) of text files, a row a file; the doc_id is the stem."""
    df = spark.read.text(pattern, wholetext=True).select(_path().alias("path"), F.col("value").alias("text"))
    return df.select(_stem().alias("doc_id"), "text")


def read_sidecars(spark: SparkSession, pattern: str) -> DataFrame:
    """Parsed sidecars, by stem."""
    df = spark.read.text(pattern, wholetext=True).select(_path().alias("path"), F.col("value").alias("json"))
    return parse_sidecar(df.select(F.regexp_replace(F.regexp_extract("path", r"([^/]*)\z", 1), r"\.meta\.json\z", "").alias("stem"), "json"))


def read_structures(spark: SparkSession, pattern: str) -> DataFrame:
    """Structure files, by their declared schema; nothing is inferred."""
    return spark.read.schema(STRUCTURE).json(pattern, multiLine=True)


def write_cleaned(docs: DataFrame, path: str) -> None:
    """Cleaned documents as Parquet, replaced as a whole."""
    docs.write.mode("overwrite").parquet(path)


def write_structures(elements: DataFrame, instruments: DataFrame, path: str) -> None:
    """A JSON object a document: instrument, structure type, elements in their order with their whole trees; nulls are left out."""
    legal = F.max(F.col("type").isin("article", "annex"))
    tree = [F.col(f"parsed.{c}").alias(c) for c in _TREE] if "parsed" in elements.columns else []
    own = F.struct("seq", *("id", "type", "number", "level", "title", "path", "chapter"), *tree, "blocks")
    grouped = elements.groupBy("doc_id").agg(F.array_sort(F.collect_list(own), lambda x, y: x["seq"] - y["seq"]).alias("elements"), F.when(legal, "legal").otherwise("generic").alias("structure_type"))
    joined = grouped.join(instruments, "doc_id", "left").select("doc_id", "instrument", "structure_type", F.transform("elements", lambda x: x.dropFields("seq")).alias("elements"))
    joined.write.mode("overwrite").json(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """A JSON object a chunk and line; empty paths and missing chapters are left out."""
    chunks.write.mode("overwrite").json(path)


def write_sidecars(meta: DataFrame, path: str) -> None:
    """A JSON object a document, additional fields on the level of the others."""
    sidecar_json(meta).select(F.col("json").alias("value")).write.mode("overwrite").text(path)


def write_converted(converted: DataFrame, path: str) -> None:
    """What a provider made: ``documents`` (doc_id, text with page banners), ``layout`` and ``links``, each replaced as a whole."""
    from .providers import flat_links, paged_text

    named = converted.withColumn("doc_id", _stem())
    whole = f"{path.rstrip('/')}/converted"
    named.write.mode("overwrite").parquet(whole)  # a provider is run once
    kept = named.sparkSession.read.schema(named.schema).parquet(whole)
    kept.where("pages is not null").select("doc_id", paged_text(F.col("pages")).alias("text")).write.mode("overwrite").parquet(f"{path.rstrip('/')}/documents")
    kept.where("layout is not null").select("doc_id", "layout").write.mode("overwrite").parquet(f"{path.rstrip('/')}/layout")
    flat_links(kept).write.mode("overwrite").json(f"{path.rstrip('/')}/links")
