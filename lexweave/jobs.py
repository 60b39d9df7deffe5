"""Batch jobs for spark-submit: convert, clean, structure (by what fits, or only legal or generic), chunk.

A job takes documents as Parquet (doc_id, text) or as text files, all of them or those of the named stems, and their
sidecars if a folder of these is given; documents without one are counted and said.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import chunks, generic, legal, metadata, pipeline
from .sources import files, providers


def documents(spark: SparkSession, path: str, kind: str, stems: list[str]) -> DataFrame:
    """(doc_id, text) of the input, of the named documents if any are named."""
    docs = spark.read.parquet(path).withColumn("doc_id", F.col("doc_id").cast("string")) if kind == "parquet" else files.read_documents(spark, path)
    return docs.where(F.col("doc_id").isin(*stems)) if stems else docs


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lexweave.jobs", description=__doc__)
    p.add_argument("job", choices=["convert", "clean", "structure", "legal", "generic", "chunk", "providers"])
    p.add_argument("--input", help="Parquet folder of documents, pattern of text files, or files to convert")
    p.add_argument("--output", help="folder to write")
    p.add_argument("--format", choices=["parquet", "text"], default="parquet")
    p.add_argument("--stem", action="append", default=[], help="only this document; may be repeated")
    p.add_argument("--sidecars", help="pattern of sidecar files")
    p.add_argument("--provider", default=providers.PROVIDERS[0].id)
    p.add_argument("--max-chars", type=int, default=chunks.MAX_CHARS)
    a = p.parse_args(argv)
    if a.job == "providers":
        for name, label, there in providers.list_providers():
            print(f"{name}: {label}" + ("" if there else " (not implemented)"))
        return 0
    spark = SparkSession.builder.appName(f"lexweave {a.job}").getOrCreate()
    if a.job == "convert":
        out = providers.convert(metadata.first_supported_files(files.read_binary(spark, a.input), a.stem), providers.provider_spec(a.provider).load)
        files.write_converted(out, a.output)
        return 0
    docs = documents(spark, a.input, a.format, a.stem)
    meta = files.read_sidecars(spark, a.sidecars) if a.sidecars else None
    if meta is not None:
        docs = metadata.named(docs, meta)
        missing = metadata.without_artifact(docs, meta.select("doc_id")).count()
        if missing:
            print(f"{missing} documents have no sidecar")
    if a.job == "clean":
        files.write_cleaned(pipeline.cleaned(docs), a.output)
    elif a.job == "chunk":
        files.write_chunks(pipeline.document_chunks(docs, meta, a.max_chars), a.output)
    else:
        clean = pipeline.cleaned(docs if meta is None else pipeline.with_sidecars(docs, meta))
        parse = {"structure": pipeline.elements, "legal": legal.elements, "generic": generic.sections}[a.job]
        none = docs.select("doc_id", F.lit(None).cast("struct<celex:string,eli:string,title:string,language:string,publication_date:string>").alias("instrument"))
        own = none if meta is None else meta.select("doc_id", F.struct("celex", "eli", "title", "language", "publication_date").alias("instrument"))
        files.write_structures(parse(clean), own, a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
