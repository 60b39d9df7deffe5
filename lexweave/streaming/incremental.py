"""Documents that arrive as files, chunked as they come. All operators work on one row, so no state and no watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunks import MAX_CHARS
from ..operators.pipeline import document_chunks


def document_stream(spark: SparkSession, directory: str, schema: str = "doc_id string, text string", max_files: int = 1000) -> DataFrame:
    """New Parquet files of documents, at most ``max_files`` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(directory)


def chunk_stream(docs: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunks of a stream of documents."""
    return document_chunks(docs.withColumn("doc_id", F.col("doc_id").cast("string")), max_chars=max_chars)


def ingest(docs: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Chunks of all files that are there and were not read before, appended to ``out``; then it ends."""
    return chunk_stream(docs).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
