"""One row per key: the current record, the last delivery, or one copy of a text, whatever arrived late or again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .partitioning import written

#: Folders at most, by hash of the file, in which the places of the rows that are kept are written.
MAX_BUCKETS = 4096


def _has_row_ids(df: DataFrame) -> bool:
    try:
        df.select("_metadata.file_path", "_metadata.row_index").schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def current_rows(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """One row of ``df`` per ``keys``: the one with the greatest ``order`` columns (nulls are least), all columns kept.

    A table read from files is never moved: the winners are found on the key and order columns alone by a partially
    aggregated maximum, and their places (file, row) are written to the shared folder by file. A task then reads the
    places of its own files and leaves all other rows out (:func:`_kept`). There is no join, nothing is broadcast and no
    exchange carries the other columns, however many rows are left out; a hot key is one row after the partial maximum.

    Rows that tie in every order column are the same delivery repeated; one of them, by position in the files, is kept.
    A null key is a key like any other. Other frames use a ranked window, which Spark limits before its shuffle.
    """
    names = [c for c in order if c in df.columns]
    named = [(F.col(k) if isinstance(k, str) else k).alias(f"__k{i}") for i, k in enumerate(keys)]
    if not _has_row_ids(df):
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in names], F.lit(0))
        return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")
    file, row = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
    narrow = df.select(*named, F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(names)), file.alias("f"), row.alias("r")).alias("o"))
    best = narrow.groupBy(*(f"__k{i}" for i in range(len(named)))).agg(F.max("o").alias("o")).select("o.f", "o.r")
    buckets = max(1, min(MAX_BUCKETS, len(df.inputFiles())))
    best = best.withColumn("bucket", F.pmod("f", F.lit(buckets)).cast("int"))
    path = written(best.repartition("bucket").sortWithinPartitions("bucket", "f", "r"), "bucket")
    return df.where(_kept(path, buckets)(file, row))


def _kept(path: str, buckets: int):
    """Whether a row, by file and place, is among the places written under ``path``."""

    @F.arrow_udf("boolean")
    def kept(files: pa.Array, rows: pa.Array) -> pa.Array:
        f, r = files.to_numpy(zero_copy_only=False), rows.to_numpy(zero_copy_only=False)
        out = np.zeros(len(f), bool)
        for own in np.unique(f).tolist():
            mine = f == own
            places = places_of(path, own, own % buckets)
            at = r[mine]
            out[mine] = (at < len(places)) & places[np.minimum(at, len(places) - 1)]
        return pa.array(out)

    return kept


@lru_cache(maxsize=4)
def places_of(path: str, file: int, bucket: int) -> np.ndarray:
    """A flag for each row of one file, up to the last that is kept; read by the task that reads the file."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path)
    folder = f"{root}/bucket={bucket}"
    if system.get_file_info(folder).type != fs.FileType.Directory:
        return np.zeros(1, bool)
    rows = ds.dataset(folder, filesystem=system, format="parquet").to_table(columns=["r"], filter=ds.field("f") == file).column("r").to_numpy()
    out = np.zeros(rows.max(initial=0) + 1, bool)
    out[rows] = True
    return out


def current_structure(structure: DataFrame) -> DataFrame:
    """Current records of parsed documents: the greatest revision of each (doc_id, volume)."""
    return current_rows(structure, ["doc_id", "volume"], ["revision", "loaded_at"])


def current_metadata(metadata: DataFrame) -> DataFrame:
    """Current sidecar records: the greatest revision of each doc_id."""
    return current_rows(metadata, ["doc_id"], ["revision", "loaded_at"])


def current_chunks(chunks: DataFrame) -> DataFrame:
    """Each chunk once, as last delivered; chunks without an id stand for themselves, once a text."""
    own = [F.when(F.col("chunk_id").isNull(), h) for h in (F.xxhash64("text"), F.xxhash64(F.lit(29), F.col("text")))]
    return current_rows(chunks, ["chunk_id", *own], ["loaded_at"])
