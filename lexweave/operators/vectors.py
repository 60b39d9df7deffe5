"""Nearest vectors by cosine, exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors held by a worker at once.
QUERY_BLOCK = 4096


def nearest(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, rank): the ``k`` vectors of greatest cosine to each query, itself left out.

    Queries are the stated set. They are read in blocks of about ``QUERY_BLOCK``, by a hash of their id, and held against all
    vectors by matrix products; every task keeps the best ``k`` rows a query over all its batches, so what is shuffled does
    not grow with a task's vectors. Ties go to the lesser id. Vectors that are null, of zero length or of another dimension
    than the query are nobody's neighbours.
    """
    usable = "embedding is not null and size(embedding) > 0"
    queries = queries.where(usable).select("vec_id", "embedding")
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    out = None
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()
        found = _block(vectors.where(usable), [(r[0], list(r[1])) for r in rows], k)
        out = found if out is None else out.unionByName(found)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "vec_id", "rank")


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.full_like(m, np.nan), where=norm > 0)


def _block(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in {len(v) for _, v in shared.value}:
            of = [(i, v) for i, v in shared.value if len(v) == n]
            by_size[n] = np.array([i for i, _ in of], np.int64), _unit(np.array([v for _, v in of], np.float64))
        best = {n: (np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)) for n, (ids, _) in by_size.items()}
        for batch in batches:
            names, lists = np.array(batch.column(0).to_pylist(), np.int64), batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in lists])
            for n, (ids, q) in by_size.items():
                at = np.flatnonzero(sizes == n)
                if not len(at):
                    continue
                v = _unit(np.array([[np.nan if x is None else x for x in lists[i]] for i in at], np.float64))
                own = names[at]
                score = q @ v.T
                score[ids[:, None] == own[None, :]] = np.nan
                score = np.hstack([best[n][0], np.where(np.isnan(score), -np.inf, score)])
                every = np.hstack([best[n][1], np.broadcast_to(own, (len(ids), len(own)))])
                order = np.lexsort((every, -score), axis=1)[:, :k]
                best[n] = np.take_along_axis(score, order, 1), np.take_along_axis(every, order, 1)
        for n, (ids, _) in by_size.items():
            score, every = best[n]
            some = score > -np.inf
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(ids[:, None], score.shape)[some]), pa.array(every[some]), pa.array(score[some])], names=["query_id", "vec_id", "score"])

    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(run, "query_id bigint, vec_id bigint, score double")
