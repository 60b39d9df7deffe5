"""Helpers that keep plans parallel, bounded and restartable."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper bound, in bytes, of what any operator of this library broadcasts. The size is counted before the hint is given.
BROADCAST_LIMIT = 8 << 20


def spread(df: DataFrame) -> DataFrame:
    """Round-robin rows over the cluster when the scan gives fewer partitions than there are cores.

    Meant for CPU-heavy row-wise work over a table stored in a few unsplittable files; a table in enough splits is left
    alone, so that at scale no shuffle is added.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def bounded_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows times ``row_bytes`` stay under ``limit``, else without one."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the cluster's ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse serves on one machine; on a cluster it is asked for.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named)
    return named


def written(df: DataFrame, *by: str) -> str:
    """The path, as an address, under which ``df`` was written once in the shared folder; it goes when the driver ends.

    The values of the columns ``by`` become folders; a reader that asks for one value opens only its folder.
    """
    jvm = df.sparkSession.sparkContext._jvm
    named = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(df.sparkSession).rstrip('/')}/t-{uuid.uuid4().hex}")
    system = named.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    system.deleteOnExit(named)
    path = system.makeQualified(named).toUri().toString()
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def cut(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that several consumers do not recompute it."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, *by)).select(*df.columns)
