"""Relational databases over JDBC, by settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """JDBC options from POSTGRES_HOST, POSTGRES_PORT, POSTGRES_DB, POSTGRES_USER and POSTGRES_PASSWORD."""
    e = os.environ if env is None else env
    return {
        "url": f"jdbc:postgresql://{e.get('POSTGRES_HOST', 'localhost')}:{e.get('POSTGRES_PORT', '5432')}/{e.get('POSTGRES_DB', 'postgres')}",
        "user": e.get("POSTGRES_USER", "postgres"), "password": e.get("POSTGRES_PASSWORD", ""), "driver": "org.postgresql.Driver",
    }


def read_query(spark: SparkSession, query: str, env: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(env), query=query).load()


def server_version(spark: SparkSession, env: Mapping[str, str] | None = None) -> DataFrame:
    """The smoke query."""
    return read_query(spark, "select version()", env)


def write_chunks(chunks: DataFrame, table: str = "chunks", env: Mapping[str, str] | None = None) -> None:
    """Chunks appended to a table; arrays and structs as JSON."""
    from pyspark.sql import functions as F

    flat = chunks.select(*(F.to_json(c).alias(c) if t.startswith(("array", "struct")) else F.col(c) for c, t in chunks.dtypes))
    flat.write.format("jdbc").options(**jdbc_options(env), dbtable=table).mode("append").save()
