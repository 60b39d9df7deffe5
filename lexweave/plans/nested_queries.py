"""Queries of problem 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested
from ..operators.current import current_structure


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return current_structure(spark.read.parquet(f"{d}/structure.parquet")), spark.read.parquet(f"{d}/structure_raw.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Each node with its parent."""
    return nested.links(*_inputs(spark, d))


def _plain(out: DataFrame) -> DataFrame:
    return out.withColumns({c: F.to_json(c) for c in ("cells", "others", "misfits") if c in out.columns})


def _table(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _plain(nested.flat_table(nested.nodes(*_inputs(spark, d)), name))

    run.__doc__ = f"The flat table of {name}, each row with its parent."
    return run


def _variant(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _plain(nested.variant_table(nested.nodes(*_inputs(spark, d)), name))

    run.__doc__ = f"The subtype table {name}, each row with its parent."
    return run


QUERIES = {"p1_found": p1_found} | {f"p1_{name}": _table(name) for name in nested.TABLES}
QUERIES |= {f"p1_{role}_{variant}": _variant(f"{role}_{variant}") for role, variant in nested.variants()}
