"""Registration of queries: a name, a Spark callable, and the equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A test table, as stored; with ``columns``, just those, dealt over the cores if in one split.

    A split is at most ``spark.sql.files.maxPartitionBytes``, so only such little is ever moved.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if columns is None:
        return df
    df = df.select(*columns)
    return df.repartition(spark.sparkContext.defaultParallelism) if df.rdd.getNumPartitions() == 1 else df
