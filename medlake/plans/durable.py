"""Lineage cuts that survive lost executors: tables written to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else one in the warehouse.

    The warehouse is where the session keeps its tables, so every executor reaches it as well. On a cluster
    whose warehouse is a folder of the driver's machine, which executors do not see, there is no such folder: the first has to be set.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if configured is None and not context.master.startswith("local") and _scheme(spark, warehouse) == "file":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured or f"{warehouse}/medlake-work")
        current = context.getCheckpointDir()
    return configured or current


def _scheme(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a working table in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/medlake-{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a working table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once as a columnar table in the shared folder and return that table.

    For results that several later steps read: none of them computes it again, and a lost
    executor costs no more than re-reading a file.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
