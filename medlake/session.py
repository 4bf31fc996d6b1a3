"""Session construction for laptops, tests and benches; clusters bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows carrying image tensors weigh about 1 MiB each: bound batches by bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # Overwrites replace only the partitions they write.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "medlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
