"""Streaming forms: new bronze reports as they arrive, and continuous vector upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from medlake.functions.text import decode_bytes
from medlake.operators.reports import clean_reports, reject_reason, split_rejects, structure_reports
from medlake.plans.durable import remove, work_path
from medlake.sources.lake import REPORT_EXTENSIONS, path_kind, report_key, suffix
from medlake.sources.upserts import BUCKETS, create_table, open_table

# Tasks per core into which a micro-batch of reports is dealt.
TASKS_PER_CORE = 2

BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def report_stream(spark: SparkSession, bronze: str, max_files: int = 10_000) -> DataFrame:
    """New report files below ``bronze`` as a stream of (path, raw_text)."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(bronze)
    )
    return files.where(suffix(F.col("path")).isin(REPORT_EXTENSIONS)).select(
        "path", decode_bytes(F.col("content")).alias("raw_text")
    )


def structure_stream(
    reports: DataFrame, silver: str, checkpoint: str, rejects: str | None = None
) -> StreamingQuery:
    """Clean, extract and validate each new report once; appends to the silver table.

    Reports that are not accepted go to the table ``rejects`` (by default ``<silver>_rejected``). In both
    tables a micro-batch owns the directory ``batch=<id>`` and overwrites it when retried. A batch is dealt over all
    cores first: the files that it came in may be few, and a file is read by one task.
    """
    target = rejects or f"{silver.rstrip('/')}_rejected"

    def write(batch: DataFrame, batch_id: int) -> None:
        dealt = batch.repartition(TASKS_PER_CORE * batch.sparkSession.sparkContext.defaultParallelism, "path")
        cleaned = clean_reports(dealt).withColumn("reason", reject_reason(F.col("raw_text")))
        work = work_path(batch.sparkSession, "cleaned")
        cleaned.drop("raw_text").write.parquet(work)
        cleaned = batch.sparkSession.read.parquet(work)
        structured = structure_reports(cleaned.drop("reason"))
        structured = structured.withColumn("report_key", report_key(F.col("path")))
        structured.write.mode("overwrite").parquet(f"{silver}/batch={batch_id}")
        _, failed = split_rejects(cleaned)
        failed.select("path", "reason", "clean_text").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        remove(batch.sparkSession, work)

    return (
        reports.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    vectors: DataFrame,
    log: str,
    checkpoint: str,
    event_time: str | None = None,
    delay: str = "1 hour",
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Append each micro-batch of vectors(id, embedding, version) as changes of the bucketed table ``log``.

    The table is made if there is none. A batch owns the directory ``deltas/batch=<id>`` and overwrites it when retried, which
    makes the write idempotent and its cost that of the batch, not of the table. Repeated
    deliveries of (id, event time) within ``delay`` are dropped when ``event_time`` is given.
    """
    if event_time is not None:
        vectors = vectors.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(
            ["id", event_time]
        )
    spark = vectors.sparkSession
    if path_kind(spark, log) is None:
        create_table(spark.createDataFrame([], vectors.schema), log, buckets=buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        open_table(batch.sparkSession, log).append(batch, batch_id)

    return (
        vectors.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, log: str) -> DataFrame:
    """Current vectors: the highest version of each id, of equal ones the later batch's."""
    return open_table(spark, log).read()


def compact(spark: SparkSession, log: str) -> None:
    """Merge the batches so far into the buckets that they change; a reader then merges newer ones only."""
    open_table(spark, log).compact()
