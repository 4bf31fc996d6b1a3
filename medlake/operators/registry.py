"""Document registry, query log analytics, patient view, de-duplication, calculators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlake.plans.droplist import keep_first
from medlake.plans.skew import skew_safe_joins

REGISTRY_COLUMNS = [
    "document_id",
    "source_path",
    "document_type",
    "modality",
    "body_part",
    "embedding_path",
    "text_content",
    "metadata",
    "created_at",
    "updated_at",
]
# Kinds of documents and of feedback.
DOCUMENT_TYPES = ["image", "report", "study"]
FEEDBACK = ["positive", "negative"]


def registry_rows(
    df: DataFrame, columns: Mapping[str, Column], metadata: Sequence[str | Column] = ()
) -> DataFrame:
    """Rows of the document registry; columns not given are null, ``metadata`` becomes JSON."""
    chosen = dict(columns)
    if metadata:
        chosen["metadata"] = F.to_json(F.struct(*metadata))
    absent = {
        c: F.lit(None).cast("timestamp" if c.endswith("_at") else "string")
        for c in REGISTRY_COLUMNS
    }
    return df.select(*[chosen.get(c, absent[c]).alias(c) for c in REGISTRY_COLUMNS])


def metadata_field(name: str) -> Column:
    return F.get_json_object("metadata", f"$.{name}")


def drop_copies(df: DataFrame, key: Sequence[str], keep_first_by: str) -> DataFrame:
    """One row per key, the one with the smallest ``keep_first_by``; null comes last, ties go by the row's hash.

    Null is a key like any other. Rows that stay are not moved (``plans.droplist``).
    """
    others = [c for c in df.columns if c not in key]
    return keep_first(df, F.struct(*key), _first(keep_first_by, others))


def _first(keep_first_by: str, others: Sequence[str]) -> list[Column]:
    return [F.col(keep_first_by).isNull().alias("none"), F.col(keep_first_by).alias("by"), F.xxhash64(*others).alias("row")]


def drop_content_copies(df: DataFrame, content: str, keep_first_by: str) -> DataFrame:
    """One row of each content, the one with the smallest ``keep_first_by`` (null last), ties by the row's hash.

    Ids need not be unique. Fingerprints, ids and the places of rows are compared; contents stay where they
    are and are read once more by the scan that leaves copies out (``plans.droplist``).
    """
    digest = F.sha2(F.coalesce(F.concat(F.lit("="), F.col(content).cast("string")), F.lit("~")), 256)
    others = [c for c in df.columns if c != content]
    return keep_first(df, digest, _first(keep_first_by, others))


def patient_view(
    patients: DataFrame, records: Sequence[DataFrame], key: str = "patient_id"
) -> DataFrame:
    """``records`` joined onto their patient rows; a patient may own a third of the records.

    The first frame of ``records`` repeats the key (reports); the others hold one row per
    key (vitals, files) and are joined like ``patients``. Hot patients are found once, and every side is dealt by
    patient once: the joins after the first need no further exchange.
    """
    view, *rest = records
    return skew_safe_joins(view, [patients, *rest], key, "left")


def query_log(answers: DataFrame, timestamp: Column, latency_ms: Column, feedback: Column) -> DataFrame:
    """Log rows of answer records."""
    return answers.select(
        "query_id",
        timestamp.alias("timestamp"),
        F.col("query").alias("query_text"),
        F.col("answer").alias("response_text"),
        F.transform("sources", lambda s: s["id"].cast("string")).alias("retrieved_doc_ids"),
        F.col("confidence").alias("confidence_score"),
        latency_ms.cast("bigint").alias("latency_ms"),
        feedback.alias("user_feedback"),
    )


def write_query_log(log: DataFrame, path: str) -> None:
    """Append to the log table, one directory per day."""
    (
        log.withColumn("log_date", F.to_date("timestamp"))
        .write.mode("append")
        .partitionBy("log_date")
        .parquet(path)
    )


def replace_log_days(log: DataFrame, path: str) -> None:
    """Write whole days of the log: each day in ``log`` takes the place of that day in the table.

    Running it again, or after a run that broke off, leaves the same table; other days are not touched.
    """
    (
        log.withColumn("log_date", F.to_date("timestamp"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("log_date")
        .parquet(path)
    )


def log_latency(log: DataFrame, percents: Sequence[int] = (50, 95, 99)) -> DataFrame:
    """``log_date, p50_latency_ms, ...``: the smallest latency that so many percent of a day's queries do not exceed.

    Exact. Equal latencies of a day are counted before they move, so a day costs its distinct
    milliseconds; rows without latency are left out.
    """
    counts = (
        log.where("latency_ms is not null")
        .groupBy(F.to_date("timestamp").alias("log_date"), "latency_ms")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    day = Window.partitionBy("log_date")
    ranked = counts.withColumns(
        {"upto": F.sum("n").over(day.orderBy("latency_ms")), "total": F.sum("n").over(day)}
    )
    return ranked.groupBy("log_date").agg(
        *[
            F.min(F.when(F.col("upto") * 100 >= F.col("total") * p, F.col("latency_ms"))).alias(f"p{p}_latency_ms")
            for p in percents
        ]
    )


def log_daily(log: DataFrame) -> DataFrame:
    """Volume, latency, confidence per day."""
    return log.groupBy(F.to_date("timestamp").alias("log_date")).agg(
        F.count(F.lit(1)).alias("queries"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.avg("confidence_score").alias("avg_confidence"),
    )


def log_feedback(log: DataFrame) -> DataFrame:
    """Count, share and mean confidence per kind of feedback (absent feedback included)."""
    total = log.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        log.groupBy(F.coalesce("user_feedback", F.lit("none")).alias("feedback"))
        .agg(F.count(F.lit(1)).alias("queries"), F.avg("confidence_score").alias("avg_confidence"))
        .withColumn("share", F.col("queries") / total)
    )


def log_top_documents(log: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` documents retrieved most often."""
    return (
        log.select(F.explode("retrieved_doc_ids").alias("doc_id"))
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("retrievals"))
        .orderBy(F.desc("retrievals"), "doc_id")
        .limit(n)
    )


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make metadata tables queryable with ``spark.sql``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def bmi(weight_kg: Column, height_m: Column) -> Column:
    return F.try_divide(weight_kg, height_m * height_m)


def dose_mg(mg_per_kg: Column, weight_kg: Column) -> Column:
    return mg_per_kg * weight_kg
