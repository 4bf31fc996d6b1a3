"""The composed bronze-to-silver jobs and the combined run."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlake.operators.images import (
    image_summary,
    normalise_images,
    read_images,
    validate_images,
)
from medlake.operators.quality import (
    VITAL_RANGES,
    VITAL_RULES,
    MedianImputer,
    Range,
    Rule,
    add_flags,
    coerce_numeric,
    drop_unused_flags,
    null_out_of_range,
    quality_counts,
    split_ratio,
)
from medlake.operators.reports import (
    clean_reports,
    reject_reason,
    report_summary,
    split_rejects,
    structure_reports,
)
from medlake.operators.summaries import first_failures, round_columns, run_report
from medlake.plans.durable import cut
from medlake.sources.lake import inventory, layer_structure, path_kind, read_reports, stem, with_relative_path
from medlake.sources.tables import (
    load_table,
    read_table,
    read_vitals,
    save_csv,
    save_reports_json,
    save_run_report,
)


def reports_job(raw: DataFrame, silver: str, rejects: str | None = None) -> DataFrame:
    """``raw(path, raw_text)`` -> structured JSON under ``silver``; returns the summary row.

    Every report that was not accepted is a row ``path, reason, clean_text`` of the Parquet table
    ``rejects`` (by default ``<silver>_rejected``). Cleaned and structured rows are written once as
    working tables and everything after that reads them, so cleaning and extraction run once.
    """
    cleaned = clean_reports(raw).withColumn("reason", reject_reason(F.col("raw_text")))
    cleaned = cut(cleaned.drop("raw_text"), "cleaned")
    structured = cut(structure_reports(cleaned.drop("reason")), "reports")
    save_reports_json(structured, silver)
    _, failed = split_rejects(cleaned)
    failed.select("path", "reason", "clean_text").write.mode("overwrite").parquet(
        rejects or f"{silver.rstrip('/')}_rejected"
    )
    summary = round_columns(report_summary(cleaned, structured), {"average_confidence": 3})
    return summary.withColumn("failed_reports", first_failures(failed).scalar())


def vitals_job(
    raw: DataFrame,
    table: str,
    csv: str,
    ranges: Sequence[Range] = tuple(VITAL_RANGES),
    rules: Sequence[Rule] = tuple(VITAL_RULES),
    compat_schema: bool = False,
) -> DataFrame:
    """Parse, range-check, impute, flag and save one vitals table; returns the summary row.

    The parsed rows are written once as a columnar working table: the counts and the median
    passes then read only the columns they need. Medians are a handful of numbers, so the
    final write is one narrow pass.
    """
    parsed = split_ratio(raw) if "blood_pressure" in raw.columns else raw
    parsed = cut(coerce_numeric(parsed, [r.column for r in ranges]), "vitals")
    counts = quality_counts(parsed, ranges).first()
    ranged = null_out_of_range(parsed, ranges)
    imputed = MedianImputer.fit(ranged, [r.column for r in ranges]).transform(ranged)
    missing = counts["missing_by_column"]
    if compat_schema:
        imputed = drop_unused_flags(imputed, missing)
    enriched, added = add_flags(imputed, rules, stamp=True)
    rows = load_table(enriched, table)
    saved = save_csv(read_table(raw.sparkSession, table) if rows else enriched, csv)
    return raw.sparkSession.range(1).select(
        F.lit(counts["total_rows"]).alias("total_records"),
        F.lit(counts["total_rows"]).alias("records_processed"),
        F.struct(
            F.lit(counts["total_rows"]).alias("total_rows"),
            _literal_map(counts["outliers_by_column"]).alias("outliers_by_column"),
            _literal_map(missing).alias("missing_by_column"),
            F.lit(counts["rows_with_outliers"]).alias("rows_with_outliers"),
            F.lit(counts["rows_with_missing"]).alias("rows_with_missing"),
            F.lit(sum(missing.values())).alias("imputed_values"),
        ).alias("data_quality"),
        F.array(*[F.lit(a) for a in added]).alias("derived_features_added"),
        F.lit(rows).alias("table_rows_loaded"),
        F.lit(saved).alias("silver_csv_uploaded"),
    )


def _literal_map(values: dict[str, int]):
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))])


def no_vitals(spark: SparkSession) -> DataFrame:
    """Summary of a run whose vitals file was missing: nothing saved, so it is an error."""
    return spark.range(1).select(
        F.lit(0).alias("total_records"),
        F.lit(0).alias("records_processed"),
        F.lit(0).alias("table_rows_loaded"),
        F.lit(False).alias("silver_csv_uploaded"),
    )


def images_job(spark: SparkSession, bronze: str, silver: str, denoise: bool = True) -> DataFrame:
    """Image files -> tensor table under ``silver``; returns the summary row.

    Tensors are heavy and written once: rows of failed images go to the partition
    ``is_valid=false`` of the same table, without a tensor. The summary reads small columns.
    """
    tensors = normalise_images(validate_images(read_images(spark, bronze)), denoise)
    (
        tensors.withColumn("image_key", stem(F.col("path")))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("is_valid")
        .parquet(silver)
    )
    stored = spark.read.schema(
        "path string, file_size bigint, error_message string, elapsed_ms double, is_valid boolean"
    ).parquet(silver)
    return round_columns(
        image_summary(stored),
        {"average_original_size_kb": 2, "average_processing_time_ms": 2},
    )


def run_all(
    spark: SparkSession,
    bronze: str,
    silver: str,
    report_dir: str | None = None,
    images: bool = True,
    reports: bool = True,
    vitals: bool = True,
    silver_keys: DataFrame | None = None,
) -> DataFrame:
    """All selected jobs one after the other, and the combined report row.

    A stage that breaks off leaves an error line and no summary; the others still run.
    The layer structure lists the keys of ``silver_keys(path)``, or else the files below ``silver`` as
    they are after the run.
    """
    started = spark.range(1).select(F.current_timestamp().alias("t")).first()["t"]
    bronze, silver = bronze.rstrip("/"), silver.rstrip("/")

    def vitals_stage() -> DataFrame:
        table = read_vitals(spark, f"{bronze}/structured/patient_vitals.csv")
        if table is None:
            return no_vitals(spark)
        return vitals_job(table, f"{silver}/structured/vitals", f"{silver}/structured/vitals_csv")

    stages = {
        "Image": images and (lambda: images_job(spark, f"{bronze}/images", f"{silver}/images")),
        "Report": reports and (lambda: reports_job(read_reports(spark, f"{bronze}/reports"), f"{silver}/reports")),
        "Vitals": vitals and vitals_stage,
    }
    rows, crashes, seconds = dict.fromkeys(stages), {}, {}
    for name, stage in stages.items():
        if not stage:
            continue
        begun = time.monotonic()
        try:
            # The summary is made here: what fails while it runs belongs to its stage.
            rows[name] = cut(stage(), "summary")
        except Exception as error:  # noqa: BLE001  (one stage must not end the others)
            crashes[name] = (str(error).strip().splitlines() or [type(error).__name__])[0][:300]
        seconds[name.lower()] = time.monotonic() - begun
    image_row, report_row, vitals_row = rows.values()
    if silver_keys is None and path_kind(spark, silver):
        written = with_relative_path(inventory(spark, silver), silver)
        silver_keys = written.select(F.concat(F.lit("silver/"), F.col("rel_path")).alias("path"))
    structure = None if silver_keys is None else layer_structure(silver_keys)
    report = run_report(
        image_row,
        report_row,
        vitals_row,
        structure,
        F.lit(started),
        F.current_timestamp(),
        crashes,
        seconds,
    )
    if report_dir:
        save_run_report(report, report_dir)
    return report
