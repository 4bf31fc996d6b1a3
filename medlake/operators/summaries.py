"""Value counts, group statistics, failure lists and the combined run report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: failures shown in a report.
FAILURES_SHOWN = 10


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, n, percent of all rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return counts.withColumn("percent", F.try_divide(F.col("n") * 100.0, total))


def demographics(
    df: DataFrame, age: str = "age", sex: str = "sex", values: Sequence[str] = ("M", "F")
) -> DataFrame:
    """Age minimum, maximum, mean and one count per sex value (0 when absent)."""
    return df.agg(
        F.min(age).alias("age_min"),
        F.max(age).alias("age_max"),
        F.avg(age).alias("age_mean"),
        *[F.count_if(F.col(sex) == v).alias(f"n_{v}") for v in values],
    )


def group_stats(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Mean, minimum and maximum of each column per group."""
    return df.groupBy(by).agg(
        *[f(c).alias(f"{c}_{n}") for c in columns for n, f in _STATS.items()]
    )


_STATS = {"mean": F.avg, "min": F.min, "max": F.max}


def first_failures(failed: DataFrame, path: str = "path", n: int = FAILURES_SHOWN) -> DataFrame:
    """One row with the first ``n`` failed paths in order (at most ``n`` rows are gathered)."""
    return (
        failed.select(path)
        .orderBy(path)
        .limit(n)
        .agg(F.sort_array(F.collect_list(path)).alias("failed_paths"))
    )


def success_rate(total: Column, ok: Column, digits: int = 2) -> Column:
    return F.round(F.coalesce(F.try_divide(ok * 100.0, total), F.lit(0.0)), digits)


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Columns rounded for display."""
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def run_report(
    images: DataFrame | None,
    reports: DataFrame | None,
    vitals: DataFrame | None,
    structure: DataFrame | None = None,
    started: Column | None = None,
    ended: Column | None = None,
    crashes: Mapping[str, str] | None = None,
    stage_seconds: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row: the three one-row summaries as structs, error messages, overall success.

    Vitals fail when neither the table nor the CSV was saved. ``crashes`` are the messages of stages
    that broke off and have no summary; ``stage_seconds`` tells how long each stage took.
    """
    given = {"images": images, "reports": reports, "vitals": vitals}
    spark = next((d.sparkSession for d in given.values() if d is not None), None)
    spark = spark or SparkSession.getActiveSession()
    columns = {
        f"{name}_summary": df.select(F.struct("*").alias("s")).scalar()
        for name, df in given.items()
        if df is not None
    }
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()])
    messages = []
    if images is not None:
        messages.append(_failures("Image processing", F.col("images_summary.failed")))
    if reports is not None:
        messages.append(_failures("Report processing", F.col("reports_summary.failed")))
    if vitals is not None:
        unsaved = (F.col("vitals_summary.table_rows_loaded") == 0) & ~F.col(
            "vitals_summary.silver_csv_uploaded"
        )
        messages.append(F.when(unsaved, F.lit("Vitals processing: Failed to save output")))
    messages += [F.lit(f"{stage} processing: {message}") for stage, message in (crashes or {}).items()]
    messages = messages or [F.lit(None).cast("string")]
    if stage_seconds:
        entries = [x for stage, took in stage_seconds.items() for x in (F.lit(stage), F.lit(float(took)))]
        row = row.withColumn("stage_seconds", F.create_map(*entries))
    row = row.withColumn("errors", F.array_compact(F.array(*messages))).withColumn(
        "overall_success", F.size("errors") == 0
    )
    if structure is not None:
        row = row.withColumn(
            "bucket_structure",
            structure.agg(
                F.map_from_entries(F.collect_list(F.struct("prefix", "first_names"))).alias("m")
            ).scalar(),
        )
    if started is not None and ended is not None:
        row = row.withColumns(
            {
                "pipeline_start_time": started,
                "pipeline_end_time": ended,
                "total_duration_seconds": (
                    F.unix_micros(ended.cast("timestamp")) - F.unix_micros(started.cast("timestamp"))
                )
                / F.lit(1e6),
            }
        )
    return row


def _failures(stage: str, failed: Column) -> Column:
    return F.when(failed > 0, F.format_string(f"{stage}: %d failures", failed))


def combine_long(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """Long form of several one-row summaries: stage, total, processed, failed."""
    frames = [
        df.select(F.lit(stage).alias("stage"), "total", "processed", "failed")
        for stage, df in summaries.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
