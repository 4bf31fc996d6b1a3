"""Vitals CSV source and the table, CSV, JSON and manifest sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medlake.operators.quality import to_number
from medlake.plans.durable import cut
from medlake.sources.lake import path_kind, report_key

VITALS_COLUMNS = {
    "patient_id": "string",
    "age": "int",
    "sex": "string",
    "temperature": "double",
    "heart_rate": "double",
    "respiratory_rate": "double",
    "blood_pressure": "string",
    "oxygen_saturation": "double",
    "wbc": "double",
    "crp": "double",
    "diagnosis": "string",
    "image_file": "string",
    "report_file": "string",
}
#: Ids that one row of a manifest's index stands for.
MANIFEST_PART = 100_000
# Cell texts read as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_vitals(spark: SparkSession, path: str) -> DataFrame | None:
    """The vitals CSV with fixed types, or ``None`` if there is no such file.

    Cells are read as text so that a bad cell nulls itself and not its row. Columns the
    file does not have are left out.
    """
    if path_kind(spark, path) is None:
        return None
    raw = spark.read.option("header", "true").option("multiLine", "false").csv(path)
    columns = []
    for name in raw.columns:
        cell = F.when(~F.col(name).isin(MISSING_TOKENS), F.col(name))
        kind = VITALS_COLUMNS.get(name, "string")
        if kind == "double":
            cell = to_number(cell)
        elif kind == "int":
            cell = to_number(cell).try_cast("int")
        columns.append(cell.alias(name))
    return raw.select(*columns)


def load_table(df: DataFrame, target: str) -> int:
    """Truncate-and-replace a table and return its row count, 0 if the load failed.

    ``target`` is a path (it has a slash) or the name of a catalogue table.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    spark = df.sparkSession
    try:
        if "/" in target:
            writer.parquet(target)
            return spark.read.parquet(target).count()
        writer.saveAsTable(target)
        return spark.table(target).count()
    except Exception as problem:
        print(f"table load failed: {problem}")
        return 0


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A table written by :func:`load_table`."""
    return spark.read.parquet(target) if "/" in target else spark.table(target)


def save_csv(df: DataFrame, path: str) -> bool:
    """CSV backup with header, no index column."""
    try:
        df.write.mode("overwrite").option("header", "true").csv(path)
    except Exception as problem:
        print(f"CSV backup failed: {problem}")
        return False
    return True


def save_reports_json(structured: DataFrame, path: str, source_path: str = "path") -> None:
    """Structured reports as JSON lines with their ``report_key``."""
    (
        structured.withColumn("report_key", report_key(F.col(source_path)))
        .write.mode("overwrite")
        .json(path)
    )


def save_run_report(report: DataFrame, path: str) -> None:
    """One JSON row stamped with the time of the run, appended to the report folder."""
    report.withColumn(
        "run_at", F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
    ).coalesce(1).write.mode("append").json(path)


def manifest(
    ids: DataFrame,
    id_col: str = "report_id",
    digits: int = 2,
    generated_at: Column | None = None,
) -> DataFrame:
    """Manifest rows: shard, generated_at, num_reports, sorted report ids.

    One form at every size: ``16**digits`` shards by the first digits of the id's hash, and one
    row for each that holds an id. The caller sets ``digits`` by the length of list wanted.
    """
    return ids.groupBy(hash_shard(id_col, digits).alias("shard")).agg(
        F.first(F.current_timestamp() if generated_at is None else generated_at).alias(
            "generated_at"
        ),
        F.count(F.lit(1)).alias("num_reports"),
        F.sort_array(F.collect_list(id_col)).alias("report_ids"),
    )


def write_manifest(ids: DataFrame, path: str, id_col: str = "report_id", part_rows: int = MANIFEST_PART) -> DataFrame:
    """A manifest of any size in two levels; returns the index ``(part, first_id, last_id, num_reports, generated_at)``.

    Ids are numbered in order over range-sorted tasks; ``entries`` holds a row per id with its number and part, sorted, so that a lookup
    opens the files of one part; ``index`` has a row per ``part_rows`` ids. No list is made. A null id comes first; repeated ids are numbered each.
    """
    ordered = ids.select(F.col(id_col).alias("id")).repartitionByRange("id").sortWithinPartitions("id")
    laid = cut(ordered.select("id", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")), "numbered")
    # One row per task that sorted: their number does not follow that of the ids.
    runs = laid.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("least"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select("task", (F.coalesce(before, F.lit(0)) - F.col("least")).alias("shift"))
    number = F.col("at") + F.col("shift")
    numbered = laid.join(F.broadcast(shifts), "task").select("id", number.alias("number"), F.floor(number / part_rows).alias("part"))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/entries")
    entries = ids.sparkSession.read.parquet(f"{path}/entries")
    index = entries.groupBy("part").agg(
        F.min_by("id", "number").alias("first_id"), F.max_by("id", "number").alias("last_id"), F.count(F.lit(1)).alias("num_reports")
    )
    index = index.withColumn("generated_at", F.current_timestamp())
    index.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/index")
    return ids.sparkSession.read.parquet(f"{path}/index")


def read_part(spark: SparkSession, path: str, part: int) -> DataFrame:
    """The ids of one part in order, from the files that hold it."""
    return spark.read.parquet(f"{path}/entries").where(F.col("part") == part).orderBy("number").select("number", "id")


def hash_shard(id_col: str, digits: int) -> Column:
    """16**digits shards of equal expected size."""
    return F.substring(F.md5(F.col(id_col).cast("string")), 1, digits)
