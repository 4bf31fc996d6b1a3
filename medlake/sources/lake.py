"""Object inventory, listings, ingest, verification and retention of the file lake.

Every function works on an inventory ``DataFrame(path, length, modificationTime)``; it may
come from :func:`inventory` or from a table of object keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medlake.functions.text import decode_bytes

# Extensions per kind of file, layer prefixes, retention days, content types.
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".bmp", ".tiff"]
REPORT_EXTENSIONS = [".txt", ".text", ".json"]
INGEST_IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".dcm"]
INGEST_REPORT_EXTENSIONS = [".txt", ".pdf", ".json"]
BRONZE_PREFIXES = ["bronze/images/", "bronze/reports/", "bronze/structured/"]
SILVER_PREFIXES = ["silver/images/", "silver/reports/", "silver/structured/"]
RETENTION_DAYS = {"dev": 30, "test": 14, "prod": 365}
# Lots of small files that a task reads, and tasks that every core gets before lots are put together.
PACKED = 16
TASKS_PER_CORE = 4
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]
NOT_FOUND = "NOT_FOUND"
NAMES_SHOWN = 5
BRONZE_SCHEMA = (
    "object_key string, rel_path string, length bigint, modificationTime timestamp, content binary, category string"
)
CONTENT_TYPES = {
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".bmp": "image/bmp",
    ".tiff": "image/tiff",
    ".txt": "text/plain",
    ".json": "application/json",
    ".csv": "text/csv",
    ".pdf": "application/pdf",
}


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Lower-cased last suffix of the file name with its dot, or ``''``."""
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def report_key(path: Column) -> Column:
    """Key of a structured report: stem minus a trailing ``_report``, plus ``_structured``."""
    return F.concat(F.regexp_replace(stem(path), "_report$", ""), F.lit("_structured"))


def packed(files: DataFrame) -> DataFrame:
    """A scan of files in fewer tasks, where there are many more than cores.

    Spark counts a file as 4 MiB at least, so that a task gets 32 small files and mostly starts and ends. Here it gets up to
    ``PACKED`` such lots, while there are ``TASKS_PER_CORE`` tasks a core. Rows stay as they are and nothing is shuffled.
    """
    lots = files.rdd.getNumPartitions()
    return files.coalesce(max(1, min(lots, max(TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism, lots // PACKED))))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root``; contents are never read.

    Spark's file index skips names starting with ``_`` or ``.``.
    """
    return packed(
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )


def with_relative_path(df: DataFrame, root: str) -> DataFrame:
    """Append ``rel_path``, the part of ``path`` below ``root``."""
    bare = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    return df.withColumn(
        "rel_path", F.regexp_replace("path", rf"^[a-z0-9]*:?/*\Q{bare}\E/+", "")
    )


def list_objects(
    objects: DataFrame,
    prefix: str = "",
    extensions: Sequence[str] | None = None,
    max_results: int | None = None,
    path: str = "path",
) -> DataFrame:
    """Objects under a prefix with an allowed extension (any case), sorted by path."""
    out = objects.where(F.col(path).startswith(prefix)) if prefix else objects
    if extensions is not None:
        out = out.where(suffix(F.col(path)).isin([e.lower() for e in extensions]))
    out = out.orderBy(path)
    return out if max_results is None else out.limit(max_results)


def child_prefixes(
    objects: DataFrame, prefix: str = "", delimiter: str = "/", path: str = "path"
) -> DataFrame:
    """Immediate child prefixes under ``prefix``, as a directory listing would show."""
    rest = F.substring(F.col(path), len(prefix) + 1, 2_147_483_647)
    return (
        objects.where(F.col(path).startswith(prefix))
        .where(F.instr(rest, delimiter) > 0)
        .select(
            F.concat(
                F.lit(prefix), F.substring_index(rest, delimiter, 1), F.lit(delimiter)
            ).alias("prefix")
        )
        .distinct()
    )


def content_type(path: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, suffix(path)), F.lit("application/octet-stream"))


def object_metadata(files: DataFrame) -> DataFrame:
    """name, size, content type, update time and MD5 of ``files(path, length, ..., content)``."""
    return files.select(
        F.col("path").alias("name"),
        F.col("length").alias("size"),
        content_type(F.col("path")).alias("content_type"),
        F.col("modificationTime").alias("updated"),
        F.md5("content").alias("md5_hash"),
    )


def missing_objects(requested: DataFrame, objects: DataFrame, path: str = "path") -> DataFrame:
    """Requested paths that do not exist."""
    return requested.join(objects.select(path), path, "left_anti")


def get_metadata(files: DataFrame, requested: DataFrame) -> DataFrame:
    """Metadata of the requested paths; raises if one is missing."""
    absent = missing_objects(requested, files).take(1)
    if absent:
        raise FileNotFoundError(f"object not found: {absent[0]['path']}")
    return object_metadata(files.join(requested, "path", "left_semi"))


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """``path, raw_text`` of every report file; UTF-8, else Latin-1."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    allowed = files.where(suffix(F.col("path")).isin(REPORT_EXTENSIONS))
    return packed(allowed).select("path", decode_bytes(F.col("content")).alias("raw_text"))


def path_kind(spark: SparkSession, path: str) -> str | None:
    """``'dir'``, ``'file'`` or ``None``, through the path's own file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    return "dir" if fs.getFileStatus(target).isDirectory() else "file"


def read_directory(
    spark: SparkSession, source: str, prefix: str, extensions: Sequence[str] | None = None
) -> DataFrame:
    """Files to ingest from ``source`` with their object key under ``prefix``."""
    kind = path_kind(spark, source)
    if kind is None:
        raise FileNotFoundError(f"directory not found: {source}")
    if kind != "dir":
        raise NotADirectoryError(f"not a directory: {source}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    if extensions:
        files = files.where(suffix(F.col("path")).isin([e.lower() for e in extensions]))
    files = packed(files.where(~file_name(F.col("path")).startswith(".")))
    return with_relative_path(files, source).withColumn(
        "object_key", F.concat(F.lit(prefix.rstrip("/") + "/"), F.col("rel_path"))
    )


def ingest_directory(
    spark: SparkSession,
    source: str,
    bronze: str,
    prefix: str,
    category: str,
    extensions: Sequence[str] | None = None,
) -> DataFrame:
    """Copy a directory into the bronze table and return the keys written.

    Re-running replaces the category. The count is ``count()`` of the result.
    """
    spark_files = read_directory(spark, source, prefix, extensions)
    (
        spark_files.select(
            "object_key",
            "rel_path",
            "length",
            "modificationTime",
            "content",
            F.lit(category).alias("category"),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("category")
        .parquet(bronze)
    )
    return read_bronze(spark, bronze).where(F.col("category") == category).select("object_key")


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """The bronze table; empty where nothing was ingested yet."""
    if path_kind(spark, bronze) is None:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    return spark.read.schema(BRONZE_SCHEMA).parquet(bronze)


def ingest_files(
    spark: SparkSession,
    files: Sequence[tuple[str, str, str]],
    bronze: str,
    category: str = "single",
) -> DataFrame:
    """Copy single files into the bronze table; returns their status (:func:`ingest_status`).

    ``files`` is a mapping somebody wrote: (name, source path, object key). Missing files are told
    as such and the others are copied. Re-running replaces the category.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()

    def located(path: str) -> str:
        target = hadoop.Path(path)
        return target.getFileSystem(conf).makeQualified(target).toString()

    manifest = spark.createDataFrame(
        [(*f, located(f[1])) for f in files], "name string, source_path string, object_key string, path string"
    )
    present = [source for _, source, _ in files if path_kind(spark, source) == "file"]
    if present:
        content = spark.read.format("binaryFile").load(present)
        (
            content.join(F.broadcast(manifest), "path")
            .select(
                "object_key",
                file_name(F.col("path")).alias("rel_path"),
                "length",
                "modificationTime",
                "content",
                F.lit(category).alias("category"),
            )
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("category")
            .parquet(bronze)
        )
        stored = read_bronze(spark, bronze).where(F.col("category") == category).join(manifest, "object_key")
        objects = stored.where(F.col("source_path").isin(present)).select(F.col("source_path").alias("path"), "length")
    else:
        # The category is replaced by nothing.
        old = hadoop.Path(f"{bronze}/category={category}")
        old.getFileSystem(conf).delete(old, True)
        objects = spark.createDataFrame([], "path string, length bigint")
    return ingest_status(manifest.drop("path"), objects.distinct())


def ingest_all(
    spark: SparkSession,
    directories: Sequence[tuple[str, str, str, Sequence[str] | None]],
    files: Sequence[tuple[str, str, str]],
    bronze: str,
    prefixes: Sequence[str] = tuple(BRONZE_PREFIXES),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Copy, verify and sum up a whole mapping: (summary row, status of single files, objects per prefix).

    ``directories`` holds (source, prefix, category, extensions), ``files`` what :func:`ingest_files`
    takes. A source directory that does not exist counts as skipped and what was ingested from it
    before stays.
    """
    counts = []
    for source, prefix, category, extensions in directories:
        there = path_kind(spark, source) == "dir"
        n = ingest_directory(spark, source, bronze, prefix, category, extensions).count() if there else 0
        counts.append((source, prefix, n))
    done = spark.createDataFrame(counts, "source string, prefix string, files bigint")
    status = ingest_files(spark, files, bronze)
    objects = read_bronze(spark, bronze).select(F.col("object_key").alias("path"))
    verified = verify_counts(objects, prefixes)
    return ingest_summary(done, status, verified), status, verified


def ingest_status(manifest: DataFrame, objects: DataFrame, base: str = "") -> DataFrame:
    """Status of each single file of ``manifest(name, source_path, object_key)``.

    The target address, ``NOT_FOUND``, or ``ERROR: ...`` for unreadable (negative length).
    """
    found = objects.select(F.col("path").alias("source_path"), "length")
    return manifest.join(found, "source_path", "left").withColumn(
        "status",
        F.when(F.col("length").isNull(), F.lit(NOT_FOUND))
        .when(F.col("length") < 0, F.concat(F.lit("ERROR: unreadable "), F.col("source_path")))
        .otherwise(F.concat(F.lit(base), F.col("object_key"))),
    )


def prefix_of(path: Column, prefixes: Sequence[str]) -> Column:
    """The first of ``prefixes`` that ``path`` starts with, else null."""
    out = F.when(F.lit(False), F.lit(""))
    for prefix in prefixes:
        out = out.when(path.startswith(prefix), F.lit(prefix))
    return out


def verify_counts(
    objects: DataFrame, prefixes: Sequence[str] = tuple(BRONZE_PREFIXES), path: str = "path"
) -> DataFrame:
    """Object count per prefix, 0 for an empty one."""
    spark = objects.sparkSession
    wanted = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    counts = (
        objects.select(prefix_of(F.col(path), prefixes).alias("prefix"))
        .where(F.col("prefix").isNotNull())
        .groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return wanted.join(counts, "prefix", "left").select(
        "prefix", F.coalesce("n", F.lit(0)).alias("objects")
    )


def ingest_summary(directories: DataFrame, singles: DataFrame, verified: DataFrame) -> DataFrame:
    """Totals of an ingest run: files from directories, good single files, objects found."""
    good = ~(F.col("status").startswith(NOT_FOUND) | F.col("status").startswith("ERROR"))
    return directories.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("directory_files"),
        F.count_if(F.col("files") > 0).alias("directories_ok"),
        F.count_if(F.col("files") == 0).alias("directories_skipped"),
    ).select(
        "*",
        singles.agg(F.count_if(good)).scalar().alias("single_files"),
        verified.agg(F.coalesce(F.sum("objects"), F.lit(0))).scalar().alias("objects_found"),
    ).withColumn("total_uploaded", F.col("directory_files") + F.col("single_files"))


def layer_names(
    objects: DataFrame, prefixes: Sequence[str] = tuple(SILVER_PREFIXES), path: str = "path"
) -> DataFrame:
    """(prefix, name) of every object of a layer, prefix stripped, empty names dropped."""
    prefix = prefix_of(F.col(path), prefixes)
    return (
        objects.select(prefix.alias("prefix"), F.col(path).alias("__path"))
        .where(F.col("prefix").isNotNull())
        .select(
            "prefix", F.substring(F.col("__path"), F.length("prefix") + 1, F.length("__path")).alias("name")
        )
        .where(F.col("name") != "")
    )


def layer_structure(
    objects: DataFrame,
    prefixes: Sequence[str] = tuple(SILVER_PREFIXES),
    shown: int = NAMES_SHOWN,
    path: str = "path",
) -> DataFrame:
    """Per prefix: file count, first names in order, and how many more there are.

    The names shown are ranked with a per-task cut, so a prefix holding most objects does
    not gather in one task; :func:`layer_names` is the full list.
    """
    from pyspark.sql import Window

    names = layer_names(objects, prefixes, path)
    order = Window.partitionBy("prefix").orderBy("name")
    first = (
        names.withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") <= shown)
        .groupBy("prefix")
        .agg(F.sort_array(F.collect_list("name")).alias("first_names"))
    )
    counts = names.groupBy("prefix").agg(F.count(F.lit(1)).alias("files"))
    wanted = objects.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string")
    files = F.coalesce("files", F.lit(0))
    return (
        wanted.join(counts, "prefix", "left")
        .join(first, "prefix", "left")
        .select(
            "prefix",
            files.alias("files"),
            F.coalesce("first_names", F.array().cast("array<string>")).alias("first_names"),
            F.greatest(files - shown, F.lit(0)).alias("more"),
        )
    )


def apply_retention(
    objects: DataFrame, days: int, as_of: Column, modified: str = "modificationTime"
) -> tuple[DataFrame, DataFrame]:
    """(kept, expired): objects ``days`` or more days old expire; 0 keeps everything."""
    if days == 0:
        return objects, objects.where(F.lit(False))
    age = F.datediff(as_of, F.col(modified))
    young = F.coalesce(age < days, F.lit(True))
    return objects.where(young), objects.where(~young)


def format_size(size: Column) -> Column:
    """Bytes in the first unit below 1024, one decimal; terabytes have no upper end.

    Exact halves go to the even digit.
    """
    value = size.cast("double")
    out = F.when(F.lit(False), F.lit(""))
    for power, unit in enumerate(SIZE_UNITS):
        scaled = F.format_string(f"%.1f {unit}", F.bround(value / F.lit(float(1024**power)), 1))
        if unit == SIZE_UNITS[-1]:
            return out.otherwise(scaled)
        out = out.when(value < float(1024 ** (power + 1)), scaled)
    return out
