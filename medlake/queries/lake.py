"""Lake inventory operators with page addresses and document keys standing in for objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlake.plans.durable import work_path
from medlake.queries.catalog import query, table
from medlake.sources import lake, objects, tables

# Object keys of both engines: pages spread over layers, folders and extensions.
KEY = """concat(CASE page_id % 4 WHEN 0 THEN 'bronze/images/' WHEN 1 THEN 'bronze/reports/'
  WHEN 2 THEN 'bronze/' ELSE 'silver/reports/' END, regexp_replace(url, '^https?://[^/]*/', ''), '-',
  CAST(page_id AS STRING), CASE page_id % 7 WHEN 0 THEN '.TXT' WHEN 1 THEN '.json' WHEN 2 THEN '.png' WHEN 3 THEN '.JPG'
  WHEN 4 THEN '.pdf' WHEN 5 THEN '' ELSE '.text' END)"""
_OBJECTS = f"""objects AS (SELECT page_id, {KEY} AS path, CAST(length(html) AS BIGINT) AS length, html FROM pages)"""
_SUFFIX = r"lower(regexp_extract(regexp_extract(path, '[^/]*$'), '.(\.[^.]+)$', 1))"


def _objects(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id",
        F.expr(KEY).alias("path"),
        F.length("html").cast("bigint").alias("length"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.col("html").cast("binary").alias("content"),
    )


@query(
    "q_inventory",
    f"""WITH {_OBJECTS} SELECT path, length FROM objects
        WHERE path LIKE 'bronze/%' AND {_SUFFIX} IN ('.txt', '.text', '.json')""",
)
def inventory(spark, sf):
    objects = _objects(spark, sf).select("path", "length")
    return lake.list_objects(objects, "bronze/", lake.REPORT_EXTENSIONS)


@query(
    "q_inventory_first",
    f"""WITH {_OBJECTS} SELECT path, length FROM objects
        WHERE {_SUFFIX} IN ('.jpg', '.jpeg', '.png', '.bmp', '.tiff') ORDER BY path LIMIT 20""",
)
def inventory_first(spark, sf):
    objects = _objects(spark, sf).select("path", "length")
    return lake.list_objects(objects, "", lake.IMAGE_EXTENSIONS, max_results=20)


@query(
    "q_child_prefixes",
    f"""WITH {_OBJECTS} SELECT DISTINCT 'bronze/' || split_part(substr(path, 8), '/', 1) || '/' AS prefix
        FROM objects WHERE path LIKE 'bronze/%' AND strpos(substr(path, 8), '/') > 0""",
)
def child_prefixes(spark, sf):
    return lake.child_prefixes(_objects(spark, sf), "bronze/")


@query(
    "q_verify_counts",
    f"""WITH {_OBJECTS}, p AS (SELECT unnest(['bronze/images/', 'bronze/reports/', 'bronze/structured/']) AS prefix)
    SELECT prefix, count(path) AS objects FROM p LEFT JOIN objects ON starts_with(path, prefix) GROUP BY prefix""",
)
def verify_counts(spark, sf):
    return lake.verify_counts(_objects(spark, sf))


_TYPE = f"""CASE {_SUFFIX} WHEN '.txt' THEN 'text/plain' WHEN '.json' THEN 'application/json'
  WHEN '.png' THEN 'image/png' WHEN '.jpg' THEN 'image/jpeg' WHEN '.pdf' THEN 'application/pdf'
  ELSE 'application/octet-stream' END"""


@query(
    "q_object_metadata",
    f"WITH {_OBJECTS} SELECT path AS name, length AS size, {_TYPE} AS content_type, md5(html) AS md5_hash FROM objects",
)
def object_metadata(spark, sf):
    return lake.object_metadata(_objects(spark, sf)).drop("updated")


_REQUESTED = """requested AS (SELECT CASE WHEN doc_id % 9 = 0 THEN 'bronze/reports/lost-' || doc_id
  ELSE coalesce(path, 'bronze/none-' || doc_id) END AS path FROM documents LEFT JOIN objects ON page_id = doc_id)"""


@query(
    "q_missing_objects",
    f"""WITH {_OBJECTS}, {_REQUESTED}
    SELECT path FROM requested WHERE path NOT IN (SELECT path FROM objects)""",
)
def missing_objects(spark, sf):
    objects = _objects(spark, sf).select("page_id", "path")
    number = F.col("doc_id").cast("string")
    requested = (
        table(spark, sf, "documents")
        .select("doc_id")
        .join(objects, F.col("page_id") == F.col("doc_id"), "left")
        .select(
            F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("bronze/reports/lost-"), number))
            .otherwise(F.coalesce("path", F.concat(F.lit("bronze/none-"), number)))
            .alias("path")
        )
    )
    return lake.missing_objects(requested, objects)


_MANIFEST = """manifest AS (SELECT 'file ' || doc_id AS name, 'page ' || doc_id AS source_path,
  'bronze/structured/' || doc_id || '.csv' AS object_key FROM documents),
status AS (SELECT name, CASE WHEN page_id IS NULL THEN 'NOT_FOUND'
  WHEN page_id % 10 = 0 THEN 'ERROR: unreadable ' || source_path ELSE 'lake://' || object_key END AS status
  FROM manifest LEFT JOIN pages ON source_path = 'page ' || page_id)"""


def _statuses(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("doc_id").cast("string")
    manifest = table(spark, sf, "documents").select(
        F.concat(F.lit("file "), number).alias("name"),
        F.concat(F.lit("page "), number).alias("source_path"),
        F.concat(F.lit("bronze/structured/"), number, F.lit(".csv")).alias("object_key"),
    )
    found = table(spark, sf, "pages").select(
        F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("path"),
        F.when(F.col("page_id") % 10 == 0, F.lit(-1)).otherwise(F.length("html")).alias("length"),
    )
    return lake.ingest_status(manifest, found, "lake://")


@query("q_ingest_status", f"WITH {_MANIFEST} SELECT name, status FROM status")
def ingest_status(spark, sf):
    return _statuses(spark, sf).select("name", "status")


@query(
    "q_ingest_summary",
    f"""WITH {_OBJECTS}, {_MANIFEST}, d AS (SELECT source, count(*) FILTER (WHERE n_chars > 1000) AS files FROM documents GROUP BY 1),
    s AS (SELECT count(*) AS single_files FROM status WHERE status NOT LIKE 'NOT_FOUND%' AND status NOT LIKE 'ERROR%'),
    v AS (SELECT count(*) AS objects_found FROM objects WHERE path LIKE 'bronze/images/%' OR path LIKE 'bronze/reports/%'
          OR path LIKE 'bronze/structured/%')
    SELECT CAST(sum(files) AS BIGINT) AS directory_files, count(*) FILTER (WHERE files > 0) AS directories_ok,
      count(*) FILTER (WHERE files = 0) AS directories_skipped, any_value(single_files) AS single_files,
      any_value(objects_found) AS objects_found, CAST(sum(files) + any_value(single_files) AS BIGINT) AS total_uploaded
    FROM d, s, v""",
)
def ingest_summary(spark, sf):
    directories = (
        table(spark, sf, "documents")
        .groupBy("source")
        .agg(F.count_if(F.col("n_chars") > 1000).alias("files"))
    )
    return lake.ingest_summary(
        directories, _statuses(spark, sf), lake.verify_counts(_objects(spark, sf))
    )


_SILVER = """silver AS (SELECT CASE doc_id % 3 WHEN 0 THEN 'silver/images/' WHEN 1 THEN 'silver/reports/' ELSE 'gold/' END
   || CASE WHEN doc_id % 50 = 0 THEN '' ELSE source || '-' || doc_id || '.json' END AS path FROM documents),
named AS (SELECT prefix, substr(path, length(prefix) + 1) AS name FROM silver,
   (SELECT unnest(['silver/images/', 'silver/reports/', 'silver/structured/']) AS prefix)
   WHERE starts_with(path, prefix) AND length(path) > length(prefix))"""


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    layer = (
        F.when(F.col("doc_id") % 3 == 0, "silver/images/")
        .when(F.col("doc_id") % 3 == 1, "silver/reports/")
        .otherwise("gold/")
    )
    name = F.when(F.col("doc_id") % 50 == 0, "").otherwise(
        F.concat("source", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".json"))
    )
    return table(spark, sf, "documents").select(F.concat(layer, name).alias("path"))


@query("q_layer_names", f"WITH {_SILVER} SELECT prefix, name FROM named")
def layer_names(spark, sf):
    return lake.layer_names(_silver(spark, sf))


@query(
    "q_layer_structure",
    f"""WITH {_SILVER}, p AS (SELECT unnest(['silver/images/', 'silver/reports/', 'silver/structured/']) AS prefix),
    r AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY name) AS i FROM named)
    SELECT p.prefix, count(name) AS files, coalesce(string_agg(name, ',' ORDER BY name) FILTER (WHERE i <= 5), '') AS first_names,
           greatest(count(name) - 5, 0) AS more
    FROM p LEFT JOIN r ON p.prefix = r.prefix GROUP BY p.prefix""",
)
def layer_structure(spark, sf):
    rows = lake.layer_structure(_silver(spark, sf))
    return rows.withColumn("first_names", F.array_join("first_names", ","))


@query(
    "q_retention",
    """SELECT o_orderkey, CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') < 365 THEN 'kept'
       ELSE 'expired' END AS state FROM orders""",
)
def retention(spark, sf):
    kept, expired = lake.apply_retention(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
        lake.RETENTION_DAYS["prod"],
        F.lit("2001-08-02").cast("date"),
        modified="o_orderdate",
    )
    return kept.select("o_orderkey", F.lit("kept").alias("state")).unionByName(
        expired.select("o_orderkey", F.lit("expired").alias("state"))
    )


@query(
    "q_manifest",
    """SELECT substr(md5(CAST(doc_id AS VARCHAR)), 1, 2) AS shard, count(*) AS num_reports,
              string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS report_ids
       FROM documents GROUP BY 1""",
)
def manifest(spark, sf):
    """Sharded by two hash digits here; every id appears in exactly one shard."""
    docs = table(spark, sf, "documents").select("doc_id")
    rows = tables.manifest(docs, "doc_id", 2)
    ids = F.array_join(F.transform("report_ids", lambda x: x.cast("string")), ",")
    return rows.select("shard", "num_reports", ids.alias("report_ids"))


@query(
    "q_manifest_index",
    """WITH numbered AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS number FROM documents)
    SELECT CAST(number // 150 AS BIGINT) AS part, min(doc_id) AS first_id, max(doc_id) AS last_id, count(*) AS num_reports
    FROM numbered GROUP BY 1""",
)
def manifest_index(spark, sf):
    """The index of a manifest in two levels, of 150 ids a part here."""
    docs = table(spark, sf, "documents").select("doc_id")
    return tables.write_manifest(docs, work_path(spark, "manifest"), "doc_id", 150).drop("generated_at")


@query(
    "q_manifest_entries",
    """SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS number,
        CAST((row_number() OVER (ORDER BY doc_id) - 1) // 150 AS BIGINT) AS part FROM documents""",
)
def manifest_entries(spark, sf):
    path = work_path(spark, "manifest")
    tables.write_manifest(table(spark, sf, "documents").select("doc_id"), path, "doc_id", 150)
    return spark.read.parquet(f"{path}/entries")


_INGESTED = "'bronze/reports/' || source || '/' || doc_id || '.txt' AS object_key"


@query(
    "q_ingest_directory",
    f"""SELECT {_INGESTED}, octet_length(encode(text)) AS length, md5(text) AS content_md5 FROM documents""",
)
def ingest_directory(spark, sf):
    """Every text as a file of its own, the folder copied into bronze, and bronze read back."""
    docs = table(spark, sf, "documents").select(F.expr("concat(source, '/', doc_id, '.txt')").alias("object_key"), F.col("text").alias("content"))
    folder, bronze = work_path(spark, "files"), work_path(spark, "bronze")
    objects.put_objects(docs, folder)
    lake.ingest_directory(spark, folder, bronze, "bronze/reports", "reports", [".txt"])
    return lake.read_bronze(spark, bronze).select("object_key", "length", F.md5("content").alias("content_md5"))


@query(
    "q_object_sink",
    """SELECT source || '/' || doc_id || '.txt' AS object_key, octet_length(encode(text)) AS length, CAST(NULL AS VARCHAR) AS error
       FROM documents""",
)
def object_sink(spark, sf):
    """What the sink tells of every object that it wrote."""
    docs = table(spark, sf, "documents").select(F.expr("concat(source, '/', doc_id, '.txt')").alias("object_key"), F.col("text").alias("content"))
    return objects.put_objects(docs, work_path(spark, "files"))


@query(
    "q_ingest_files",
    """SELECT 'nation-' || n_nationkey AS name, n_nationkey % 5 <> 4 AS found,
              CASE WHEN n_nationkey % 5 <> 4 THEN octet_length(encode(n_name)) END AS length FROM nation""",
)
def ingest_files(spark, sf):
    """A mapping of single files, a fifth of them missing, copied into bronze."""
    folder, bronze = work_path(spark, "files"), work_path(spark, "bronze")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    there = nations.where("n_nationkey % 5 <> 4").select(F.expr("concat('n', n_nationkey, '.txt')").alias("object_key"), F.col("n_name").alias("content"))
    objects.put_objects(there, folder)
    mapping = [(f"nation-{r[0]}", f"{folder}/n{r[0]}.txt", f"bronze/nations/{r[0]}.txt") for r in nations.collect()]
    status = lake.ingest_files(spark, mapping, bronze, "nations")
    stored = lake.read_bronze(spark, bronze).select("object_key", "length")
    return status.drop("length").join(stored, "object_key", "left").select("name", F.col("length").isNotNull().alias("found"), "length")


@query(
    "q_format_size",
    """WITH s AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) *
             CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1024 WHEN 2 THEN 262144 ELSE 1 END AS b FROM orders),
    t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN b % 1024 ELSE b END AS b FROM s)
    SELECT o_orderkey, CASE WHEN b < 1024 THEN printf('%.1f B', CAST(b AS DOUBLE))
      WHEN b < 1048576 THEN printf('%.1f KB', b / 1024.0::DOUBLE) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576.0::DOUBLE)
      WHEN b < 1099511627776 THEN printf('%.1f GB', b / 1073741824.0::DOUBLE)
      ELSE printf('%.1f TB', b / 1099511627776.0::DOUBLE) END AS size FROM t""",
)
def format_size(spark, sf):
    key = F.col("o_orderkey") % 4
    factor = F.when(key == 1, 1024).when(key == 2, 262144).otherwise(1).cast("bigint")
    size = F.round(F.col("o_totalprice") * 100).cast("bigint") * factor
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", F.when(key == 3, size % 1024).otherwise(size).alias("b"))
        .select("o_orderkey", lake.format_size(F.col("b")).alias("size"))
    )


@query(
    "q_report_keys",
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_extract(p, '[^/]*$'), '(.)\.[^.]+$', '\1'), '_report$', '')
        || '_structured' AS report_key
    FROM (SELECT doc_id, 'bronze/reports/' || source || '/case_' || doc_id ||
          CASE doc_id % 3 WHEN 0 THEN '_report.txt' WHEN 1 THEN '.v2.text' ELSE '_report' END AS p FROM documents)""",
)
def report_keys(spark, sf):
    tail = (
        F.when(F.col("doc_id") % 3 == 0, "_report.txt")
        .when(F.col("doc_id") % 3 == 1, ".v2.text")
        .otherwise("_report")
    )
    path = F.concat(
        F.lit("bronze/reports/"), "source", F.lit("/case_"), F.col("doc_id").cast("string"), tail
    )
    return table(spark, sf, "documents").select("doc_id", lake.report_key(path).alias("report_key"))
