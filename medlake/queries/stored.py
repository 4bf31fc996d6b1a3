"""Sources, sinks, composed jobs and streams: what they wrote, read back from the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlake.operators import quality, reports, summaries
from medlake.plans import jobs
from medlake.plans.durable import work_path
from medlake.queries.catalog import ORACLES, query, table
from medlake.queries.records import _stage_rows
from medlake.queries.reports import _FIELDS_SQL, RAW_REPORT, clean_sql
from medlake.sources import tables, upserts
from medlake.streaming import jobs as streams

# --- vitals: CSV source, table, CSV backup, summary ---------------------------------------------

# Orders as cells of a vitals file, some missing, unreadable or out of range, for both engines.
_CELLS = [
    "concat('P-', CAST(o_orderkey AS STRING)) AS patient_id",
    "CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(20 + o_orderkey % 70 AS STRING) END AS age",
    "CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex",
    """CASE WHEN o_orderkey % 13 = 0 THEN 'NA'
       ELSE concat(CAST(93 + o_orderkey % 15 AS STRING), '.', CAST(o_custkey % 10 AS STRING)) END AS temperature""",
    "CASE WHEN o_orderkey % 11 = 0 THEN 'high' ELSE CAST(30 + (o_orderkey * 7) % 190 AS STRING) END AS heart_rate",
    "CAST(6 + o_custkey % 38 AS STRING) AS respiratory_rate",
    """CASE o_orderkey % 9 WHEN 0 THEN '120' WHEN 1 THEN ''
       ELSE concat(CAST(60 + (o_orderkey * 3) % 160 AS STRING), '/', CAST(35 + o_custkey % 110 AS STRING)) END AS blood_pressure""",
    "CAST(65 + o_orderkey % 40 AS STRING) AS oxygen_saturation",
    "concat(CAST(o_custkey % 34 AS STRING), '.5') AS wbc",
]
_READ = f"""cells AS (SELECT {", ".join(_CELLS)} FROM orders),
vitals AS (SELECT patient_id, try_cast(age AS INTEGER) AS age, sex, try_cast(temperature AS DOUBLE) AS temperature,
  try_cast(heart_rate AS DOUBLE) AS heart_rate, CAST(respiratory_rate AS DOUBLE) AS respiratory_rate,
  nullif(blood_pressure, '') AS blood_pressure, CAST(oxygen_saturation AS DOUBLE) AS oxygen_saturation,
  CAST(wbc AS DOUBLE) AS wbc FROM cells)"""
_BOUNDS = {r.column: (f"{r.low:g}", f"{r.high:g}") for r in quality.VITAL_RANGES}


def _threshold(x: float) -> str:
    return f"{x:g}" if x == int(x) else f"CAST({x} AS DOUBLE)"


_FLAGS = {r.flag: f"{r.column} {r.op} {_threshold(r.threshold)}" for r in quality.VITAL_RULES}


def _each(form: str, join: str = ", ") -> str:
    return join.join(form.format(c=c, lo=lo, hi=hi) for c, (lo, hi) in _BOUNDS.items())


_PART = "CASE WHEN strpos(blood_pressure, '/') > 0 THEN CAST(split_part(blood_pressure, '/', {n}) AS DOUBLE) END"
_ENRICHED = f"""{_READ},
parsed AS (SELECT *, {_PART.format(n=1)} AS bp_systolic, {_PART.format(n=2)} AS bp_diastolic FROM vitals),
ranged AS (SELECT patient_id, {_each("CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}")} FROM parsed),
mid AS (SELECT {_each("median({c}) AS m_{c}")} FROM ranged),
filled AS (SELECT patient_id, {_each("coalesce({c}, m_{c}) AS {c}")}, {_each("CAST({c} IS NULL AS INTEGER) AS {c}_imputed")} FROM ranged, mid),
flagged AS (SELECT *, {", ".join(f"CAST({test} AS INTEGER) AS {flag}" for flag, test in _FLAGS.items())} FROM filled)"""


def _vitals(spark: SparkSession, sf: str) -> DataFrame:
    """The cells written as CSV and read by the vitals source."""
    path = work_path(spark, "vitals-cells")
    tables.save_csv(table(spark, sf, "orders", ["o_orderkey", "o_custkey"]).selectExpr(*_CELLS), path)
    return tables.read_vitals(spark, path)


def _vitals_run(spark: SparkSession, sf: str) -> tuple[DataFrame, str, str]:
    """Summary of the vitals job, and where its table and its CSV backup are."""
    silver, backup = work_path(spark, "vitals-table"), work_path(spark, "vitals-backup")
    return jobs.vitals_job(_vitals(spark, sf), silver, backup), silver, backup


@query("q_vitals_source", f"WITH {_READ} SELECT * FROM vitals")
def vitals_source(spark, sf):
    return _vitals(spark, sf)


_STORED = f"""SELECT patient_id, {_each("round({c}, 4) AS {c}")}, {_each("{c}_imputed")}, {", ".join(_FLAGS)},
  {" + ".join(_FLAGS)} AS abnormal_vital_count FROM flagged"""


def _stored(rows: DataFrame) -> DataFrame:
    """The columns of ``_STORED``, whatever type the sink kept."""
    return rows.select(
        "patient_id",
        *[F.round(F.col(c).cast("double"), 4).alias(c) for c in _BOUNDS],
        *[F.col(c).cast("int").alias(c) for c in [*[f"{b}_imputed" for b in _BOUNDS], *_FLAGS, "abnormal_vital_count"]],
    )


@query("q_vitals_table", f"WITH {_ENRICHED} {_STORED}")
def vitals_table(spark, sf):
    _, silver, _ = _vitals_run(spark, sf)
    return _stored(tables.read_table(spark, silver))


@query("q_vitals_backup", f"WITH {_ENRICHED} {_STORED}")
def vitals_backup(spark, sf):
    _, _, backup = _vitals_run(spark, sf)
    return _stored(spark.read.option("header", "true").csv(backup))


@query(
    "q_vitals_summary",
    f"""WITH {_ENRICHED}, outside AS (SELECT {_each("coalesce({c} NOT BETWEEN {lo} AND {hi}, false) AS {c}")} FROM parsed),
    o AS (SELECT count(*) AS total_records, count(*) FILTER (WHERE {_each("{c}", " OR ")}) AS rows_with_outliers,
      count(*) FILTER (WHERE temperature) AS temperature_outliers, count(*) FILTER (WHERE bp_systolic) AS bp_systolic_outliers FROM outside),
    f AS (SELECT CAST(sum({_each("{c}_imputed", " + ")}) AS BIGINT) AS imputed_values,
      count(*) FILTER (WHERE {_each("{c}_imputed = 1", " OR ")}) AS rows_with_missing, count(*) AS table_rows_loaded FROM filled)
    SELECT *, true AS silver_csv_uploaded, '{",".join([*_FLAGS, "abnormal_vital_count", "processing_timestamp"])}' AS added FROM o, f""",
)
def vitals_summary(spark, sf):
    summary, _, _ = _vitals_run(spark, sf)
    found = F.col("data_quality")
    return summary.select(
        F.col("total_records").cast("long").alias("total_records"),
        found["rows_with_outliers"].cast("long").alias("rows_with_outliers"),
        found["outliers_by_column"]["temperature"].cast("long").alias("temperature_outliers"),
        found["outliers_by_column"]["bp_systolic"].cast("long").alias("bp_systolic_outliers"),
        found["imputed_values"].cast("long").alias("imputed_values"),
        found["rows_with_missing"].cast("long").alias("rows_with_missing"),
        F.col("table_rows_loaded").cast("long").alias("table_rows_loaded"),
        "silver_csv_uploaded",
        F.array_join("derived_features_added", ",").alias("added"),
    )


# --- reports: JSON sink, rejects, run report, stream --------------------------------------------

_REPORT_PATH = "concat('bronze/reports/', CAST(doc_id AS STRING), '_report.txt') AS path"
_KEYED = f"""WITH {_FIELDS_SQL} SELECT CAST(doc_id AS STRING) || '_structured' AS report_key, patient_id, age, sex,
  symptoms, md5(findings) AS findings_md5, impression, len(missing) = 0 AS is_valid FROM validated"""
_REPORT_ROW = "report_key string, patient_id string, age int, sex string, symptoms string, findings string, impression string, is_valid boolean"


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select("report_key", "patient_id", "age", "sex", "symptoms", F.md5("findings").alias("findings_md5"), "impression", "is_valid")


@query("q_reports_json", _KEYED)
def reports_json(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "text", "lang", "source"])
    silver = work_path(spark, "reports-json")
    jobs.reports_job(docs.select(F.expr(_REPORT_PATH), F.expr(RAW_REPORT).alias("raw_text")), silver)
    return _keyed(spark.read.schema(_REPORT_ROW).json(silver))


@query(
    "q_rejected_reports",
    f"""SELECT 'bronze/reports/' || doc_id || '_report.txt' AS path, CAST(length(coalesce(c, '')) AS INTEGER) AS clean_length,
          CASE WHEN t IS NULL THEN '{reports.NO_TEXT}' ELSE '{reports.SHORT_TEXT}' END AS reason
        FROM (SELECT doc_id, t, {clean_sql('t')} AS c FROM (SELECT doc_id, CASE WHEN doc_id % 50 <> 0 THEN text END AS t FROM documents))
        WHERE coalesce(length(c), 0) < 50""",
)
def rejected_reports(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "text"])
    raw = docs.select(F.expr(_REPORT_PATH), F.when(F.col("doc_id") % 50 != 0, F.col("text")).alias("raw_text"))
    rejects = work_path(spark, "rejects")
    jobs.reports_job(raw, work_path(spark, "reports-json"), rejects)
    return spark.read.parquet(rejects).select("path", F.length("clean_text").alias("clean_length"), "reason")


@query("q_run_report_json", ORACLES["q_run_report"])
def run_report_json(spark, sf):
    stages = _stage_rows(spark, sf)
    folder = work_path(spark, "run-report")
    tables.save_run_report(summaries.run_report(stages["images"], stages["reports"], stages["vitals"]), folder)
    total, ok = F.col("images_summary.total"), F.col("images_summary.processed")
    return spark.read.json(folder).select(
        F.array_join("errors", "; ").alias("errors"),
        "overall_success",
        total.alias("images_total"),
        summaries.success_rate(total, ok).alias("images_success_pct"),
    )


def _arriving(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a stream of several files, one per micro-batch."""
    spark, folder = rows.sparkSession, work_path(rows.sparkSession, label)
    rows.repartition(4).write.parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query("q_report_stream", _KEYED)
def report_stream(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "text", "lang", "source"])
    raw = docs.select(F.expr(_REPORT_PATH), F.expr(RAW_REPORT).alias("raw_text"))
    silver = work_path(spark, "streamed-reports")
    streams.structure_stream(_arriving(raw, "arriving"), silver, work_path(spark, "offsets")).awaitTermination()
    return _keyed(spark.read.option("basePath", silver).parquet(silver))


@query(
    "q_vector_stream",
    """WITH best AS (SELECT vec_id // 3 AS id, max(vec_id) AS version, arg_max(embedding, vec_id) AS embedding FROM embeddings GROUP BY 1)
    SELECT id, version, unnest(range(len(embedding))) AS place, CAST(unnest(embedding) AS DOUBLE) AS value FROM best""",
)
def vector_stream(spark, sf):
    """Three versions of each id over several micro-batches; every value of the current vectors."""
    changes = table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 3).cast("long").alias("id"), "embedding", F.col("vec_id").cast("long").alias("version")
    )
    log, offsets, folder = (work_path(spark, x) for x in ("vector-log", "offsets", "arriving"))
    for n, part in enumerate((F.col("version") % 2 == 0, F.col("version") % 2 == 1)):
        # Half of the batches, a compaction, and further batches.
        changes.where(part).repartition(2).write.mode("append").parquet(folder)
        arriving = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        streams.upsert_stream(arriving, log, offsets, buckets=16).awaitTermination()
        if n == 0:
            streams.compact(spark, log)
    return _values(streams.read_latest(spark, log))


def _values(rows: DataFrame) -> DataFrame:
    """Every value of every vector."""
    return rows.select("id", "version", F.posexplode("embedding").alias("place", "value")).select(
        "id", "version", F.col("place").cast("long").alias("place"), F.col("value").cast("double").alias("value")
    )


@query("q_upsert_in_place", ORACLES["q_upsert_ties"])
def upsert_in_place(spark, sf):
    """The rows of q_upsert_ties from a stored table, of which an update rewrites only the buckets that it changes."""
    version = F.when(F.col("label") % 3 != 0, F.col("label")).alias("version")
    current = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", version)
    changed = F.when(F.col("id") % 4 == 0, F.col("version")).otherwise(F.col("version") - 1)
    changes = current.where("id % 2 = 0").select("id", F.transform("embedding", lambda x: -x).alias("embedding"), changed.alias("version"))
    return _values(upserts.create_table(current, work_path(spark, "vectors"), buckets=32).upsert(changes).read())
