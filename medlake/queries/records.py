"""Registry, de-duplication, patient view, query log, calculators and run reports."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlake.operators import images, quality, registry, reports, summaries
from medlake.plans.durable import cut, work_path
from medlake.queries.catalog import query, table
from medlake.queries.quality import RANGES
from medlake.queries.reports import clean_sql
from medlake.sources import objects


@query(
    "q_patient_view",
    """SELECT o_orderkey AS report_no, o_custkey AS patient_id, c_name, c_acctbal, md5(text) AS text_md5
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN documents ON doc_id = o_custkey""",
)
def patient_view(spark, sf):
    records = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("report_no")
    )
    patients = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("patient_id"), "c_name", "c_acctbal"
    )
    files = table(spark, sf, "documents").select(
        F.col("doc_id").alias("patient_id"), F.md5("text").alias("text_md5")
    )
    return registry.patient_view(patients, [records, files])


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    kind = F.get(
        F.array(*[F.lit(t) for t in registry.DOCUMENT_TYPES]), (F.col("doc_id") % 3).cast("int")
    )
    return registry.registry_rows(
        table(spark, sf, "documents"),
        {
            "document_id": F.col("doc_id").cast("string"),
            "source_path": F.concat(F.lit("silver/reports/"), "source", F.lit("/"), F.col("doc_id").cast("string")),
            "document_type": kind,
            "modality": F.when(kind == "image", "XR"),
            "embedding_path": F.concat(F.lit("gold/embeddings/"), F.col("doc_id").cast("string")),
            "text_content": F.col("text"),
            "created_at": day.cast("timestamp"),
            "updated_at": day.cast("timestamp"),
        },
        metadata=["lang", "n_chars"],
    )


_REGISTRY = """reg AS (SELECT CAST(doc_id AS VARCHAR) AS document_id, 'silver/reports/' || source || '/' || doc_id AS source_path,
  ['image', 'report', 'study'][doc_id % 3 + 1] AS document_type, CASE WHEN doc_id % 3 = 0 THEN 'XR' END AS modality,
  'gold/embeddings/' || doc_id AS embedding_path, md5(text) AS text_md5,
  CAST(to_json({'lang': lang, 'n_chars': n_chars}) AS VARCHAR) AS metadata,
  strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') AS created FROM documents)"""


@query("q_registry", f"WITH {_REGISTRY} SELECT * FROM reg")
def registry_rows(spark, sf):
    return _registry(spark, sf).select(
        "document_id",
        "source_path",
        "document_type",
        "modality",
        "embedding_path",
        F.md5("text_content").alias("text_md5"),
        "metadata",
        F.date_format("created_at", "yyyy-MM-dd").alias("created"),
    )


@query(
    "q_registry_json_filter",
    """SELECT CAST(doc_id AS VARCHAR) AS document_id, lang FROM documents WHERE lang IN ('fr', 'de') AND n_chars > 500""",
)
def registry_json_filter(spark, sf):
    long_enough = registry.metadata_field("n_chars").try_cast("bigint") > 500
    return (
        _registry(spark, sf)
        .where(registry.metadata_field("lang").isin("fr", "de") & long_enough)
        .select("document_id", registry.metadata_field("lang").alias("lang"))
    )


@query(
    "q_sql_tool",
    f"""WITH {_REGISTRY} SELECT document_type, count(*) AS documents, count(modality) AS with_modality
        FROM reg GROUP BY document_type""",
)
def sql_tool(spark, sf):
    registry.register_views({"medlake_registry": _registry(spark, sf)})
    return spark.sql(
        """SELECT document_type, count(*) AS documents, count(modality) AS with_modality
           FROM medlake_registry GROUP BY document_type"""
    )


@query("q_dedup", "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text")
def dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return registry.drop_content_copies(docs, "text", "doc_id").select(
        "doc_id", F.md5("text").alias("text_md5")
    )


@query(
    "q_dedup_repeated_ids",
    """SELECT min(doc_id // 3) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text""",
)
def dedup_repeated_ids(spark, sf):
    """Ids shared by different texts, and every row twice."""
    docs = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 3).alias("doc_id"), "text")
    return registry.drop_content_copies(docs.unionByName(docs), "text", "doc_id").select(
        "doc_id", F.md5("text").alias("text_md5")
    )


@query(
    "q_dedup_key",
    """SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value
       FROM events GROUP BY user_id, event_type""",
)
def dedup_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return registry.drop_copies(events, ["user_id", "event_type"], "event_id")


# Events as a query log: value is latency and confidence, some types are feedback.
def _log(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    feedback = F.when(kind == "purchase", "positive").when(kind == "error", "negative")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("query_id"),
        F.col("ts").alias("timestamp"),
        F.array(
            F.concat(F.lit("doc-"), (F.col("user_id") % 40).cast("string")),
            F.concat(F.lit("doc-"), (F.col("event_id") % 25).cast("string")),
        ).alias("retrieved_doc_ids"),
        (F.col("value") / 500).alias("confidence_score"),
        F.floor("value").alias("latency_ms"),
        feedback.alias("user_feedback"),
    )


@query(
    "q_log_daily",
    """SELECT strftime(ts, '%Y-%m-%d') AS log_date, count(*) AS queries, round(avg(floor(value)), 6) AS avg_latency_ms,
              CAST(max(floor(value)) AS BIGINT) AS max_latency_ms, round(avg(value / 500), 6) AS avg_confidence
       FROM events GROUP BY 1""",
)
def log_daily(spark, sf):
    return registry.log_daily(_log(spark, sf)).select(
        F.date_format("log_date", "yyyy-MM-dd").alias("log_date"),
        "queries",
        F.round("avg_latency_ms", 6).alias("avg_latency_ms"),
        "max_latency_ms",
        F.round("avg_confidence", 6).alias("avg_confidence"),
    )


@query(
    "q_log_latency",
    """WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS log_date, CAST(floor(value) AS BIGINT) AS ms,
        row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY value) AS nth,
        count(*) OVER (PARTITION BY strftime(ts, '%Y-%m-%d')) AS total FROM events WHERE value IS NOT NULL)
    SELECT log_date, min(ms) FILTER (WHERE nth * 100 >= total * 50) AS p50_latency_ms,
        min(ms) FILTER (WHERE nth * 100 >= total * 95) AS p95_latency_ms,
        min(ms) FILTER (WHERE nth * 100 >= total * 99) AS p99_latency_ms
    FROM r GROUP BY log_date""",
)
def log_latency(spark, sf):
    day = F.date_format("log_date", "yyyy-MM-dd")
    return registry.log_latency(_log(spark, sf)).withColumn("log_date", day)


@query(
    "q_log_days",
    """SELECT strftime(ts, '%Y-%m-%d') AS log_date, count(*) AS queries, count(DISTINCT event_id) AS ids,
        CAST(sum(floor(value)) AS BIGINT) AS latency_ms FROM events GROUP BY 1""",
)
def log_days(spark, sf):
    """The log written, and its odd days written once more, read back."""
    log, path = _log(spark, sf), work_path(spark, "query-log")
    registry.replace_log_days(log, path)
    registry.replace_log_days(log.where(F.dayofmonth("timestamp") % 2 == 1), path)
    return spark.read.parquet(path).groupBy(F.date_format("log_date", "yyyy-MM-dd").alias("log_date")).agg(
        F.count(F.lit(1)).alias("queries"),
        F.count_distinct("query_id").alias("ids"),
        F.sum("latency_ms").alias("latency_ms"),
    )


@query(
    "q_log_topdocs",
    """SELECT doc_id, count(*) AS retrievals FROM (
         SELECT 'doc-' || (user_id % 40) AS doc_id FROM events UNION ALL SELECT 'doc-' || (event_id % 25) FROM events)
       GROUP BY doc_id ORDER BY retrievals DESC, doc_id LIMIT 10""",
)
def log_topdocs(spark, sf):
    return registry.log_top_documents(_log(spark, sf))


@query(
    "q_log_feedback",
    """SELECT coalesce(CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative' END, 'none') AS feedback,
              count(*) AS queries, round(avg(value / 500), 6) AS avg_confidence,
              round(count(*) / (SELECT count(*) FROM events), 6) AS share
       FROM events GROUP BY 1""",
)
def log_feedback(spark, sf):
    rows = registry.log_feedback(_log(spark, sf))
    return rows.withColumns(
        {"avg_confidence": F.round("avg_confidence", 6), "share": F.round("share", 6)}
    )


@query(
    "q_calculators",
    """SELECT p_partkey, round(w / (h * h), 6) AS bmi, round(CAST(0.5 AS DOUBLE) * w, 6) AS dose_mg
       FROM (SELECT p_partkey, p_size + CAST(40 AS DOUBLE) AS w, p_size / CAST(100 AS DOUBLE) + CAST(1.2 AS DOUBLE) AS h
             FROM part)""",
)
def calculators(spark, sf):
    weight, height = F.col("p_size") + 40.0, F.col("p_size") / 100.0 + 1.2
    return table(spark, sf, "part").select(
        "p_partkey",
        F.round(registry.bmi(weight, height), 6).alias("bmi"),
        F.round(registry.dose_mg(F.lit(0.5), weight), 6).alias("dose_mg"),
    )


# --- images derived from the embedding vectors ----------------------------------------------

def _grey_levels(vectors: pa.Array, rows: pa.Array) -> pa.Array:
    """The pixels by rows; halves go up, what is null or not a number is white."""
    out = []
    for vector, n in zip(vectors, rows.to_pylist()):
        if not vector.is_valid:
            out.append(None)
            continue
        across, down = (v.to_numpy(zero_copy_only=False).astype(np.float64) for v in (vector.values, vector.values[:n]))
        with np.errstate(invalid="ignore"):
            value = 128 + (400 * down)[:, None] * across
            level = np.floor(value)
            level += value - level >= 0.5
        out.append(np.where(np.isnan(value), 255, np.clip(level, 0, 255)).astype(np.uint8).tobytes())
    return pa.array(out, pa.binary())


def derived_images(spark: SparkSession, sf: str) -> DataFrame:
    """One grey image per vector: pixel (i, j) scales the product of values i and j.

    The side is 64 for most vectors; every fifth one is cut to 40 rows (too small) and
    every seventh has its pixels lost (undecodable).
    """
    vectors = table(spark, sf, "embeddings", ["vec_id", "embedding"])
    rows = F.when(F.col("vec_id") % 5 == 0, F.lit(40)).otherwise(F.lit(64))
    drawn = F.arrow_udf(_grey_levels, "binary", F.ArrowUDFType.SCALAR)
    lost = F.col("vec_id") % 7 == 0
    return (
        vectors.withColumn("rows", rows)
        .withColumn("data", drawn("embedding", "rows"))
        .select(
            F.concat(F.lit("bronze/images/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("path"),
            F.length("data").cast("bigint").alias("file_size"),
            F.struct(
                F.when(lost, F.lit(-1)).otherwise(F.col("rows")).alias("height"),
                F.when(lost, F.lit(-1)).otherwise(F.lit(64)).alias("width"),
                F.when(lost, F.lit(-1)).otherwise(F.lit(1)).alias("nChannels"),
                F.when(~lost, F.col("data")).alias("data"),
            ).alias("image"),
        )
    )


_IMAGES = """img AS (SELECT 'bronze/images/' || vec_id || '.png' AS path, vec_id % 7 = 0 AS lost,
  CASE WHEN vec_id % 5 = 0 THEN 40 ELSE 64 END AS h FROM embeddings)"""


@query(
    "q_image_validate",
    f"""WITH {_IMAGES} SELECT path, CASE WHEN NOT lost THEN 64 END AS width, CASE WHEN NOT lost THEN h END AS height,
        CASE WHEN NOT lost THEN 'L' END AS mode, CAST(h * 64 AS BIGINT) AS file_size, NOT lost AND h = 64 AS is_valid,
        CASE WHEN lost THEN 'Corrupted image file' WHEN h = 40 THEN 'Image too small: 64x40 (minimum 64x64)' END AS error_message
        FROM img""",
)
def image_validate(spark, sf):
    return images.validate_images(derived_images(spark, sf)).select(
        "path", "width", "height", "mode", "file_size", "is_valid", "error_message"
    )


def _tensors(spark: SparkSession, sf: str) -> DataFrame:
    return images.normalise_images(images.validate_images(derived_images(spark, sf)))


def _byte(x: str) -> str:
    return f"CAST(greatest(0, least(255, round_even({x}, 0))) AS UTINYINT)"


_BLUR = "".join(f" + kernel[{t + 1}] * CAST({{{t}}} AS DOUBLE)" for t in range(5))[3:]
_NEIGHBOURS = ["greatest(1, o - 2)", "greatest(1, o - 1)", "o", "least(512, o + 1)", "least(512, o + 2)"]
# The tensor by its definition: weights of six source lines per target line, rounding after each axis, blur, levels.
_LEVELS = f"""lines AS (
  SELECT vec_id AS id, i, list_transform(embedding, lambda y:
      CAST(greatest(0, least(255, round(128 + 400 * CAST(embedding[i] AS DOUBLE) * CAST(y AS DOUBLE)))) AS DOUBLE)) AS line
  FROM embeddings, range(1, 65) AS r(i) WHERE vec_id % 5 <> 0 AND vec_id % 7 <> 0),
lobes AS (
  SELECT q, j, CASE WHEN d = 0 THEN 1 ELSE sin(pi() * d) / (pi() * d) * sin(pi() * d / 3) / (pi() * d / 3) END AS v
  FROM (SELECT q, j, j + 0.5::DOUBLE - (q + 0.5::DOUBLE) / 8 AS d FROM range(512) AS a(q), range(64) AS b(j)) WHERE abs(d) < 3),
taps AS (
  SELECT q, CAST(min(j) AS INTEGER) AS s, list(v / total ORDER BY j) AS t
  FROM (SELECT *, sum(v) OVER (PARTITION BY q) AS total FROM lobes) GROUP BY q),
packed AS (SELECT list(s ORDER BY q) AS ss, list(t ORDER BY q) AS ts FROM taps),
wide AS (
  SELECT id, i, list_transform(range(1, 513), lambda o:
      {_byte("list_dot_product(line[ss[o] + 1 : ss[o] + len(ts[o])], ts[o])")}) AS w FROM lines, packed),
stack AS (SELECT id, list(w ORDER BY i) AS m FROM wide GROUP BY id),
six AS (SELECT id, q, t, {", ".join(f"m[s + {k}] AS r{k}" for k in range(1, 7))} FROM stack, taps),
tall AS (
  SELECT id, q, list_transform(range(1, 513), lambda o:
      {_byte(" + ".join(f"coalesce(t[{k}] * r{k}[o], 0)" for k in range(1, 7)))}) AS g FROM six),
weight AS (
  SELECT list(e / total ORDER BY t) AS kernel
  FROM (SELECT t, exp(-0.5 * ((t - 2) / 0.5) ** 2) AS e, sum(exp(-0.5 * ((t - 2) / 0.5) ** 2)) OVER () AS total FROM range(5) AS a(t))),
near AS (
  SELECT id, q, coalesce(lag(g, 2) OVER up, first_value(g) OVER up) AS a, coalesce(lag(g, 1) OVER up, g) AS b, g AS c,
         coalesce(lead(g, 1) OVER up, g) AS d, coalesce(lead(g, 2) OVER up, lead(g, 1) OVER up, g) AS e
  FROM tall WINDOW up AS (PARTITION BY id ORDER BY q)),
down AS (
  SELECT id, q, kernel, list_transform(range(1, 513), lambda o: {_BLUR.format(*[f"{x}[o]" for x in "abcde"])}) AS g
  FROM near, weight),
levels AS (
  SELECT id, q, list_transform(range(1, 513), lambda o: {_byte(_BLUR.format(*[f"g[{n}]" for n in _NEIGHBOURS]))}) AS g FROM down),
tensors AS (SELECT id, q, list_transform(g, lambda x: CAST(x / 255.0::DOUBLE AS FLOAT)) AS v FROM levels)"""


@query(
    "q_image_tensors",
    f"""WITH {_LEVELS},
    shown AS (
      SELECT id, q, v, array_to_string(list_transform(v, lambda x: format('{{:02x}}', CAST(floor(x * 255::FLOAT) AS INTEGER))), '') AS p
      FROM tensors)
    SELECT CAST(id AS VARCHAR) AS image_key, CAST(sum(len(v)) AS INTEGER) AS "values",
           round(CAST(min(list_min(v)) AS DOUBLE), 6) AS low, round(CAST(max(list_max(v)) AS DOUBLE), 6) AS high,
           round(sum(list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE)))), 4) AS total,
           CAST(sum(length(p)) // 2 AS INTEGER) AS preview_bytes, md5(unhex(string_agg(p, '' ORDER BY q))) AS preview_md5
    FROM shown GROUP BY id""",
)
def image_tensors(spark, sf):
    """Size, range and sum of every tensor, and the digest of its levels."""
    return images.silver_images(_tensors(spark, sf)).select(
        "image_key",
        F.size("tensor").alias("values"),
        F.round(F.col("low").cast("double"), 6).alias("low"),
        F.round(F.col("high").cast("double"), 6).alias("high"),
        F.round("total", 4).alias("total"),
        F.length("preview").alias("preview_bytes"),
        F.md5("preview").alias("preview_md5"),
    )


@query(
    "q_image_files",
    f"""WITH {_IMAGES} SELECT replace(path, '.png', '.bmp') AS path, CAST(54 + 192 * h AS BIGINT) AS file_size,
        'RGB' AS mode, h = 64 AS is_valid, CASE WHEN h = 40 THEN 'Image too small: 64x40 (minimum 64x64)' END AS error_message
        FROM img WHERE NOT lost""",
)
def image_files(spark, sf):
    """Every image as a bitmap file under its own key, read back and validated."""
    folder = work_path(spark, "image-files")
    drawn = cut(derived_images(spark, sf), "drawn")
    made = drawn.select(F.regexp_replace("path", "[.]png$", ".bmp").alias("object_key"), objects.bitmap().alias("content"))
    objects.put_objects(made.where("content is not null"), folder)
    found = images.validate_images(images.read_images(spark, folder))
    path = F.regexp_extract("path", "(bronze/images/.*)$", 1)
    return found.select(path.alias("path"), "file_size", "mode", "is_valid", "error_message")


@query(
    "q_image_summary",
    f"""WITH {_IMAGES} SELECT count(*) AS total_images, count(*) FILTER (WHERE NOT lost AND h = 64) AS processed_successfully,
        count(*) FILTER (WHERE lost OR h = 40) AS failed, CAST(0 AS BIGINT) AS skipped,
        round(sum(h * 64 / 1024.0::DOUBLE) / count(*), 6) AS average_original_size_kb,
        (SELECT string_agg(path, ',' ORDER BY path) FROM (SELECT path FROM img WHERE lost OR h = 40 ORDER BY path LIMIT 10)) AS failed_images
        FROM img""",
)
def image_summary(spark, sf):
    tensors = cut(_tensors(spark, sf).drop("tensor", "preview"))
    return images.image_summary(tensors).select(
        "total_images",
        "processed_successfully",
        "failed",
        "skipped",
        F.round("average_original_size_kb", 6).alias("average_original_size_kb"),
        F.array_join("failed_images", ",").alias("failed_images"),
    )


@query(
    "q_image_embed",
    f"""WITH {_IMAGES} SELECT path AS source_path, CASE WHEN lost OR h = 40 THEN 'error' ELSE 'success' END AS status,
        CASE WHEN lost THEN 'Corrupted image file' WHEN h = 40 THEN 'Image too small: 64x40 (minimum 64x64)' END AS error,
        CASE WHEN lost OR h = 40 THEN -1 ELSE 1408 END AS image_dim,
        CASE WHEN lost OR h = 40 THEN -1 ELSE 1408 END AS text_dim FROM img""",
)
def image_embed(spark, sf):
    out = images.embed_images(_tensors(spark, sf), context=F.col("path"))
    dim = lambda c: F.when(F.col(c).isNull(), F.lit(-1)).otherwise(F.size(c))
    return out.select(
        "source_path",
        "status",
        "error",
        dim("image_embedding").alias("image_dim"),
        dim("text_embedding").alias("text_dim"),
    )


@query(
    "q_image_vectors",
    f"""WITH {_IMAGES}, {_LEVELS},
    places AS (SELECT id, unnest(range(q * 512, q * 512 + 512)) AS p, unnest(v) AS x FROM tensors),
    pooled AS (SELECT id, (11 * p + 10) // 2048 AS place, avg(CAST(x AS DOUBLE)) AS mean FROM places GROUP BY ALL),
    scaled AS (SELECT id, place, mean / sqrt(sum(mean * mean) OVER (PARTITION BY id)) AS x FROM pooled),
    words AS (
      SELECT path, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 1408 AS place, count(*) AS c
      FROM (SELECT path, unnest(regexp_extract_all(path, '[A-Za-z0-9]+')) AS w FROM img WHERE NOT lost AND h = 64) GROUP BY ALL),
    both_kinds AS (
      SELECT 'bronze/images/' || id || '.png' AS source_path, 'image' AS kind, place, x FROM scaled
      UNION ALL SELECT path, 'text', place, c / sqrt(sum(c * c) OVER (PARTITION BY path)) FROM words)
    SELECT source_path, kind, CAST(place AS INTEGER) AS place, round(CAST(CAST(x AS FLOAT) AS DOUBLE), 6) AS value
    FROM both_kinds WHERE x <> 0""",
)
def image_vectors(spark, sf):
    """Every filled place of the image and context vectors."""
    out = images.embed_images(_tensors(spark, sf), context=F.col("path")).where("status = 'success'")
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(f"{k}_embedding").alias("vector")) for k in ("image", "text")]
    return (
        out.select("source_path", F.inline(F.array(*kinds)))
        .select("source_path", "kind", F.posexplode("vector").alias("place", "x"))
        .where("x <> 0")
        .select("source_path", "kind", "place", F.round(F.col("x").cast("double"), 6).alias("value"))
    )


# --- run reports ------------------------------------------------------------------------------

def _stage_rows(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    validated = images.validate_images(derived_images(spark, sf))
    image_row = validated.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_valid").alias("processed"),
        F.count_if(~F.col("is_valid")).alias("failed"),
    )
    docs = table(spark, sf, "documents", ["text"]).withColumnRenamed("text", "raw_text")
    report_row = reports.clean_reports(docs).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("accepted").alias("processed"),
        F.count_if(~F.col("accepted")).alias("failed"),
    )
    vitals_row = quality.quality_counts(table(spark, sf, "lineitem"), RANGES).select(
        F.col("total_rows").alias("total"),
        F.col("total_rows").alias("processed"),
        F.lit(0).cast("bigint").alias("failed"),
        F.lit(0).cast("bigint").alias("table_rows_loaded"),
        F.lit(False).alias("silver_csv_uploaded"),
    )
    return {"images": image_row, "reports": report_row, "vitals": vitals_row}


_STAGES = f"""{_IMAGES},
i AS (SELECT count(*) AS total, count(*) FILTER (WHERE NOT lost AND h = 64) AS processed FROM img),
d AS (SELECT count(*) AS total, count(*) FILTER (WHERE length(c) >= 50) AS processed
      FROM (SELECT {clean_sql('text')} AS c FROM documents)),
v AS (SELECT count(*) AS total, count(*) AS processed FROM lineitem)"""


@query(
    "q_run_stages",
    f"""WITH {_STAGES}
    SELECT stage, total, processed, total - processed AS failed FROM (
      SELECT 'images' AS stage, * FROM i UNION ALL SELECT 'reports', * FROM d UNION ALL SELECT 'vitals', * FROM v)""",
)
def run_stages(spark, sf):
    return summaries.combine_long(_stage_rows(spark, sf))


@query(
    "q_run_report",
    f"""WITH {_STAGES}, e AS (SELECT
      CASE WHEN i.total > i.processed THEN 'Image processing: ' || (i.total - i.processed) || ' failures' END AS a,
      CASE WHEN d.total > d.processed THEN 'Report processing: ' || (d.total - d.processed) || ' failures' END AS b,
      'Vitals processing: Failed to save output' AS c, i.total AS images_total,
      round(i.processed * 100.0 / i.total, 2) AS images_success_pct FROM i, d)
    SELECT concat_ws('; ', a, b, c) AS errors, false AS overall_success, images_total, images_success_pct FROM e""",
)
def run_report(spark, sf):
    stages = _stage_rows(spark, sf)
    row = summaries.run_report(stages["images"], stages["reports"], stages["vitals"])
    total, ok = F.col("images_summary.total"), F.col("images_summary.processed")
    return row.select(
        F.array_join("errors", "; ").alias("errors"),
        "overall_success",
        total.alias("images_total"),
        summaries.success_rate(total, ok).alias("images_success_pct"),
    )
