"""Cleaning, extraction and validation of report texts composed from the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlake.functions.text import clean_text, decode_bytes
from medlake.operators import reports
from medlake.queries.catalog import query, table

# Both engines compose the same raw reports from this expression: ids, ages and sexes in
# several spellings (some out of range or absent), then the document as findings.
RAW_REPORT = """concat(
  CASE doc_id % 5 WHEN 0 THEN concat('Patient  ID: P-', CAST(doc_id AS STRING))
                  WHEN 1 THEN concat('MRN: AB-', CAST(doc_id AS STRING))
                  WHEN 2 THEN concat('Case #: ', CAST(doc_id AS STRING))
                  WHEN 3 THEN 'Anonymous subject' ELSE 'Medical Record Number = 77_x' END, chr(13), chr(10),
  CASE doc_id % 4 WHEN 0 THEN concat('Age: ', CAST(doc_id % 131 AS STRING), ' years')
                  WHEN 1 THEN concat(CAST(20 + doc_id % 60 AS STRING), ' years old')
                  WHEN 2 THEN 'Age: 121, 45yo' ELSE '' END, chr(10),
  CASE doc_id % 6 WHEN 0 THEN 'Sex: Female' WHEN 1 THEN 'Gender: M' WHEN 2 THEN 'M/45'
                  WHEN 3 THEN 'a male patient' ELSE '' END, chr(13), chr(10), chr(10), chr(10), chr(10),
  CASE doc_id % 3 WHEN 0 THEN concat('Clinical   Indication: ', lang, ' cough and fever')
                  WHEN 1 THEN 'Chief complaint: chest pain on exertion' ELSE 'History: none' END,
  chr(10), chr(10),
  CASE doc_id % 7 WHEN 0 THEN '' ELSE concat('Finding:   ', text) END, chr(10), chr(10),
  CASE doc_id % 8 WHEN 0 THEN 'Impression: ok' WHEN 1 THEN ''
                  ELSE concat('Impression: stable, source ', source, chr(10), chr(10), 'Recommendations: none') END)"""

_STRIP = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def clean_sql(text: str) -> str:
    """The cleaning chain in the oracle's dialect."""
    out = text
    for pattern, to in [
        (r"\r\n?", r"\n"),
        (r"[ \t]+", " "),
        (r" +\n", r"\n"),
        (r"\n{3,}", r"\n\n"),
        (rf"^{_STRIP}+|{_STRIP}+$", ""),
        (r"[^\x20-\x7E\n\t]", ""),
        (r"(?i)\bCLINICAL\s+INDICATION\b", "CLINICAL INDICATION"),
        (r"(?i)\bINDICATION\b", "INDICATION"),
        (r"(?i)\bFINDINGS?\b", "FINDINGS"),
        (r"(?i)\bIMPRESSION\b", "IMPRESSION"),
        (r"(?i)\bCONCLUSION\b", "CONCLUSION"),
    ]:
        replacement = {r"\n": "chr(10)", r"\n\n": "chr(10) || chr(10)"}.get(to, f"'{to}'")
        out = f"regexp_replace({out}, '{pattern}', {replacement}, 'g')"
    return out


# Typographic characters, CRLF and prose that names a section, around every document.
DECORATED = "concat('“', text, '”', chr(13), chr(10), '   no significant findings   ', chr(10), '°')"


@query(
    "q_clean_text",
    f"""SELECT doc_id, md5(c) AS clean_md5, CAST(length(c) AS INTEGER) AS n
        FROM (SELECT doc_id, {clean_sql(DECORATED)} AS c FROM documents)""",
)
def clean_documents(spark, sf):
    return (
        table(spark, sf, "documents", ["doc_id", "text"])
        .select("doc_id", clean_text(F.expr(DECORATED)).alias("c"))
        .select("doc_id", F.md5("c").alias("clean_md5"), F.length("c").alias("n"))
    )


@query(
    "q_clean_pages",
    f"""SELECT page_id, md5(c) AS clean_md5, CAST(length(c) AS INTEGER) AS n
        FROM (SELECT page_id, {clean_sql('html')} AS c FROM pages)""",
)
def clean_pages(spark, sf):
    return (
        table(spark, sf, "pages", ["page_id", "html"])
        .select("page_id", clean_text(F.col("html")).alias("c"))
        .select("page_id", F.md5("c").alias("clean_md5"), F.length("c").alias("n"))
    )


@query(
    "q_clean_preserve",
    f"""SELECT doc_id, md5(c) AS clean_md5 FROM (SELECT doc_id, {clean_sql(
        '''replace(translate(''' + DECORATED + ''', '‘’“”—–', chr(39) || chr(39) || '""--'), '…', '...')''')} AS c
        FROM documents)""",
)
def clean_preserve(spark, sf):
    return table(spark, sf, "documents", ["doc_id", "text"]).select(
        "doc_id", F.md5(clean_text(F.expr(DECORATED), punctuation="preserve")).alias("clean_md5")
    )


@query(
    "q_short_rejects",
    f"""SELECT doc_id, CAST(length(c) AS INTEGER) AS clean_length
        FROM (SELECT doc_id, {clean_sql('text')} AS c FROM documents) WHERE length(c) < 50""",
)
def short_rejects(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "text"]).withColumnRenamed("text", "raw_text")
    _, rejected = reports.split_rejects(reports.clean_reports(docs))
    return rejected.select("doc_id", F.length("clean_text").alias("clean_length"))


_LATIN = r"regexp_replace(text, '[^\x{1}-\x{ff}]', '?', 'g')"


@query("q_decode_fallback", f"SELECT doc_id, md5({_LATIN}) AS text_md5 FROM documents")
def decode_fallback(spark, sf):
    """English documents stored as UTF-8 bytes, the others as Latin-1."""
    docs = table(spark, sf, "documents").withColumn(
        "text", F.regexp_replace("text", r"[^\x01-\xff]", "?")
    )
    content = F.when(F.col("lang") == "en", F.encode("text", "UTF-8")).otherwise(
        F.encode("text", "ISO-8859-1")
    )
    return docs.select("doc_id", F.md5(decode_bytes(content)).alias("text_md5"))


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", ["doc_id", "text", "lang", "source"])
    return docs.select("doc_id", F.expr(RAW_REPORT).alias("raw_text"))


def _structured(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = _raw(spark, sf)
    return raw, reports.structure_reports(reports.clean_reports(raw), stamp=False)


def _squeeze(expr: str) -> str:
    return rf"trim(regexp_replace({expr}, '\s+', ' ', 'g'))"


def _take(pattern: str, flags: str) -> str:
    return f"regexp_extract(c, '(?{flags}){pattern}', 1)"


# Short names of the fields' captures in SQL; those that may span lines are trimmed to single blanks.
_SHORT = {"patient_id": "pid", "age": "age", "sex": "sex", "symptoms": "sym", "findings": "fin", "impression": "imp"}


def _captures() -> str:
    """Every pattern's first group as a column of SQL, numbered per field.

    The SQL engine has no lookahead: the terminator is consumed instead, and the group is the same.
    """
    columns = {}
    for field, patterns in reports.PATTERNS.items():
        for number, pattern in enumerate(patterns, 1):
            spans = field in reports.TEXT_LIMITS
            flags = "is" if spans else "i"
            found = _take(pattern.replace("(?=", "(?:"), flags)
            columns[f"{_SHORT[field]}{number}"] = _squeeze(found) if spans else found
    columns["casen"] = _take(reports.CASE_FALLBACK, "i")
    return ",\n".join(f"{sql} AS {name}" for name, sql in columns.items())


def _first_long(field: str) -> str:
    """The first capture of a text field that is long enough, cut to its longest length."""
    least, most = reports.TEXT_LIMITS[field]
    tries = [f"{_SHORT[field]}{n}" for n in range(1, len(reports.PATTERNS[field]) + 1)]
    return "CASE " + " ".join(f"WHEN length({c}) > {least} THEN substr({c}, 1, {most})" for c in tries) + f" END AS {field}"


_FIELDS_SQL = f"""
raw AS (SELECT doc_id, {RAW_REPORT} AS t FROM documents),
cleaned AS (SELECT doc_id, {clean_sql('t')} AS c FROM raw),
captured AS (SELECT doc_id, {_captures()} FROM cleaned WHERE length(c) >= 50),
fields AS (SELECT doc_id,
  coalesce(nullif(pid1, ''), nullif(pid2, ''), 'CASE_' || nullif(casen, '')) AS patient_id,
  CASE WHEN try_cast(age1 AS INTEGER) BETWEEN 0 AND {reports.MAX_AGE} THEN try_cast(age1 AS INTEGER)
       WHEN try_cast(age2 AS INTEGER) BETWEEN 0 AND {reports.MAX_AGE} THEN try_cast(age2 AS INTEGER) END AS age,
  upper(substr(coalesce(nullif(sex1, ''), nullif(sex2, ''), nullif(sex3, '')), 1, 1)) AS sex,
  {_first_long("symptoms")},
  {_first_long("findings")},
  {_first_long("impression")}
  FROM captured),
scored AS (SELECT *, ((patient_id IS NOT NULL)::INT + (age IS NOT NULL)::INT + (sex IS NOT NULL)::INT
  + (symptoms IS NOT NULL)::INT + (findings IS NOT NULL)::INT + (impression IS NOT NULL)::INT) / 6.0 AS confidence
  FROM fields),
validated AS (SELECT *,
  list_filter([CASE WHEN coalesce(trim(patient_id), '') = '' THEN 'patient_id' END,
               CASE WHEN coalesce(trim(findings), '') = '' THEN 'findings' END], lambda x: x IS NOT NULL) AS missing,
  list_filter([CASE WHEN coalesce(age, 0) = 0 THEN 'Optional field ''age'' not extracted' END,
               CASE WHEN sex IS NULL THEN 'Optional field ''sex'' not extracted' END,
               CASE WHEN symptoms IS NULL THEN 'Optional field ''symptoms'' not extracted' END,
               CASE WHEN impression IS NULL THEN 'Optional field ''impression'' not extracted' END,
               CASE WHEN length(findings) < 50 THEN 'Findings section seems unusually short' END,
               CASE WHEN confidence < 0.4 THEN printf('Low extraction confidence: %.1f%%', CAST(confidence * 100 AS DOUBLE)) END],
              lambda x: x IS NOT NULL) AS warn FROM scored)"""


@query(
    "q_extract_fields",
    f"WITH {_FIELDS_SQL} SELECT doc_id, patient_id, age, sex, symptoms, findings, impression FROM fields",
)
def extract_fields(spark, sf):
    return _structured(spark, sf)[1].select("doc_id", *reports.FIELDS)


@query(
    "q_extract_confidence",
    f"WITH {_FIELDS_SQL} SELECT doc_id, round(CAST(confidence AS DOUBLE), 6) AS confidence FROM scored",
)
def extract_confidence(spark, sf):
    return _structured(spark, sf)[1].select(
        "doc_id", F.round("extraction_confidence", 6).alias("confidence")
    )


@query(
    "q_validate_reports",
    f"""WITH {_FIELDS_SQL} SELECT doc_id, len(missing) = 0 AS is_valid,
        array_to_string(missing, '|') AS missing_fields, array_to_string(warn, '|') AS warnings FROM validated""",
)
def validate_reports(spark, sf):
    return _structured(spark, sf)[1].select(
        "doc_id",
        "is_valid",
        F.array_join("missing_fields", "|").alias("missing_fields"),
        F.array_join("warnings", "|").alias("warnings"),
    )


_TOTALS = """totals AS (SELECT count(*) AS total FROM documents),
counts AS (SELECT count(*) AS processed, coalesce(sum(confidence), 0) AS conf,
   count(patient_id) AS patient_id, count(*) FILTER (WHERE age <> 0) AS age, count(sex) AS sex,
   count(symptoms) AS symptoms, count(findings) AS findings, count(impression) AS impression FROM scored)"""


@query(
    "q_report_summary",
    f"""WITH {_FIELDS_SQL}, {_TOTALS}
    SELECT total AS total_reports, processed AS processed_successfully, total - processed AS failed,
           round(CAST(conf AS DOUBLE) / total, 6) AS average_confidence FROM counts, totals""",
)
def report_summary(spark, sf):
    summary = reports.report_summary(*_structured(spark, sf))
    return summary.select(
        "total_reports",
        "processed_successfully",
        "failed",
        F.round("average_confidence", 6).alias("average_confidence"),
    )


@query(
    "q_field_rates",
    f"""WITH {_FIELDS_SQL}, {_TOTALS}, long AS (
      UNPIVOT (SELECT patient_id, age, sex, symptoms, findings, impression FROM counts)
      ON COLUMNS(*) INTO NAME field VALUE extracted)
    SELECT field, extracted, round(extracted * 100.0 / total, 6) AS rate_pct FROM long, totals""",
)
def field_rates(spark, sf):
    rates = reports.field_rates(reports.report_summary(*_structured(spark, sf)))
    return rates.withColumn("rate_pct", F.round("rate_pct", 6))


@query(
    "q_failed_reports",
    f"""WITH {_FIELDS_SQL}
    SELECT string_agg(p, ',' ORDER BY p) AS failed_paths FROM (
      SELECT 'bronze/reports/' || doc_id || '.txt' AS p FROM
        (SELECT doc_id, {clean_sql('text')} AS c FROM documents) WHERE length(c) < 50 ORDER BY p LIMIT 10)""",
)
def failed_reports(spark, sf):
    from medlake.operators.summaries import first_failures

    docs = table(spark, sf, "documents", ["doc_id", "text"]).select(
        F.concat(F.lit("bronze/reports/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.col("text").alias("raw_text"),
    )
    _, rejected = reports.split_rejects(reports.clean_reports(docs))
    return first_failures(rejected).select(F.array_join("failed_paths", ",").alias("failed_paths"))
