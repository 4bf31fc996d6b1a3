"""Structured fields from report text, their validation and the run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlake.functions.text import clean_text, collapse_space, long_enough

FIELDS = ["patient_id", "age", "sex", "symptoms", "findings", "impression"]
REQUIRED_FIELDS = ["patient_id", "findings"]
OPTIONAL_FIELDS = ["age", "sex", "symptoms", "impression"]

# Search patterns per field, tried in order, case-insensitive; the last three
# fields let the dot match newlines.
PATTERNS = {
    "patient_id": [
        r"(?:Patient\s*(?:ID|#|Number)?|MRN|Medical\s*Record\s*(?:Number|#)?)\s*[:=]?\s*([A-Za-z0-9_-]+)",
        r"(?:Case\s*(?:ID|#)?)\s*[:=]?\s*([A-Za-z0-9_-]+)",
    ],
    "age": [
        r"(?:Age|AGE)\s*[:=]?\s*(\d{1,3})\s*(?:years?|yrs?|y\.?o\.?|y/o)?",
        r"(\d{1,3})\s*(?:years?\s*old|yo|y\.?o\.?|y/o)",
    ],
    "sex": [
        r"(?:Sex|Gender)\s*[:=]?\s*(Male|Female|M|F)\b",
        r"\b(Male|Female)\b",
        r"\b([MF])/\d{1,3}\b",
    ],
    "symptoms": [
        r"(?:Clinical\s*)?(?:Indication|History|Symptoms?|Presenting\s*Complaint|Reason\s*for\s*(?:Study|Exam))\s*[:=]?\s*(.+?)(?=\n\n|\n[A-Z]|Findings?:|Impression:|$)",
        r"(?:Chief\s*Complaint|CC)\s*[:=]?\s*(.+?)(?=\n\n|\n[A-Z]|$)",
    ],
    "findings": [
        r"(?:Findings?|Observations?|Description)\s*[:=]?\s*(.+?)(?=Impression|Conclusion|Diagnosis|Assessment|$)",
        r"(?:Radiological\s*)?(?:Findings?)\s*[:=]?\s*(.+?)(?=\n\n[A-Z]|$)",
    ],
    "impression": [
        r"(?:Impression|Conclusion|Diagnosis|Assessment|Final\s*Diagnosis)\s*[:=]?\s*(.+?)(?=\n\n|Recommendations?:|$)",
        r"(?:Clinical\s*)?(?:Impression|Interpretation)\s*[:=]?\s*(.+)",
    ],
}
CASE_FALLBACK = r"case[_-]?(\d+)"
# Shortest length not accepted and longest length kept.
TEXT_LIMITS = {"symptoms": (10, 500), "findings": (20, 2000), "impression": (5, 1000)}
MAX_AGE = 120
SHORT_FINDINGS = 50
LOW_CONFIDENCE = 0.4
# Warning texts.
OPTIONAL_WARNING = "Optional field '{}' not extracted"
SHORT_WARNING = "Findings section seems unusually short"
CONFIDENCE_WARNING = "Low extraction confidence: %.1f%%"
NO_TEXT = "no text"
SHORT_TEXT = "too short after cleaning"


def _accepted(field: str, found: Column) -> Column:
    """The value of a capture, or null where the field's own test rejects it.

    ``found`` is ``''`` where the pattern did not match.
    """
    if field == "age":
        years = found.try_cast("int")
        return F.when(years.between(0, MAX_AGE), years)
    if field == "sex":
        return F.when(found != "", F.upper(F.substring(found, 1, 1)))
    if field in TEXT_LIMITS:
        shortest, longest = TEXT_LIMITS[field]
        return F.when(F.length(found) > shortest, F.substring(found, 1, longest))
    return F.when(found != "", found)


def extract_fields(df: DataFrame, text_col: str = "clean_text") -> DataFrame:
    """Append the six fields and ``extraction_confidence``.

    Each round tries one pattern per field that is still empty. Captures and accepted
    values live in separate projections, so no regular expression is evaluated twice
    and later patterns run only on rows the earlier ones left open.
    """
    text = F.col(text_col)
    rounds = max(len(p) for p in PATTERNS.values())
    for attempt in range(rounds):
        captures, values = {}, {}
        for field in FIELDS:
            if attempt >= len(PATTERNS[field]):
                continue
            flags = "(?is)" if field in TEXT_LIMITS else "(?i)"
            found = F.regexp_extract(text, flags + PATTERNS[field][attempt], 1)
            if field in TEXT_LIMITS:
                found = collapse_space(found)
            accepted = _accepted(field, F.col(f"__{field}"))
            if attempt:
                found = F.when(F.col(field).isNull(), found).otherwise(F.lit(""))
                accepted = F.coalesce(F.col(field), accepted)
            captures[f"__{field}"] = found
            values[field] = accepted
        df = df.withColumns(captures).withColumns(values).drop(*captures)
    number = F.regexp_extract(text, f"(?i){CASE_FALLBACK}", 1)
    df = df.withColumn(
        "patient_id",
        F.coalesce("patient_id", F.concat(F.lit("CASE_"), F.nullif(number, F.lit("")))),
    )
    present = sum((F.col(f).isNotNull().cast("int") for f in FIELDS), F.lit(0))
    return df.withColumn("extraction_confidence", present / F.lit(float(len(FIELDS))))


def _is_blank(field: str) -> Column:
    """True for null, and for the values that count as absent (blank text, age 0)."""
    value = F.col(field)
    if field == "age":
        return value.isNull() | (value == 0)
    return value.isNull() | (F.trim(value) == "")


def validate_reports(df: DataFrame) -> DataFrame:
    """Append ``is_valid``, ``missing_fields`` and ``warnings``; no row is dropped."""
    missing = F.array_compact(
        F.array(*[F.when(_is_blank(f), F.lit(f)) for f in REQUIRED_FIELDS])
    )
    confidence = F.col("extraction_confidence")
    warnings = [
        F.when(_is_blank(f), F.lit(OPTIONAL_WARNING.format(f))) for f in OPTIONAL_FIELDS
    ]
    warnings.append(F.when(F.length("findings") < SHORT_FINDINGS, F.lit(SHORT_WARNING)))
    warnings.append(
        F.when(
            confidence < LOW_CONFIDENCE, F.format_string(CONFIDENCE_WARNING, confidence * 100)
        )
    )
    return df.withColumns(
        {"missing_fields": missing, "warnings": F.array_compact(F.array(*warnings))}
    ).withColumn("is_valid", F.size("missing_fields") == 0)


def clean_reports(df: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """Append ``clean_text`` and ``accepted`` (long enough after cleaning, text present).

    The cleaned text comes out of a one-row generator: filters on it stay above, whereas
    a plain projection would have them pushed below and the whole chain evaluated twice.
    """
    cleaned = df.select("*", F.explode(F.array(clean_text(F.col(text_col)))).alias("clean_text"))
    return cleaned.withColumn(
        "accepted", F.col(text_col).isNotNull() & long_enough(F.col("clean_text"))
    )


def reject_reason(text: Column) -> Column:
    """Why a report that was not accepted was not."""
    return F.when(text.isNull(), F.lit(NO_TEXT)).otherwise(F.lit(SHORT_TEXT))


def split_rejects(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows) of :func:`clean_reports`."""
    return (
        cleaned.where("accepted").drop("accepted"),
        cleaned.where("NOT accepted").drop("accepted"),
    )


def structure_reports(cleaned: DataFrame, stamp: bool = True) -> DataFrame:
    """Accepted rows -> structured report rows: fields, raw text, confidence, validation."""
    accepted, _ = split_rejects(cleaned)
    out = validate_reports(extract_fields(accepted, "clean_text"))
    out = out.drop("raw_text").withColumnRenamed("clean_text", "raw_text")
    return out.withColumn("processing_timestamp", F.current_timestamp()) if stamp else out


def report_summary(raw: DataFrame, structured: DataFrame) -> DataFrame:
    """One row over the run: totals, per-field counts, average confidence over *all* reports.

    ``raw`` holds every report, rejected ones included; only its rows are counted.
    """
    totals = raw.agg(F.count(F.lit(1)).alias("total_reports"))
    done = structured.agg(
        F.count(F.lit(1)).alias("processed_successfully"),
        F.coalesce(F.sum("extraction_confidence"), F.lit(0.0)).alias("confidence_sum"),
        *[F.count_if(~_is_blank(f)).alias(f"n_{f}") for f in FIELDS],
    )
    total = totals.scalar()
    return done.select(
        total.alias("total_reports"),
        "processed_successfully",
        (total - F.col("processed_successfully")).alias("failed"),
        F.coalesce(F.try_divide("confidence_sum", total), F.lit(0.0)).alias("average_confidence"),
        F.create_map(*[x for f in FIELDS for x in (F.lit(f), F.col(f"n_{f}"))]).alias(
            "field_extraction_stats"
        ),
    )


def field_rates(summary: DataFrame) -> DataFrame:
    """Long form of a summary: field, count, percent of all reports."""
    return summary.select(
        "total_reports", F.explode("field_extraction_stats").alias("field", "extracted")
    ).select(
        "field",
        "extracted",
        F.coalesce(F.try_divide(F.col("extracted") * 100.0, "total_reports"), F.lit(0.0)).alias(
            "rate_pct"
        ),
    )
