import pytest

from medlake.operators import reports

FILLER = " Lungs were looked at in two views and nothing else was noted by the reader."


def extract(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, clean_text string")
    return [r.asDict() for r in reports.extract_fields(df).orderBy("i").collect()]


@pytest.mark.parametrize("field,cases", {
    "patient_id": [
        ("Patient ID: P-77", "P-77"),
        ("MRN: AB-12", "AB-12"),
        ("Patient presents", "presents"),
        ("case-7 seen", "-7"),
        ("in case of fire", "of"),
        ("medical record number 5_x", "5_x"),
        ("nobody here", None),
    ],
    "age": [
        ("Age: 0", 0),
        ("Age: 120", 120),
        ("Age: 121", None),
        ("Age: 121, later 45yo", 45),
        ("45yo", 45),
        ("image 12", 12),
        ("30 years old", 30),
        ("none", None),
    ],
    "sex": [
        ("Sex: Female", "F"),
        ("Gender = m", "M"),
        ("F", None),
        ("seen M/45", "M"),
        ("a female reader", "F"),
        ("unknown", None),
    ],
    "symptoms": [
        ("History: 0123456789\n\n", None),
        ("History: 0123456789a\n\n", "0123456789a"),
        ("Symptoms: fever and\ncough", None),
        ("Indication: " + "c" * 600, "c" * 500),
        ("CC: pain in the  chest", "pain in the chest"),
        ("History: short\n\nChief complaint: pain in the chest", "pain in the chest"),
    ],
    "findings": [
        ("Findings: " + "x" * 20, None),
        ("Findings: " + "x" * 21, "x" * 21),
        ("Observation: " + "y" * 2100 + " Impression: z", "y" * 2000),
        ("Findings: line one here\nand line two impression: n", "line one here and line two"),
    ],
    "impression": [
        ("Impression: 12345", None),
        ("Impression: 123456", "123456"),
        ("Conclusion: fine now\n\nmore", "fine now"),
        ("Diagnosis: fine now Recommendations: rest", "fine now"),
        ("Impression: " + "i" * 1200, "i" * 1000),
    ],
}.items())
def test_field_edges(spark, field, cases):
    got = [row[field] for row in extract(spark, [c for c, _ in cases])]
    assert got == [want for _, want in cases]


def test_confidence_counts_fields(spark):
    full = (
        "Patient ID: 9\nAge: 50\nSex: M\n\nIndication: cough for a week\n\n"
        "FINDINGS: both lungs are clear and open\n\nIMPRESSION: normal film"
    )
    rows = extract(spark, [full, "nothing"])
    assert rows[0]["extraction_confidence"] == 1.0
    assert rows[1]["extraction_confidence"] == 0.0


def test_validation(spark):
    rows = [
        (0, "p", 40, "M", "s" * 11, "f" * 50, "ok then", 1.0),
        (1, "p", 0, "M", None, "f" * 49, None, 0.5),
        (2, None, None, None, None, None, None, 2 / 6),
    ]
    schema = (
        "i int, patient_id string, age int, sex string, symptoms string, findings string, "
        "impression string, extraction_confidence double"
    )
    got = reports.validate_reports(spark.createDataFrame(rows, schema)).orderBy("i").collect()
    assert [r.is_valid for r in got] == [True, True, False]
    assert got[0].warnings == [] and got[0].missing_fields == []
    assert got[1].warnings == [
        "Optional field 'age' not extracted",
        "Optional field 'symptoms' not extracted",
        "Optional field 'impression' not extracted",
        "Findings section seems unusually short",
    ]
    assert got[2].missing_fields == ["patient_id", "findings"]
    assert got[2].warnings[-1] == "Low extraction confidence: 33.3%"


def test_summary_divides_by_all_reports(spark):
    texts = ["Patient ID: 1 Age: 0." + FILLER, "too short", "Sex: F." + FILLER, None]
    raw = spark.createDataFrame(list(enumerate(texts)), "i int, raw_text string")
    structured = reports.structure_reports(reports.clean_reports(raw))
    summary = reports.report_summary(raw, structured).first()
    assert (summary.total_reports, summary.processed_successfully, summary.failed) == (4, 2, 2)
    # id and age 0 count for the confidence; age 0 does not count as extracted.
    assert summary.average_confidence == pytest.approx((2 / 6 + 1 / 6) / 4)
    assert summary.field_extraction_stats["age"] == 0
    assert summary.field_extraction_stats["patient_id"] == 1
    rates = {r.field: r.rate_pct for r in reports.field_rates(reports.report_summary(raw, structured)).collect()}
    assert rates["sex"] == 25.0 and rates["patient_id"] == 25.0


def test_invalid_reports_are_kept(spark):
    raw = spark.createDataFrame([(0, "x" + FILLER)], "i int, raw_text string")
    row = reports.structure_reports(reports.clean_reports(raw)).first()
    assert not row.is_valid and row.raw_text.startswith("x Lungs")
    assert row.processing_timestamp is not None


def test_cleaning_is_planned_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("text", "raw_text")
    structured = reports.structure_reports(reports.clean_reports(docs.select("doc_id", "raw_text")))
    plan = structured._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CLINICAL INDICATION, 1)") == 1
