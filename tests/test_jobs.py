import json

from png import png

from medlake.plans import jobs
from medlake.sources.tables import VITALS_COLUMNS
from medlake.streaming import jobs as streaming
from pyspark.sql import functions as F

def build_lake(spark, root, n=6, images=True):
    for folder in ("reports", "structured", "images"):
        (root / folder).mkdir(parents=True)
    lines = [",".join(VITALS_COLUMNS)]
    for i in range(n):
        text = (
            f"Patient ID: PAT{i:05d}\nAge: {40 + i}\nSex: Female\nSymptoms: cough and fever for three days\n"
            "Findings: clear lungs and a heart of usual size\nImpression: nothing that needs treatment now\n"
        )
        (root / "reports" / f"case_{i}_report.txt").write_text(text, encoding="utf-8")
        (root / "images" / f"case_{i}.png").write_bytes(png([bytes([90]) * 64] * 64, 64))
        lines.append(f"PAT{i:05d},{40 + i},Female,98.{i},80,16,120/80,97,7.5,4.0,none,case_{i}.png,case_{i}_report.txt")
    (root / "structured" / "patient_vitals.csv").write_text("\n".join(lines))


def test_a_broken_stage_leaves_the_others(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", tmp_path / "silver"
    build_lake(spark, bronze)
    report = jobs.run_all(spark, str(bronze).replace("bronze", "none"), str(silver), vitals=False).first()
    assert not report.overall_success and len(report.errors) == 2
    (bronze / "images").rename(bronze / "pictures")
    row = jobs.run_all(spark, str(bronze), str(silver)).first()
    assert not row.overall_success and len(row.errors) == 1 and row.errors[0].startswith("Image processing: ")
    assert row.reports_summary.processed_successfully == 6 and row.vitals_summary.table_rows_loaded == 6
    assert set(row.stage_seconds) == {"image", "report", "vitals"}


def test_whole_run(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", tmp_path / "silver"
    build_lake(spark, bronze)
    keys = spark.createDataFrame([("silver/reports/a",)], "path string")
    report = jobs.run_all(spark, str(bronze), str(silver), str(tmp_path / "runs"), silver_keys=keys)
    row = report.first()
    assert row.overall_success and row.errors == []
    assert row.images_summary.processed_successfully == 6
    assert row.reports_summary.processed_successfully == 6 and row.reports_summary.average_confidence == 1.0
    assert row.vitals_summary.table_rows_loaded == 6 and row.vitals_summary.silver_csv_uploaded
    assert row.vitals_summary.data_quality.imputed_values == 0
    assert row.bucket_structure["silver/reports/"] == ["a"]
    assert row.total_duration_seconds > 0
    assert spark.read.json(f"{silver}/reports").count() == 6
    vitals = spark.read.parquet(f"{silver}/structured/vitals")
    assert {"fever_flag", "abnormal_vital_count", "wbc_imputed", "processing_timestamp"} <= set(vitals.columns)
    saved = spark.read.json(str(tmp_path / "runs")).first()
    assert saved.overall_success and json.dumps(saved.run_at)


def test_failures_are_reported(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", tmp_path / "silver"
    build_lake(spark, bronze, 3)
    (bronze / "reports" / "bad.txt").write_text("too short")
    (bronze / "images" / "bad.png").write_bytes(b"no image")
    (bronze / "structured" / "patient_vitals.csv").unlink()
    row = jobs.run_all(spark, str(bronze), str(silver)).first()
    assert row.errors == [
        "Image processing: 1 failures",
        "Report processing: 1 failures",
        "Vitals processing: Failed to save output",
    ]
    assert row.reports_summary.failed_reports[0].endswith("bad.txt")
    assert row.reports_summary.average_confidence == 3 / 4


def test_vitals_compat_schema(spark, tmp_path):
    df = spark.createDataFrame(
        [("p1", 99.0, "120/80"), ("p2", 300.0, "x")], "patient_id string, temperature double, blood_pressure string"
    )
    row = jobs.vitals_job(df, str(tmp_path / "t"), str(tmp_path / "c"), compat_schema=True).first()
    table = spark.read.parquet(str(tmp_path / "t"))
    assert "temperature_imputed" in table.columns and "bp_systolic_imputed" in table.columns
    assert row.data_quality.imputed_values == 3 and row.data_quality.rows_with_outliers == 1
    got = {r.patient_id: r.temperature for r in table.collect()}
    assert got == {"p1": 99.0, "p2": 99.0}


def test_report_stream_equals_batch(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", str(tmp_path / "silver")
    build_lake(spark, bronze, 4)

    def advance():
        stream = streaming.report_stream(spark, str(bronze / "reports"), max_files=3)
        streaming.structure_stream(stream, silver, str(tmp_path / "ck")).awaitTermination()
        return spark.read.parquet(silver)

    assert advance().count() == 4
    (bronze / "reports" / "late_report.txt").write_text(
        "Patient ID: late\nFindings: " + "a new opacity in the left base of the lung" + "\n"
    )
    (bronze / "reports" / "tiny_report.txt").write_text("ok")
    after = advance()
    assert after.count() == 5 and advance().count() == 5
    rejected = spark.read.parquet(silver + "_rejected").select("path", "reason").collect()
    assert [(r.path.rsplit("/", 1)[1], r.reason) for r in rejected] == [("tiny_report.txt", "too short after cleaning")]
    from medlake.operators.reports import clean_reports, structure_reports
    from medlake.sources.lake import read_reports

    batch = structure_reports(clean_reports(read_reports(spark, str(bronze / "reports"))))
    columns = ["path", "patient_id", "age", "sex", "findings", "is_valid"]
    assert sorted(map(str, after.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))


def test_vector_stream_upserts(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    schema = "id bigint, embedding array<float>, version int, at timestamp"

    def deliver(rows):
        values = [(i, [float(x)], v) for i, x, v in rows]
        df = spark.createDataFrame(values, "id bigint, embedding array<float>, version int")
        df.withColumn("at", F.to_timestamp(F.lit("2024-01-01 00:00:00"))).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streaming.upsert_stream(stream.drop("at"), log, str(tmp_path / "ck")).awaitTermination()
        return {r.id: r.embedding[0] for r in streaming.read_latest(spark, log).collect()}

    assert deliver([(1, 1, 1), (1, 2, 2), (2, 5, 1)]) == {1: 2.0, 2: 5.0}
    assert deliver([(1, 0, 1), (2, 6, 2), (3, 9, 1)]) == {1: 2.0, 2: 6.0, 3: 9.0}
    streaming.compact(spark, log)
    assert deliver([(3, 4, 0), (4, 7, 1)]) == {1: 2.0, 2: 6.0, 3: 9.0, 4: 7.0}


def test_repeated_deliveries_are_dropped(spark, tmp_path):
    rows = [(1, [1.0], 1), (1, [1.0], 1), (2, [2.0], 1)]
    df = spark.createDataFrame(rows, "id bigint, embedding array<float>, version int")
    df.withColumn("at", F.to_timestamp(F.lit("2024-01-01 00:00:00"))).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint, embedding array<float>, version int, at timestamp").parquet(
        str(tmp_path / "in")
    )
    streaming.upsert_stream(stream, str(tmp_path / "log"), str(tmp_path / "ck"), event_time="at").awaitTermination()
    assert streaming.read_latest(spark, str(tmp_path / "log")).count() == 2


def test_rejected_reports_are_stored(spark, tmp_path):
    from medlake.plans.jobs import reports_job

    long = "Patient ID: p1\nAge: 40\nFindings: a new opacity in the left base of the lung\n"
    raw = spark.createDataFrame([("a.txt", long), ("b.txt", "short"), ("c.txt", None)], "path string, raw_text string")
    row = reports_job(raw, str(tmp_path / "silver")).first()
    assert (row.total_reports, row.processed_successfully, row.failed) == (3, 1, 2)
    assert list(row.failed_reports) == ["b.txt", "c.txt"]
    stored = spark.read.parquet(str(tmp_path / "silver_rejected")).orderBy("path").collect()
    assert [(r.path, r.reason) for r in stored] == [("b.txt", "too short after cleaning"), ("c.txt", "no text")]
