import pytest
from pyspark.sql import functions as F

from medlake.sources import lake, tables


@pytest.fixture()
def files(tmp_path):
    root = tmp_path / "raw dir"
    for name, body in {
        "images/a.JPG": b"1234",
        "images/deep/b.png": b"12",
        "images/.hidden.png": b"x",
        "images/c.gif": b"x",
        "reports/r1_report.txt": "Größe".encode(),
        "reports/r2.text": "Größe".encode("latin-1"),
        "reports/r3.pdf": b"%PDF",
    }.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    return str(root)


def test_inventory_and_listing(spark, files):
    objects = lake.with_relative_path(lake.inventory(spark, files), files)
    images = lake.list_objects(objects, "images/", lake.IMAGE_EXTENSIONS, path="rel_path")
    assert [r.rel_path for r in images.collect()] == ["images/a.JPG", "images/deep/b.png"]
    assert lake.list_objects(objects, "", None, 1, path="rel_path").count() == 1
    children = lake.child_prefixes(objects, "images/", path="rel_path").collect()
    assert [r.prefix for r in children] == ["images/deep/"]
    plan = objects._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_report_source_decodes(spark, files):
    rows = {lake_name(r.path): r.raw_text for r in lake.read_reports(spark, files + "/reports").collect()}
    assert rows == {"r1_report.txt": "Größe", "r2.text": "Größe"}


def lake_name(path):
    return path.rsplit("/", 1)[1]


def test_ingest_directory(spark, files, tmp_path):
    bronze = str(tmp_path / "bronze")
    keys = lake.ingest_directory(
        spark, files + "/images", bronze, "bronze/images/", "images", lake.INGEST_IMAGE_EXTENSIONS
    )
    assert sorted(r.object_key for r in keys.collect()) == ["bronze/images/a.JPG", "bronze/images/deep/b.png"]
    lake.ingest_directory(spark, files + "/reports", bronze, "bronze/reports", "reports", [".TXT", ".pdf"])
    again = lake.ingest_directory(spark, files + "/images", bronze, "bronze/images", "images", [".png"])
    assert again.count() == 1
    assert spark.read.parquet(bronze).count() == 3
    with pytest.raises(FileNotFoundError):
        lake.read_directory(spark, files + "/nowhere", "x")
    with pytest.raises(NotADirectoryError):
        lake.read_directory(spark, files + "/images/a.JPG", "x")


def test_many_small_files_share_tasks(spark, tmp_path):
    for i in range(1_300):
        (tmp_path / f"{i}.txt").write_text(str(i))
    # 32 files in a task, if nothing puts them together.
    found = lake.read_directory(spark, str(tmp_path), "bronze")
    assert found.rdd.getNumPartitions() == 16 and lake.inventory(spark, str(tmp_path)).rdd.getNumPartitions() == 16
    assert {(r.object_key, bytes(r.content)) for r in found.collect()} == {(f"bronze/{i}.txt", str(i).encode()) for i in range(1_300)}
    one = tmp_path / "one"
    one.mkdir()
    assert lake.read_directory(spark, str(one), "bronze").count() == 0
    (one / "a.txt").write_text("a")
    assert lake.read_reports(spark, str(one)).collect()[0].raw_text == "a"


def test_metadata_lookup(spark, files):
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(files)
    one = content.where(F.col("path").endswith("a.JPG")).select("path")
    row = lake.get_metadata(content, one).first()
    assert (row["size"], row.content_type) == (4, "image/jpeg")
    assert row.md5_hash == "81dc9bdb52d04dc20036dbd8313ed055"
    with pytest.raises(FileNotFoundError):
        lake.get_metadata(content, spark.createDataFrame([("nope",)], "path string"))


def test_names(spark):
    cases = ["a/b/case_1_report.txt", "x.tar.GZ", "noext", ".hidden", "d.ir/file"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, path string")
    rows = df.orderBy("i").select(
        lake.suffix(F.col("path")).alias("s"), lake.stem(F.col("path")).alias("t"),
        lake.report_key(F.col("path")).alias("k"),
    ).collect()
    assert [r.s for r in rows] == [".txt", ".gz", "", "", ""]
    assert [r.t for r in rows] == ["case_1_report", "x.tar", "noext", ".hidden", "file"]
    assert rows[0].k == "case_1_structured"


def test_sizes(spark):
    sizes = [0, 1023, 1024, 1536, 1024**2, 5 * 1024**3, 3 * 1024**4, 5000 * 1024**4, 1280]
    df = spark.createDataFrame(list(enumerate(sizes)), "i int, n bigint").orderBy("i")
    got = [r[0] for r in df.select(lake.format_size(F.col("n"))).collect()]
    assert got == ["0.0 B", "1023.0 B", "1.0 KB", "1.5 KB", "1.0 MB", "5.0 GB", "3.0 TB", "5000.0 TB", "1.2 KB"]


def test_verify_and_structure(spark):
    names = [f"silver/images/{i:02d}" for i in range(7)] + ["silver/images/", "silver/reports/x", "gold/y"]
    objects = spark.createDataFrame([(n,) for n in names], "path string")
    counts = {r.prefix: r.objects for r in lake.verify_counts(objects, lake.SILVER_PREFIXES).collect()}
    assert counts == {"silver/images/": 8, "silver/reports/": 1, "silver/structured/": 0}
    rows = {r.prefix: r for r in lake.layer_structure(objects).collect()}
    assert rows["silver/images/"].first_names == ["00", "01", "02", "03", "04"]
    assert (rows["silver/images/"].files, rows["silver/images/"].more) == (7, 2)
    assert rows["silver/structured/"].first_names == [] and rows["silver/structured/"].more == 0


def test_status_and_summary(spark):
    manifest = spark.createDataFrame(
        [("a", "/a", "k/a"), ("b", "/b", "k/b"), ("c", "/c", "k/c")],
        "name string, source_path string, object_key string",
    )
    found = spark.createDataFrame([("/a", 5), ("/c", -1)], "path string, length bigint")
    status = lake.ingest_status(manifest, found, "lake://")
    got = {r.name: r.status for r in status.collect()}
    assert got == {"a": "lake://k/a", "b": "NOT_FOUND", "c": "ERROR: unreadable /c"}
    directories = spark.createDataFrame([("x", 3), ("y", 0)], "name string, files bigint")
    verified = spark.createDataFrame([("p", 4)], "prefix string, objects bigint")
    row = lake.ingest_summary(directories, status, verified).first()
    assert (row.directories_ok, row.directories_skipped) == (1, 1)
    assert (row.total_uploaded, row.objects_found) == (4, 4)


def test_retention(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, date'2024-01-31'), (2, date'2024-01-02'), (3, date'2024-01-01') AS t(i, modificationTime)"
    )
    as_of = F.lit("2024-02-01").cast("date")
    kept, expired = lake.apply_retention(df, 30, as_of)
    assert sorted(r.i for r in kept.collect()) == [1] and sorted(r.i for r in expired.collect()) == [2, 3]
    kept, expired = lake.apply_retention(df, 0, as_of)
    assert kept.count() == 3 and expired.count() == 0


def test_vitals_csv(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("patient_id,age,temperature,blood_pressure\np1,40,101.5,120/80\nNA,x,n/a,\np3,40.0,hot,1/2\n")
    rows = tables.read_vitals(spark, str(path)).collect()
    assert [r.patient_id for r in rows] == ["p1", None, "p3"]
    assert [r.age for r in rows] == [40, None, 40]
    assert [r.temperature for r in rows] == [101.5, None, None]
    assert tables.read_vitals(spark, str(tmp_path / "none.csv")) is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("in/case_1_report.txt", "é")], "path string, raw_text string")
    tables.save_reports_json(df, str(tmp_path / "json"))
    row = spark.read.json(str(tmp_path / "json")).first()
    assert row.report_key == "case_1_structured" and row.raw_text == "é"
    assert tables.load_table(df, str(tmp_path / "t")) == 1 and tables.load_table(df, str(tmp_path / "t")) == 1
    assert tables.save_csv(df, str(tmp_path / "c"))
    assert tables.load_table(df.withColumn("bad", F.raise_error(F.lit("no"))), str(tmp_path / "u")) == 0


def test_manifest_has_one_form_at_every_size(spark):
    for n in (1, 500):
        rows = tables.manifest(spark.range(n).selectExpr("concat('r', id) AS report_id"), digits=1).collect()
        assert all(len(r.shard) == 1 and r.num_reports == len(r.report_ids) for r in rows)
        assert sorted(i for r in rows for i in r.report_ids) == sorted(f"r{i}" for i in range(n))
    assert len(rows) == 16


def test_catalogue_table(spark):
    df = spark.range(3).toDF("x")
    assert tables.load_table(df, "medlake_test_table") == 3
    assert tables.read_table(spark, "medlake_test_table").count() == 3


def test_ingest_of_a_whole_mapping(spark, tmp_path):
    source = tmp_path / "in" / "reports"
    source.mkdir(parents=True)
    for n in range(3):
        (source / f"r{n}.txt").write_text(f"report {n}")
    (source / "skip.bin").write_text("x")
    (tmp_path / "in" / "vitals.csv").write_text("id,age\n1,40\n")
    bronze = str(tmp_path / "bronze")
    directories = [
        (str(source), "bronze/reports", "reports", [".txt"]),
        (str(tmp_path / "in" / "images"), "bronze/images", "images", None),
    ]
    files = [
        ("vitals", str(tmp_path / "in" / "vitals.csv"), "bronze/structured/patient_vitals.csv"),
        ("notes", str(tmp_path / "in" / "notes.csv"), "bronze/structured/notes.csv"),
    ]
    for _ in range(2):  # a second run replaces, it does not add
        summary, status, verified = lake.ingest_all(spark, directories, files, bronze)
        row = summary.first()
        assert (row.directory_files, row.directories_ok, row.directories_skipped) == (3, 1, 1)
        assert (row.single_files, row.total_uploaded, row.objects_found) == (1, 4, 4)
        told = {r["name"]: r["status"] for r in status.collect()}
        assert told == {"vitals": "bronze/structured/patient_vitals.csv", "notes": "NOT_FOUND"}
        assert {r.prefix: r.objects for r in verified.collect()} == {
            "bronze/images/": 0,
            "bronze/reports/": 3,
            "bronze/structured/": 1,
        }
    stored = lake.read_bronze(spark, bronze).where("category = 'single'").first()
    assert bytes(stored.content) == b"id,age\n1,40\n"


def test_ingest_of_nothing(spark, tmp_path):
    summary, status, verified = lake.ingest_all(spark, [], [], str(tmp_path / "none"))
    assert summary.first().total_uploaded == 0 and status.count() == 0 and verified.count() == 3
