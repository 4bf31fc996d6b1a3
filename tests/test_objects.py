"""The object sink, bitmaps, the two-level manifest, the ingest of nothing, and the plan of the patient view."""

import os
import struct

import pytest
from pyspark.sql import functions as F

from medlake.operators import images, registry
from medlake.sources import lake, objects, tables


def test_objects_are_whole_and_repeatable(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = [("a/b/one.txt", b"one"), ("two.bin", b"\0" * 70_000), ("empty", None), (None, b"x"), ("../out", b"x"), ("/abs", b"x"),
            ("a/../../out", b"x"), ("_staged/x", b"x"), ("a/b", b"a folder"), ("ü ö.txt", "ü".encode())]
    df = spark.createDataFrame(rows, "object_key string, content binary").coalesce(1)
    for _ in range(2):
        status = {r["object_key"]: r for r in objects.put_objects(df, root).collect()}
        assert {k for k, r in status.items() if r["error"] is None} == {"a/b/one.txt", "two.bin", "empty", "ü ö.txt"}
        assert (status["two.bin"]["length"], status["empty"]["length"], status["../out"]["length"]) == (70_000, 0, None)
    stored = {os.path.relpath(os.path.join(d, f), root): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names}
    assert stored == {"a/b/one.txt": 3, "two.bin": 70_000, "empty": 0, "ü ö.txt": 2}
    assert sorted(os.listdir(tmp_path)) == ["store"]
    changed = spark.createDataFrame([("two.bin", b"new")], "object_key string, content binary")
    objects.put_objects(changed, f"file://{root}")
    assert open(f"{root}/two.bin", "rb").read() == b"new"
    assert objects.put_objects(df.limit(0), root).count() == 0


@pytest.mark.parametrize("width, channels", [(64, 1), (65, 1), (66, 3), (67, 3)])
def test_bitmaps_are_read_back(spark, tmp_path, width, channels):
    height = 70
    data = bytes((7 * i + i // 13) % 256 for i in range(width * height * channels))
    schema = "path string, image struct<height:int,width:int,nChannels:int,data:binary>"
    rows = [("x.bmp", (height, width, channels, data)), ("lost.bmp", (-1, -1, -1, None)), ("alpha.bmp", (1, 1, 4, b"1234")), ("none.bmp", None)]
    made = spark.createDataFrame(rows, schema).select(F.col("path").alias("object_key"), objects.bitmap().alias("content"))
    assert made.where("content is null").count() == 3
    objects.put_objects(made.where("content is not null"), str(tmp_path / "i"))
    back = images.read_images(spark, str(tmp_path / "i")).select("file_size", "image.*").collect()
    assert [(r["height"], r["width"], r["nChannels"]) for r in back] == [(height, width, 3)]
    want = data if channels == 3 else bytes(b for x in data for b in (x, x, x))
    assert bytes(back[0]["data"]) == want and back[0]["file_size"] == 54 + (width * 3 + (-width * 3) % 4) * height


def test_bitmaps_of_odd_images(spark):
    schema = "n int, image struct<height:int,width:int,nChannels:int,data:binary>"
    rows = [(0, (2, 3, 1, None)), (1, (2, 3, 1, b"ab")), (2, (2, 3, 3, bytes(range(20)))), (3, (None, 3, 1, b"abc")), (4, (0, 3, 1, b""))]
    got = [r[0] and bytes(r[0]) for r in spark.createDataFrame(rows, schema).orderBy("n").select(objects.bitmap()).collect()]
    assert [g and len(g) for g in got] == [54, 54 + 6 + 3 + 3, 54 + 24, None, None]
    assert got[0] == b"BM" + struct.pack("<IIIIiiHHII", 78, 0, 54, 40, 3, -2, 1, 24, 0, 24) + bytes(16)
    assert got[1][54:] == b"aaabbb" + bytes(6) and got[2][54:] == bytes(range(9)) + bytes(3) + bytes(range(9, 18)) + bytes(3)


def test_manifest_index_names_every_id_once(spark, tmp_path):
    path = str(tmp_path / "manifest")
    ids = spark.range(1_000).select(F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("report_id"))
    ids = ids.unionByName(spark.createDataFrame([(None,), ("r00007",)], "report_id string")).repartition(5)
    for _ in range(2):
        index = tables.write_manifest(ids, path, part_rows=300).orderBy("part").collect()
    assert [(r["part"], r["num_reports"]) for r in index] == [(0, 300), (1, 300), (2, 300), (3, 102)]
    listed = [r["id"] for n in range(4) for r in tables.read_part(spark, path, n).collect()]
    assert listed == [None, *sorted(r["report_id"] for r in ids.where("report_id is not null").collect())]
    # Between a part's ids and the next part's lies its border; min_by and max_by leave out a null id's place.
    assert index[1]["first_id"] == listed[300] and index[2]["last_id"] == listed[899] and index[0]["last_id"] == listed[299]
    assert tables.write_manifest(ids.limit(0), path).count() == 0


def test_ingest_of_missing_files_empties_the_category(spark, tmp_path):
    (tmp_path / "f.txt").write_text("text")
    bronze = str(tmp_path / "bronze")
    lake.ingest_files(spark, [("f", str(tmp_path / "f.txt"), "bronze/f.txt")], bronze, "single")
    assert lake.read_bronze(spark, bronze).count() == 1
    lake.ingest_files(spark, [("g", str(tmp_path / "g.txt"), "bronze/g.txt")], bronze, "single")
    assert lake.read_bronze(spark, bronze).count() == 0


def test_patient_view_shuffles_every_side_once(spark):
    reports = spark.range(500).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("patient_id"), F.col("id").alias("report"))
    patients, vitals, files = (spark.range(30).select(F.col("id").alias("patient_id"), (F.col("id") * n).alias(f"c{n}")) for n in (2, 3, 5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = registry.patient_view(patients, [reports, vitals, files])
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4, plan
        assert view.count() == 500 and view.where("c2 is null").count() == reports.where("patient_id >= 30").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
