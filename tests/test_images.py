import numpy as np
import pytest
from png import png
from pyspark.sql import functions as F

from medlake.functions import pixels
from medlake.operators import images
from medlake.queries import records


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("images")
    grey = lambda w, h, level: png([bytes([level]) * w] * h, w)
    (root / "ok_64.png").write_bytes(grey(64, 64, 100))
    (root / "small.png").write_bytes(grey(63, 64, 100))
    (root / "broken.png").write_bytes(b"not a png")
    (root / "wide.PNG").write_bytes(grey(10001, 64, 7))
    (root / "colour.png").write_bytes(png([bytes([200, 100, 50]) * 80] * 70, 80, colour=True))
    ramp = bytes(np.linspace(0, 255, 512).astype(np.uint8))
    (root / "ramp.png").write_bytes(png([ramp] * 512, 512))
    (root / "note.txt").write_text("not an image")
    return str(root)


@pytest.fixture(scope="module")
def tensors(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tensors") / "t")
    validated = images.validate_images(images.read_images(spark, folder))
    images.normalise_images(validated).write.parquet(out)
    return spark.read.parquet(out)


def by_name(rows):
    return {r.path.rsplit("/", 1)[1]: r for r in rows}


def test_validation(spark, folder):
    rows = by_name(images.validate_images(images.read_images(spark, folder)).drop("image").collect())
    assert len(rows) == 6
    assert rows["ok_64.png"].is_valid and rows["ok_64.png"].mode == "L"
    assert rows["colour.png"].mode == "RGB" and rows["colour.png"].is_valid
    assert rows["small.png"].error_message == "Image too small: 63x64 (minimum 64x64)"
    assert rows["wide.PNG"].error_message == "Image too large: 10001x64 (maximum 10000x10000)"
    assert rows["broken.png"].error_message == "Corrupted image file" and rows["broken.png"].width is None
    assert rows["broken.png"].file_size == 9 and rows["ok_64.png"].file_size > 0


def test_tensors(tensors):
    rows = by_name(tensors.collect())
    assert rows["small.png"].tensor is None
    flat = np.array(rows["ok_64.png"].tensor)
    assert flat.shape == (512 * 512,) and np.allclose(flat, 100 / 255)
    luma = round(0.299 * 200 + 0.587 * 100 + 0.114 * 50)
    assert np.allclose(np.array(rows["colour.png"].tensor), luma / 255)
    ramp = np.array(rows["ramp.png"].tensor).reshape(512, 512)
    want = np.linspace(0, 255, 512).astype(np.uint8) / 255
    assert np.abs(ramp - want).max() <= 2 / 255
    assert len(rows["ramp.png"].preview) == 512 * 512
    preview = np.frombuffer(rows["ok_64.png"].preview, dtype=np.uint8)
    assert set(preview.tolist()) <= {99, 100}


def test_silver_and_summary(tensors):
    keys = sorted(r.image_key for r in images.silver_images(tensors).select("image_key").collect())
    assert keys == ["colour", "ok_64", "ramp"]
    row = images.image_summary(tensors).first()
    assert (row.total_images, row.processed_successfully, row.failed, row.skipped) == (6, 3, 3, 0)
    assert [p.rsplit("/", 1)[1] for p in row.failed_images] == ["broken.png", "small.png", "wide.PNG"]
    size = tensors.agg(F.sum("file_size")).first()[0] / 1024 / 6
    assert row.average_original_size_kb == pytest.approx(size)
    assert row.average_processing_time_ms > 0


def test_embeddings_isolate_failures(tensors):
    def model(tensor):
        if tensor[0] > 0.5:
            raise RuntimeError("too bright")
        return tensor[:3]

    context = F.when(F.col("path").endswith("ramp.png"), F.lit("chest film"))
    rows = {
        r.source_path.rsplit("/", 1)[1]: r
        for r in images.embed_images(tensors, context, model, dim=16).collect()
    }
    assert rows["ramp.png"].status == "success" and len(rows["ramp.png"].text_embedding) == 16
    assert rows["ok_64.png"].text_embedding is None
    assert rows["ok_64.png"].image_embedding == pytest.approx([100 / 255] * 3)
    assert rows["broken.png"].status == "error" and rows["broken.png"].error == "Corrupted image file"
    assert len(rows) == 6
    one = images.embed_images(tensors.where("is_valid")).where(F.size("image_embedding") == 1408)
    assert one.count() == 3


def test_bytes_hook_gets_base64(spark, folder):
    files = spark.read.format("binaryFile").load(folder + "/broken.png")
    row = images.embed_image_bytes(files, lambda text: [float(len(text))]).first()
    assert row.image_embedding == [12.0] and row.status == "success"


def test_resample_weights_sum_to_one():
    for source in (64, 512, 700, 3000):
        m = pixels.resample_matrix(source, 512)
        assert m.shape == (512, source) and np.allclose(m.sum(axis=1), 1.0)
    noise = np.random.default_rng(0).integers(0, 256, (64, 64)).astype(float)
    assert pixels.blur(noise).std() < noise.std()
    tensor = pixels.normalise(np.full((70, 90, 4), 255, np.uint8).tobytes(), 70, 90, 4)
    assert tensor.dtype == np.float32 and tensor.max() == 1.0


def test_batches_reach_the_model_and_bad_rows_stand_alone(tensors):
    def model(batch):
        if any(t[0] > 0.9 for t in batch):
            raise RuntimeError("one too bright")
        return [t[:2] for t in batch]

    bright = tensors.where("is_valid").withColumn(
        "tensor", F.when(F.col("path").endswith("ramp.png"), F.transform("tensor", lambda x: x * 0 + 1)).otherwise(F.col("tensor"))
    )
    rows = {
        r.source_path.rsplit("/", 1)[1]: r
        for r in images.embed_images(bright.coalesce(1), image_batch_fn=model, dim=16).collect()
    }
    assert {n: r.status for n, r in rows.items()} == {"ok_64.png": "success", "colour.png": "success", "ramp.png": "error"}
    assert rows["ramp.png"].error == "one too bright" and len(rows["colour.png"].image_embedding) == 2


def test_transparent_colour_does_not_bleed():
    pixels_in = np.zeros((64, 64, 4), np.uint8)
    pixels_in[:, :32] = (200, 100, 50, 255)
    pixels_in[:, 32:] = (255, 255, 255, 0)
    out = pixels.resize(pixels_in, 16)
    edge = out[:, :, 3] > 20
    assert edge.any() and np.abs(out[edge][:, :3] - (200, 100, 50)).max() <= 8


def test_tensors_tell_their_range_and_sum(tensors):
    for r in tensors.collect():
        if r.tensor is None:
            assert (r.low, r.high, r.total) == (None, None, None)
            continue
        flat = np.array(r.tensor, dtype=np.float32)
        assert (r.low, r.high) == (flat.min(), flat.max()) and r.total == pytest.approx(flat.sum(dtype=np.float64), abs=1e-6)


def test_derived_images_keep_their_levels(spark, tmp_path):
    odd = [float("nan"), float("inf"), None, -0.5, 0.0, 0.25, 0.3125, 1.0]
    rows = [(1, odd), (5, [0.1] * 64), (7, [0.3, 0.9]), (8, None), (9, []), (None, [0.2, -0.2]), (1, odd)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    level = lambda x, y: F.hex(F.greatest(F.lit(0), F.least(F.lit(255), F.round(128 + 400 * x * y))).cast("bigint"))
    line = lambda x: F.array_join(F.transform("embedding", lambda y: F.lpad(level(x, y), 2, "0")), "")
    side = F.when(F.col("vec_id") % 5 == 0, 40).otherwise(64)
    want = spark.read.parquet(str(tmp_path / "embeddings.parquet")).select(
        "vec_id", F.array_join(F.transform(F.slice("embedding", 1, side), line), "").alias("levels")
    )
    lost = F.col("vec_id") % 7 == 0
    told = want.select(F.when(~lost, F.col("levels")).alias("levels"), (F.length("levels") / 2).cast("bigint").alias("size")).collect()
    got = records.derived_images(spark, str(tmp_path)).select(F.hex("image.data").alias("levels"), F.col("file_size").alias("size")).collect()
    assert sorted(map(str, got)) == sorted(map(str, told)) and len(got) == 7
