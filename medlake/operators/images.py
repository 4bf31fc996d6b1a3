"""Image table -> tensor table: validation, normalisation, embeddings, run summary."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlake.functions.pixels import SIDE, normalise, pool_grid, preview
from medlake.operators.embedding import IMAGE_DIM, EmbedFn, each, hashed_words, safe_map
from medlake.sources.lake import IMAGE_EXTENSIONS, packed, stem
from medlake.operators.summaries import first_failures

# Side limits, channel modes and error texts.
MIN_SIDE = 64
MAX_SIDE = 10000
MODES = {1: "L", 3: "RGB", 4: "RGBA"}
TOO_SMALL = "Image too small: %dx%d (minimum 64x64)"
TOO_LARGE = "Image too large: %dx%d (maximum 10000x10000)"
BAD_MODE = "Unsupported color mode: %s"
CORRUPTED = "Corrupted image file"

# Tensors per Arrow batch handed back to Spark (about 1 MiB each).
ROWS_PER_BATCH = 16

ImageEmbedFn = Callable[[np.ndarray], np.ndarray]
ImageBatchFn = Callable[[list[np.ndarray]], Sequence[np.ndarray]]


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """path, file_size and the decoded image of every image file below ``root``.

    Undecodable files stay, with height -1. One narrow scan: other files are left out by name before
    anything is decoded, and sizes come with the file listing.
    """
    endings = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e) for e in IMAGE_EXTENSIONS]
    return packed(
        spark.read.format("image")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*{" + ",".join(endings) + "}")
        .load(root)
        .select(
            F.regexp_replace("image.origin", r"^([a-z0-9]+):/+", "$1:/").alias("path"),
            F.col("_metadata.file_size").alias("file_size"),
            "image",
        )
    )


def validate_images(images: DataFrame, image: str = "image") -> DataFrame:
    """Append width, height, mode, ``is_valid`` and ``error_message``."""
    width, height = F.col(f"{image}.width"), F.col(f"{image}.height")
    names = F.create_map(*[F.lit(x) for pair in MODES.items() for x in pair])
    mode = F.try_element_at(names, F.col(f"{image}.nChannels"))
    decoded = F.coalesce(height > 0, F.lit(False))
    error = (
        F.when(~decoded, F.lit(CORRUPTED))
        .when((width < MIN_SIDE) | (height < MIN_SIDE), F.format_string(TOO_SMALL, width, height))
        .when((width > MAX_SIDE) | (height > MAX_SIDE), F.format_string(TOO_LARGE, width, height))
        .when(mode.isNull(), F.format_string(BAD_MODE, F.col(f"{image}.nChannels").cast("string")))
    )
    return images.withColumns(
        {
            "width": F.when(decoded, width),
            "height": F.when(decoded, height),
            "mode": F.when(decoded, mode),
            "error_message": error,
        }
    ).withColumn("is_valid", F.col("error_message").isNull())


TENSOR_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("mode", T.StringType()),
        T.StructField("is_valid", T.BooleanType()),
        T.StructField("error_message", T.StringType()),
        # No value is null, so that Spark copies them without asking.
        T.StructField("tensor", T.ArrayType(T.FloatType(), containsNull=False)),
        T.StructField("preview", T.BinaryType()),
        T.StructField("elapsed_ms", T.DoubleType()),
        # Taken of the tensor while it is an array: the same over its column costs many times as much.
        T.StructField("low", T.FloatType()),
        T.StructField("high", T.FloatType()),
        T.StructField("total", T.DoubleType()),
    ]
)


def normalise_images(validated: DataFrame, denoise: bool = True, side: int = SIDE) -> DataFrame:
    """Tensor rows of validated images; invalid and failing ones stay, without a tensor.

    ``low``, ``high`` and ``total`` are the least, the greatest and the sum of the tensor's values.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(TENSOR_SCHEMA)
    passed = [f.name for f in TENSOR_SCHEMA.fields[:7]]

    def work(row: dict, matrices: dict) -> dict:
        out = {name: row[name] for name in passed}
        start = time.perf_counter()
        try:
            tensor = normalise(
                row["data"], row["height"], row["width"], row["channels"], denoise, side, matrices
            )
            out |= {"tensor": tensor.ravel(), "preview": preview(tensor)}
            out |= {"low": float(tensor.min()), "high": float(tensor.max()), "total": float(tensor.sum(dtype=np.float64))}
        except Exception as problem:  # a bad image must not fail the run
            out |= {"is_valid": False, "error_message": str(problem)}
        return out | {"elapsed_ms": (time.perf_counter() - start) * 1000}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices: dict = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(start, ROWS_PER_BATCH)
                pixels = part.column("data")
                rows = [
                    work(r | {"data": pixels[i].as_buffer()}, matrices) if r["is_valid"] else r
                    for i, r in enumerate(part.drop_columns(["data"]).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.get(f.name) for r in rows], f.type) for f in arrow],
                    schema=arrow,
                )

    return validated.select(
        *passed,
        F.when(F.col("is_valid"), F.col("image.data")).alias("data"),
        F.col("image.nChannels").alias("channels"),
    ).mapInArrow(run, TENSOR_SCHEMA)


def silver_images(tensors: DataFrame) -> DataFrame:
    """Rows of the silver image table: valid images keyed by file stem.

    On a stored table the filter selects one partition.
    """
    return tensors.where("is_valid").withColumn("image_key", stem(F.col("path"))).drop("elapsed_ms")


def image_summary(tensors: DataFrame) -> DataFrame:
    """One row: totals, average original size over *all* images, time per good image.

    ``tensors`` should be a written table: it is read twice, without its tensor column.
    """
    total = F.count(F.lit(1))
    good = F.count_if("is_valid")
    summary = tensors.agg(
        total.alias("total_images"),
        good.alias("processed_successfully"),
        F.count_if(~F.col("is_valid")).alias("failed"),
        F.lit(0).cast("bigint").alias("skipped"),
        F.when(good > 0, F.try_divide(F.sum(F.col("file_size") / 1024.0), total))
        .otherwise(0.0)
        .alias("average_original_size_kb"),
        F.coalesce(F.avg(F.when(F.col("is_valid"), F.col("elapsed_ms"))), F.lit(0.0)).alias(
            "average_processing_time_ms"
        ),
    )
    failed = first_failures(tensors.where("NOT is_valid"))
    return summary.withColumn("failed_images", failed.scalar())


def pooled_image_model(dim: int = IMAGE_DIM) -> ImageEmbedFn:
    """Default image model: means over ``dim`` runs of the tensor, scaled to length 1."""

    def embed(tensor: np.ndarray) -> np.ndarray:
        return pool_grid(tensor, dim)

    return embed


def embed_images(
    tensors: DataFrame,
    context: Column | None = None,
    image_fn: ImageEmbedFn | None = None,
    text_fn: EmbedFn | None = None,
    dim: int = IMAGE_DIM,
    image_batch_fn: ImageBatchFn | None = None,
) -> DataFrame:
    """image_embedding, text_embedding, source_path, status, error per image.

    Models get batches: ``image_batch_fn`` a list of tensors, ``text_fn`` a list of texts; ``image_fn`` is
    for models that take one tensor. A text vector appears only where the row has context text.
    A failing row reports ``status='error'`` with its message and the rest of the batch goes on.
    """
    image_model = image_batch_fn or each(image_fn or pooled_image_model(dim))
    text_model = text_fn or hashed_words(dim)

    def embed(rows: list[dict]) -> list[dict | Exception]:
        seen = [r for r in rows if r["tensor"] is not None]
        told = [r for r in seen if r["context"]]
        vectors = image_model([np.asarray(r["tensor"], dtype=np.float32) for r in seen]) if seen else []
        texts = text_model([r["context"] for r in told]) if told else []
        if len(vectors) != len(seen) or len(texts) != len(told):
            raise ValueError("a model returned another number of vectors than it got inputs")
        of_image, of_text = iter(vectors), iter(texts)
        out: list[dict | Exception] = []
        for row in rows:
            if row["tensor"] is None:
                out.append(ValueError(row["error_message"] or "no image data"))
                continue
            got = {"image_embedding": next(of_image)}
            if row["context"]:
                got["text_embedding"] = next(of_text)
            failed = isinstance(got["image_embedding"], Exception)
            out.append(
                got["image_embedding"]
                if failed
                else {name: np.asarray(v, dtype=np.float32) for name, v in got.items()}
            )
        return out

    schema = T.StructType(
        [
            T.StructField("image_embedding", T.ArrayType(T.FloatType())),
            T.StructField("text_embedding", T.ArrayType(T.FloatType())),
        ]
    )
    text = F.lit(None).cast("string") if context is None else context
    rows = tensors.select("path", "tensor", "error_message", text.alias("context"))
    return safe_map(rows, embed, schema, F.col("path"))


def embed_image_bytes(files: DataFrame, bytes_fn: Callable[[str], list[float]]) -> DataFrame:
    """Image vector of raw file contents; the hook receives them base64-encoded."""
    schema = T.StructType([T.StructField("image_embedding", T.ArrayType(T.FloatType()))])
    encoded = files.select("path", F.base64("content").alias("encoded"))
    one = each(lambda row: {"image_embedding": bytes_fn(row["encoded"])})
    return safe_map(encoded, one, schema, F.col("path"))
