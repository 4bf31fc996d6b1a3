"""One object per row: files written inside tasks, under keys that somebody else can fetch."""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlake.plans.durable import cut

STAGED = "_staged"
STATUS = "object_key string, length long, error string"


def _inside(key: str) -> str:
    """``key`` as a path below the root; anything else is refused."""
    clean = os.path.normpath(key).replace(os.sep, "/")
    if not key or clean.startswith(("/", "..")) or clean.split("/")[0] == STAGED:
        raise ValueError(f"not a key: {key!r}")
    return clean


def put_objects(rows: DataFrame, root: str, key: str = "object_key", content: str = "content") -> DataFrame:
    """Write ``content`` of every row to ``root/key`` and return ``(object_key, length, error)``.

    An object is written beside its place and moved there, so that a reader sees it whole or not at all, and a retried task
    or a second run writes the same objects again. ``root`` is a path or address of any file system that
    pyarrow reaches from the tasks. Rows without a key, with a key that leaves the root, or whose write fails get an ``error``,
    null content makes an empty object; of a repeated key one row's content stays.
    """
    chosen = rows.select(F.col(key).alias("object_key"), F.col(content).cast("binary").alias("content"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root.removeprefix("file:"))
        staged, made = f"{base}/{STAGED}/{uuid.uuid4().hex}", set()
        for batch in batches:
            sizes, errors = [], []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    place = f"{base}/{_inside(name or '')}"
                    for folder in (staged, os.path.dirname(place)):
                        if folder not in made:
                            files.create_dir(folder, recursive=True)
                            made.add(folder)
                    body = data.as_buffer() or b""
                    with files.open_output_stream(f"{staged}/object") as out:
                        out.write(body)
                    files.move(f"{staged}/object", place)
                    sizes.append(len(body))
                    errors.append(None)
                except (ValueError, OSError) as problem:
                    sizes.append(None)
                    errors.append(str(problem))
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(errors, pa.string())], names=["object_key", "length", "error"])
        if staged in made:
            files.delete_dir(staged)

    return cut(chosen.mapInArrow(write, STATUS), "objects")


def bitmap(image: str = "image") -> Column:
    """An image struct (height, width, nChannels 1 or 3, data by rows, blue first) as the bytes of a bitmap file.

    Grey levels become three equal channels. Null where there is no such image.
    """
    height, width, channels = (F.col(f"{image}.{c}") for c in ("height", "width", "nChannels"))
    known = channels.isin(1, 3) & (height > 0) & (width > 0)
    drawn = F.arrow_udf(_draw, "binary", F.ArrowUDFType.SCALAR)
    return F.when(known, drawn(height, width, channels, F.col(f"{image}.data")))


def _draw(height: pa.Array, width: pa.Array, channels: pa.Array, data: pa.Array) -> pa.Array:
    shapes = zip(height.to_pylist(), width.to_pylist(), channels.to_pylist())
    return pa.array([_file(*shape, pixels.as_buffer()) for shape, pixels in zip(shapes, data)], pa.binary())


def _file(height: int | None, width: int | None, channels: int | None, pixels: pa.Buffer | None) -> bytes | None:
    if channels not in (1, 3) or not height or not width or min(height, width) < 1:
        return None
    stride, padding = width * channels, bytes(-width * 3 % 4)
    size = (width * 3 + len(padding)) * height
    head = struct.pack("<2sIIIIiiHHIIQQ", b"BM", size + 54, 0, 54, 40, width, -height, 1, 24, 0, size, 0, 0)
    if pixels is None:
        return head
    levels = np.frombuffer(pixels, np.uint8)[: height * stride]
    if channels == 1:
        levels = levels.repeat(3)
    if not padding:
        return head + levels.tobytes()
    # Rows that the data does not reach are their padding only.
    lines = (levels[y * width * 3 : (y + 1) * width * 3].tobytes() for y in range(height))
    return head + b"".join(line + padding for line in lines)
