"""Text chunks and embeddings through pluggable batch functions."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from medlake.functions.words import sparse_words
from medlake.plans.batches import slices, tidy

# Vector lengths and texts per model call.
TEXT_DIM = 768
IMAGE_DIM = 1408
# Rows handed to a model at once.
MODEL_ROWS = 32
BATCH_SIZE = 32

# Words whose slots a task remembers.
SLOTS_HELD = 100_000

EmbedFn = Callable[[list[str]], np.ndarray]

_TOKEN = re.compile(r"[A-Za-z0-9]+")


class _Slots(dict):
    """word -> slot, worked out when a word is first met; forgotten when too many are held."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= SLOTS_HELD:
            self.clear()
        self[word] = found = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dim
        return found


def hashed_words(dim: int = TEXT_DIM) -> EmbedFn:
    """Default text model: hashed bag of lower-cased ASCII words, scaled to length 1.

    A word's slot is the first 32 bits of its MD5 modulo ``dim``, so any SQL engine can
    reproduce the vectors. Slots are remembered per task, as words repeat heavily.
    """
    slots = _Slots(dim)

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            words = _TOKEN.findall(text.lower() if text.isascii() else _lower(text))
            places = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
            out[row] = np.bincount(places, minlength=dim)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=out, where=norms > 0)

    return embed


def _lower(text: str) -> str:
    """Lower-case A-Z only: other letters split words and must not fold into ASCII."""
    return text.translate(_ASCII_LOWER)


_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def embed_text(text: str, embed_fn: EmbedFn | None = None, dim: int = TEXT_DIM) -> list[float]:
    """The vector of one text, outside any job."""
    return [float(x) for x in (embed_fn or hashed_words(dim))([text])[0]]


def embed_texts(
    df: DataFrame,
    text_field: str = "text",
    embed_fn: EmbedFn | None = None,
    dim: int = TEXT_DIM,
    batch_size: int = BATCH_SIZE,
    output: str = "embedding",
) -> DataFrame:
    """Append ``output array<float>`` for every row; a null text gets a null vector.

    The model sees at most ``batch_size`` texts per call. No shuffle: rows keep their
    partition, and ``embed_fn`` is unpickled once per task. Rows go on in small batches, so that
    a task holds the vectors of few texts at once.
    """
    if text_field not in df.columns:
        raise ValueError(f"no column {text_field!r} to embed")
    model = embed_fn or hashed_words(dim)
    schema = T.StructType(df.schema.fields + [T.StructField(output, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index(text_field)).to_pylist()
            filled = [i for i, t in enumerate(texts) if t is not None]
            vectors = np.zeros((len(texts), dim), dtype=np.float32)
            for start in range(0, len(filled), batch_size):
                part = filled[start : start + batch_size]
                vectors[part] = model([texts[i] for i in part])
            absent = np.ones(len(texts), dtype=bool)
            absent[filled] = False
            offsets = np.arange(0, (len(texts) + 1) * dim, dim, dtype=np.int32)
            column = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(vectors.ravel()), mask=pa.array(absent)
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, column], names=[*batch.schema.names, output]
            )

    return df.mapInArrow(tidy(run), schema)


def embed_sparse(
    df: DataFrame, text_field: str = "text", dim: int = TEXT_DIM, output: str = "embedding"
) -> DataFrame:
    """Append the default vector as ``struct(slots array<int>, weights array<float>)``: its filled places only.

    Column expressions without Python workers; a null text gets null. The result comes out of a one-row
    generator, so that a filter on it is not pushed below and the words are not hashed twice.
    ``embed_texts`` remembers the slots of words and is faster where dense vectors are needed.
    """
    if text_field not in df.columns:
        raise ValueError(f"no column {text_field!r} to embed")
    return df.select("*", F.explode(F.array(sparse_words(df[text_field], dim))).alias(output))


def check_dimension(
    df: DataFrame, dim: int, column: str = "embedding"
) -> tuple[DataFrame, DataFrame]:
    """(rows honouring the dimension contract, rows violating it with their size)."""
    size = F.coalesce(F.size(F.col(column)), F.lit(-1))
    size = F.when(F.col(column).isNull(), F.lit(-1)).otherwise(size)
    return df.where(size == dim), df.where(size != dim).withColumn("found_dim", size)


def chunk_words(
    df: DataFrame,
    text_field: str = "text",
    size: int = 200,
    overlap: int = 20,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Overlapping word windows of long texts: ``keep`` columns, chunk_no, n_words, chunk."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap
    words = F.filter(F.split(F.col(text_field), r"[ \t\n\r]+"), lambda w: w != "")
    n = F.size("words")
    # A window starts at 0, and at every further step that still brings new words.
    last = F.greatest(F.ceil((n - F.lit(overlap)) / F.lit(step)) - 1, F.lit(0)).cast("int")
    return (
        df.select(*keep, words.alias("words"))
        .where(n > 0)
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("window", F.slice("words", F.col("chunk_no") * step + 1, F.lit(size)))
        .select(
            *keep,
            "chunk_no",
            F.size("window").alias("n_words"),
            F.array_join("window", " ").alias("chunk"),
        )
    )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dicts; list-of-number cells stay numpy slices instead of Python lists."""
    readers = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        kind = column.type
        if pa.types.is_list(kind) and pa.types.is_floating(kind.value_type):
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            readers[name] = lambda i, v=values, o=offsets, ok=valid: (
                v[o[i] : o[i + 1]] if ok[i] else None
            )
        else:
            cells = column.to_pylist()
            readers[name] = cells.__getitem__
    for i in range(batch.num_rows):
        yield {name: read(i) for name, read in readers.items()}


def each(fn: Callable) -> Callable[[list], list]:
    """A batch function of a function of one item; an item's exception takes the place of its result."""

    def batch(items: list) -> list:
        out = []
        for item in items:
            try:
                out.append(fn(item))
            except Exception as problem:  # noqa: BLE001  (told in the item's row)
                out.append(problem)
        return out

    return batch


def _isolated(fn: Callable[[list], list], items: list) -> list:
    """``fn(items)``; a batch that fails is halved down to the items at fault."""
    try:
        got = list(fn(items))
        if len(got) != len(items):
            raise ValueError(f"{len(got)} results for {len(items)} rows")
        return got
    except Exception as problem:  # noqa: BLE001  (told in the item's row)
        if len(items) == 1:
            return [problem]
        half = len(items) // 2
        return _isolated(fn, items[:half]) + _isolated(fn, items[half:])


def safe_map(
    df: DataFrame,
    fn: Callable[[list[dict]], list],
    schema: T.StructType,
    source: Column,
    batch_rows: int = MODEL_ROWS,
) -> DataFrame:
    """Run ``fn`` over batches of rows; a failing row yields ``status='error'`` and its message.

    ``fn`` returns a dict or an exception per row. If it raises, the batch is halved until the rows at
    fault are alone. ``schema`` names the nullable columns of the dicts; ``source`` becomes ``source_path``.
    """
    out_schema = T.StructType(
        schema.fields
        + [
            T.StructField("source_path", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )
    names = [f.name for f in schema.fields]
    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                inputs = list(_rows(batch.slice(start, batch_rows)))
                paths = [row.pop("__source") for row in inputs]
                rows = []
                for path, got in zip(paths, _isolated(fn, inputs), strict=True):
                    if isinstance(got, Exception):
                        out = dict.fromkeys(names) | {"status": "error", "error": str(got)}
                    else:
                        out = {n: got.get(n) for n in names} | {"status": "success", "error": None}
                    rows.append(out | {"source_path": path})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[f.name] for r in rows], f.type) for f in arrow], schema=arrow
                )

    return df.withColumn("__source", source).mapInArrow(run, out_schema)
