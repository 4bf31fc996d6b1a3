"""Column expressions and small plan helpers shared by the operators."""

from __future__ import annotations

import string

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlake.plans.batches import slices, tidy
from medlake.plans.bounded import MAX_BROADCAST_BYTES
from medlake.plans.durable import cut

__all__ = [
    "added",
    "ascii_lower",
    "bounded_hint",
    "cut",
    "keep_one",
    "key_remainder",
    "received",
    "replace",
    "row_key",
    "ship",
    "slices",
    "small_batches",
    "spare",
    "text_of",
    "tidy",
]

WORD = r"[^\x20\x09-\x0D]+"


#: Rows of a batch between Spark and its Python workers, where texts may be long.
BATCH_ROWS = 1_024


def small_batches(spark: SparkSession) -> None:
    """From now on this session exchanges batches of at most ``BATCH_ROWS`` rows with Python workers.

    Every running task holds such a batch on both sides; Spark's default is 10,000 texts of any length.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def ship(spark: SparkSession, value: object) -> Broadcast:
    """``value`` for all tasks, with the code of its classes: workers need not be able to import this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast) -> object:
    """What ``ship`` was given, made anew; to be called once in a task."""
    return cloudpickle.loads(shared.value)


def added(fields: T.StructType, **types: str) -> T.StructType:
    """The columns ``fields``, whatever their names, and further ones of the given types."""
    more = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in types.items()]
    return T.StructType([*fields.fields, *more])


def text_of(column: str | Column) -> Column:
    """A text with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def key_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(modulus))


def row_key(id_col: str, text_col: str) -> Column:
    """A digest of id and text that is the same for repeated rows; null differs from empty."""
    parts = [F.col(id_col).cast("string"), F.col(text_col)]
    shown = [F.coalesce(F.concat(F.lit("="), p), F.lit("~")) for p in parts]
    return F.unhex(F.sha2(F.concat(shown[0], F.lit("\n"), shown[1]), 256))


def replace(df: DataFrame, taken: list[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add (clashes are replaced)."""
    names = {t.lower() for t in taken}
    return df.drop(*[c for c in df.columns if c.lower() in names])


def spare(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_hint(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its counted size is within the limit, else unchanged.

    ``df`` is a written table, so that counting it reads file footers only.
    """
    small = df.limit(MAX_BROADCAST_BYTES // row_bytes + 1).count() * row_bytes <= MAX_BROADCAST_BYTES
    return F.broadcast(df) if small else df


def keep_one(docs: DataFrame, verdicts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that a verdict keeps, each repeated row once, columns unchanged.

    ``verdicts(key, keep, copies)`` has one row per distinct ``row_key``. Only the keys to drop
    and the keys of repeated rows are joined, so texts move only if these outgrow a broadcast.
    """
    key = spare(docs, "__llm_key")
    marked = docs.withColumn(key, row_key(id_col, text_col))
    drop = cut(verdicts.where("not keep or copies > 1").select(F.col("key").alias(key)), "drop")
    twice = cut(verdicts.where("keep and copies > 1").select(F.col("key").alias(key)), "twice")
    plain = marked.join(bounded_hint(drop, 64), key, "left_anti")
    repeated = marked.join(bounded_hint(twice, 64), key, "left_semi").dropDuplicates([key])
    return plain.unionByName(repeated).drop(key).select(*[f"`{c}`" for c in docs.columns])
