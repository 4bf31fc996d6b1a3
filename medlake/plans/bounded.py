"""Size checks in front of broadcasts and driver-side values."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper limit for anything shipped whole to every executor.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# What a row of a broadcast table costs beside its value.
ROW_OVERHEAD = 32


def fetch_if_small(df: DataFrame, max_rows: int) -> pa.Table | None:
    """The rows of ``df`` as Arrow if there are at most ``max_rows``, else ``None``.

    The rows are counted up to the bound first, so a large input moves no values at all; the
    caller must have an exact distributed way for ``None``.
    """
    return df.toArrow() if df.limit(max_rows + 1).count() <= max_rows else None


def broadcast_if_small(keys: DataFrame, column: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``keys`` marked for broadcast if the values of ``column`` were summed up to at most ``max_bytes``.

    Otherwise unchanged, and Spark shuffles. ``keys`` should be a stored table: it is read for the sum.
    """
    size = F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)) + ROW_OVERHEAD
    total = keys.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(keys) if total <= max_bytes else keys


def vector_rows_limit(dim: int, max_bytes: int = MAX_BROADCAST_BYTES) -> int:
    """How many float64 vectors of ``dim`` values fit in ``max_bytes``."""
    return max(1, max_bytes // (8 * max(1, dim)))
