"""Exact medians of many columns without gathering a column's values in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

BUCKETS = 8192


def exact_medians(
    df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS
) -> dict[str, float | None]:
    """Interpolated median per column, ignoring nulls; ``None`` for an all-null column.

    One pass finds count, minimum and maximum; each further pass histograms only the values
    still inside the bracket that holds the middle ranks and narrows it to one bucket.
    A pass shuffles at most ``buckets`` partial counts per column and task whatever the row
    count, and returns at most two buckets per column to the driver. A column stops as
    soon as its bracket holds one distinct value, so rounded data needs one or two passes.
    """
    if not columns:
        return {}
    extremes = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.min(c).cast("double").alias("lo"),
                F.max(c).cast("double").alias("hi"),
            ).alias(c)
            for c in columns
        ]
    ).first()
    # One bracket per middle rank; the two ranks of an even count may part ways.
    brackets: list[dict] = []
    for column in columns:
        n, lo, hi = extremes[column]
        if n == 0:
            continue
        if not (math.isfinite(lo) and math.isfinite(hi)):
            raise ValueError(f"column {column} holds non-finite values")
        for rank in sorted({(n - 1) // 2, n // 2}):
            brackets.append({"column": column, "rank": rank, "lo": lo, "hi": hi})
    while open_brackets := [b for b in brackets if b["lo"] < b["hi"]]:
        _narrow(df, open_brackets, buckets)
    medians: dict[str, float | None] = dict.fromkeys(columns)
    for column in columns:
        middle = [b["lo"] for b in brackets if b["column"] == column]
        if middle:
            medians[column] = sum(middle) / len(middle)
    return medians


def _narrow(df: DataFrame, brackets: list[dict], buckets: int) -> None:
    """Replace each bracket by the histogram bucket that holds its rank."""
    slots = sorted({(b["column"], b["lo"], b["hi"]) for b in brackets})
    entries = []
    for slot, (column, lo, hi) in enumerate(slots):
        value = F.col(column).cast("double")
        if math.isfinite(hi - lo):
            position = (value - lo) / (hi - lo) * buckets
        else:  # halved, the width of a range near the largest double stays finite
            position = (value / 2 - lo / 2) / (hi / 2 - lo / 2) * buckets
        bucket = F.least(F.floor(position), F.lit(buckets - 1)).cast("int")
        inside = value.between(lo, hi)
        entries.append(
            F.struct(
                F.when(inside, F.lit(slot)).alias("slot"),
                F.when(inside, bucket).alias("bucket"),
                value.alias("value"),
            )
        )
    histogram = (
        df.select(F.inline(F.array(*entries)))
        .where(F.col("slot").isNotNull())
        .groupBy("slot", "bucket")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
    )
    by_bucket = Window.partitionBy("slot").orderBy("bucket")
    reached = histogram.withColumn(
        "upto", F.sum("n").over(by_bucket.rowsBetween(Window.unboundedPreceding, 0))
    )
    holds = F.lit(False)
    for bracket in brackets:
        slot = slots.index((bracket["column"], bracket["lo"], bracket["hi"]))
        rank = F.lit(bracket["rank"])
        holds = holds | (
            (F.col("slot") == slot) & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        )
    found = reached.where(holds).collect()
    for bracket in brackets:
        slot = slots.index((bracket["column"], bracket["lo"], bracket["hi"]))
        for row in found:
            if row.slot == slot and row.upto - row.n <= bracket["rank"] < row.upto:
                bracket["rank"] -= row.upto - row.n
                bracket["narrowed"] = (row.lo, row.hi)
                break
    for bracket in brackets:
        bracket["lo"], bracket["hi"] = bracket.pop("narrowed")
