"""Equi-join that stays balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlake.plans.bounded import broadcast_if_small
from medlake.plans.durable import cut

# Rows of one key that a task is meant to join.
ROWS_PER_TASK = 1_000_000


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and the number of tasks that their rows fill."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") > rows_per_task)
    return hot.select(key, F.ceil(F.col("__n") / rows_per_task).cast("int").alias("__salts"))


def _known(hot: DataFrame, key: str) -> DataFrame:
    """``hot`` stored, so that neither side of a join finds the hot keys anew, and broadcast if it is small."""
    return broadcast_if_small(cut(hot, "hot-keys"), key)


def deal(left: DataFrame, hot: DataFrame, key: str, spread_by: Sequence[str | Column] | None = None) -> DataFrame:
    """``left`` with ``__salt``: rows of a hot key over its sub-keys, by a hash of ``spread_by`` (default: the whole row)."""
    salts = F.coalesce(
        # Null keys never match, so they may go anywhere: deal them out as well.
        F.when(F.col(key).isNull(), F.lit(1024)).otherwise(F.col("__salts")),
        F.lit(1),
    )
    spread = F.pmod(F.xxhash64(*(spread_by or left.columns)), salts).cast("int")
    return left.join(hot, key, "left").withColumn("__salt", spread).drop("__salts")


def repeat(right: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``right`` with ``__salt``: once per sub-key of a hot key."""
    numbers = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
    return right.join(hot, key, "left").withColumn("__salt", F.explode(numbers)).drop("__salts")


def skew_safe_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    spread_by: Sequence[str | Column] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``left`` (the side with repeated keys) to ``right`` on ``key``.

    A hot key's rows are dealt over as many sub-keys as they fill tasks on the left, by a hash of
    ``spread_by`` (default: the whole row), and the few matching right rows are repeated
    once per sub-key. Other keys keep the single sub-key 0, so nothing else grows. The hot
    list has one row per ``rows_per_task`` rows at most and is found once.
    """
    return skew_safe_joins(left, [right], key, how, spread_by, rows_per_task)


def skew_safe_joins(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str,
    how: str = "left",
    spread_by: Sequence[str | Column] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``left`` to each of ``rights`` on ``key``, all dealt alike: every side is shuffled once at most."""
    if how not in ("inner", "left"):
        raise ValueError("skew-safe joins are inner or left")
    hot = _known(hot_keys(left, key, rows_per_task), key)
    joined = deal(left, hot, key, spread_by)
    for right in rights:
        joined = joined.join(repeat(right, hot, key), [key, "__salt"], how)
    return joined.drop("__salt")
