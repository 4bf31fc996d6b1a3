"""Positions of rows inside their groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlake.llm.common import bounded_hint, cut


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``nth`` (from 0, under ``order``, nulls first) and ``total``, the size of the group.

    Rows are sorted over all tasks by range, so that a group of any size fills as many tasks as it needs; then only the
    number of rows of every (task, group) is summed up. ``group`` holds no null. Rows alike in ``group`` and ``order``
    follow each other in any order. An empty table gives an empty result.
    """
    keys = [group, *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = cut(dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "laid")
    runs = laid.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy(group)
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select(
        group, "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("total")
    )
    found = laid.join(bounded_hint(cut(starts, "starts"), 128), [group, "part"])
    return found.select(*rows.columns, (F.col("at") + F.col("shift")).alias("nth"), "total")
