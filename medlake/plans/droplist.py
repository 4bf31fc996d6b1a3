"""Leave rows out of a stored table without moving the rows that stay.

Which rows go is decided on narrow entries: the row's address (file and position) and what the decision needs. The scan then drops them
by a cascade of Bloom filters: the first holds the rows to drop, the second the rows to keep that the first reports by mistake, the
third the rows to drop that the second reports, and so on, until no mistake is left. All rows of the table were put to
the test, so the cascade decides exactly, and no row is shuffled or joined. Files are taken in groups, so that a filter stays below a bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn

from medlake.plans.bounded import MAX_BROADCAST_BYTES
from medlake.plans.durable import cut
from medlake.plans.skew import skew_safe_join

#: Rows that one cascade drops, about: 9 bits each in the first filter, which every task holds.
GROUP_DROPS = 4_000_000
MISTAKES = 0.02
#: What a group with copies weighs in a broadcast: its value, the address that stays and the order.
GROUP_BYTES = 512
ADDRESS = ["__file", "__row"]


def _address() -> list[Column]:
    return [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]


def _scans(plan) -> list[str]:
    """Names of a plan's nodes."""
    below = plan.children()
    return [plan.nodeName(), *(n for i in range(below.size()) for n in _scans(below.apply(i)))]


def addressed(df: DataFrame) -> DataFrame:
    """``df``, or what it holds written once, so that every row has a file and a position of its own.

    Projections and filters of one table's files leave a row its address; anything else could repeat it.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    plain = plan.deterministic() and set(_scans(plan)) <= {"Project", "Filter", "LogicalRelation"}
    try:
        df.select(*_address())
    except AnalysisException:
        return cut(df, "addressed")  # not read from Parquet files as it is
    return df if plain else cut(df, "addressed")


def _place(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def _reported(bits: DataFrame, level: int, place: Column) -> Column:
    """Whether the filter in ``bits`` reports ``place``; evaluated in generated code, without Python.

    Every level hashes anew: rows that one filter cannot part must not be those that the next cannot part.
    """
    value = F.xxhash64(F.lit(level), place)
    jvm = bits.sparkSession._jvm
    shared = jvm.org.apache.spark.sql.classic.ExpressionUtils
    test = jvm.org.apache.spark.sql.catalyst.expressions.BloomFilterMightContain
    return ClassicColumn(shared.column(test(shared.expression(bits.scalar()._jc), shared.expression(value._jc))))


def _filter_of(values: DataFrame, level: int, n: int) -> DataFrame:
    """One row with the Bloom filter of ``values(h)``."""
    spark = values.sparkSession
    made = values.select(F.xxhash64(F.lit(level), "h").alias("h"))._jdf.stat().bloomFilter("h", max(64, n), MISTAKES)
    out = spark._jvm.java.io.ByteArrayOutputStream()
    made.writeTo(out)
    return spark.createDataFrame([(bytearray(out.toByteArray()),)], "bits binary")


def _cascade(verdicts: DataFrame, n: int | None = None) -> list[DataFrame]:
    """Filters that tell the rows ``h`` with ``drop``, ``n`` of them, from those without, level by level."""
    filters: list[DataFrame] = []
    n = verdicts.where("drop").count() if n is None else n
    side, rest = True, {True: verdicts.where("drop").select("h"), False: verdicts.where("not drop").select("h")}
    while n:
        filters.append(_filter_of(rest[side], len(filters), n))
        other = not side
        rest[other] = cut(rest[other].where(_reported(filters[-1], len(filters) - 1, F.col("h"))), "mistaken")
        side, n = other, rest[other].count()
    return filters


def _groups(drops: DataFrame, most: int) -> list[list[str]]:
    """Files with rows to drop, in groups of about ``most`` such rows."""
    groups, held = [], most
    for r in drops.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).orderBy("__file").collect():
        if held + r["n"] > most:
            groups.append([])
            held = 0
        groups[-1].append(r["__file"])
        held += r["n"]
    return groups


def without(df: DataFrame, drops: DataFrame, most: int = GROUP_DROPS) -> DataFrame:
    """``df`` (``addressed``) without the rows at the addresses ``drops(__file, __row)``; its plan has no exchange."""
    drops = cut(drops.select(*ADDRESS), "drops")
    groups = _groups(drops, most)
    listed = [f for g in groups for f in g]
    file, beside = F.col("_metadata.file_path"), len(set(df.inputFiles())) > len(listed)
    parts = [df.where(~file.isin(listed)) if listed else df] if beside or not listed else []
    for files in groups:
        part = df.where(file.isin(files)) if beside or len(groups) > 1 else df
        marked = drops.where(F.col("__file").isin(files)).withColumn("drop", F.lit(True))
        for seed in range(1, 100):
            entries = part.select(*_address(), _place(seed).alias("h"))
            verdicts = cut(entries.join(marked, ADDRESS, "left").select("h", F.coalesce("drop", F.lit(False)).alias("drop")), "verdicts")
            # No filter could part a row to drop from one to keep with the same hash: hash anew.
            sides = verdicts.groupBy("h").agg(F.bool_or("drop").alias("drop"), F.bool_and("drop").alias("only"))
            n, shared = sides.agg(F.count_if(F.col("drop")), F.count_if(F.col("drop") & ~F.col("only"))).first()
            if not shared:
                break
        out = None
        for level, bits in reversed(list(enumerate(_cascade(verdicts, n)))):
            reported = _reported(bits, level, _place(seed))
            out = reported if out is None else reported & ~out
        parts.append(part.where(~out))
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def keep_first(df: DataFrame, group: Column, order: Sequence[Column], most: int = GROUP_DROPS) -> DataFrame:
    """One row of every value of ``group``, the first by ``order``, then by its address.

    Only the group's value, the order and the address of each row are grouped and joined; a group of any size is
    reduced inside each task first, and its entries are dealt over several tasks.
    """
    df = addressed(df)
    entries = cut(df.select(group.alias("__group"), F.struct(*order).alias("__order"), *_address()), "entries")
    rank = F.struct("__order", *ADDRESS)
    groups = entries.groupBy("__group").agg(F.count(F.lit(1)).alias("__n"), F.min(rank).alias("__first"))
    crowded = cut(groups.where("__n > 1").select("__group", "__first"), "crowded")
    few = crowded.limit(MAX_BROADCAST_BYTES // GROUP_BYTES + 1).count() * GROUP_BYTES <= MAX_BROADCAST_BYTES
    told = entries.join(F.broadcast(crowded), "__group") if few else skew_safe_join(entries, crowded, "__group", "inner", spread_by=ADDRESS)
    same = F.lit(True)
    for c in ADDRESS:
        same = same & (F.col(c) == F.col(f"__first.{c}"))
    return without(df, told.where(~same), most)
