"""Exact duplicates through an extendible-hash index on shared files.

1. Every row leaves a narrow entry (id, 64-bit hash, length, digest) in a log in the shared folder.
2. A directory over hash prefixes starts with two buckets; a bucket over capacity is split by
   doubling the directory, until it fits or holds one single hash (which no prefix can split).
3. Entries move to the owner of their bucket, a range of hashes, counted inside each task first:
   a text with any number of copies arrives as one entry per task. The owners' chains
   (entries of one hash) are written as the index.
4. Chains of more than one row are checked on the bytes: their texts are grouped as they are.

All of it is DataFrame operations. The driver sees the directory only: at most 2**16 buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlake.llm.common import ascii_lower, bounded_hint, cut, keep_one, row_key, text_of

CAPACITY = 100_000
STEP = 4
MAX_DEPTH = 16


def _prefix(depth: int):
    return F.shiftrightunsigned(F.col("h"), 64 - depth)


def directory(log: DataFrame, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Buckets as (depth, prefix), found by doubling over bounded histograms of the log.

    Each pass counts only the buckets still overfull, ``STEP`` doublings at a time.
    """
    done: list[tuple[int, int]] = []
    open_buckets, depth = [(0, 0)], 0
    while open_buckets and depth < MAX_DEPTH:
        finer = depth + STEP
        rows = log
        if depth:
            rows = log.where(_prefix(depth).isin([p for _, p in open_buckets]))
        histogram = {
            r["p"]: r
            for r in rows.groupBy(_prefix(finer).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
            .collect()
        }
        still = []
        for bucket in open_buckets:
            split = [bucket]
            while split:
                d, p = split.pop()
                inside = [histogram[q] for q in range(p << (finer - d), (p + 1) << (finer - d)) if q in histogram]
                single = not inside or min(r["lo"] for r in inside) == max(r["hi"] for r in inside)
                if d and (single or sum(r["n"] for r in inside) <= capacity):
                    done.append((d, p))
                elif d == finer:
                    still.append((d, p))
                else:
                    split += [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
        open_buckets, depth = still, finer
    return sorted(done + open_buckets, key=lambda b: b[1] << (MAX_DEPTH - b[0]))


def _with_bucket(log: DataFrame, buckets: list[tuple[int, int]]) -> DataFrame:
    """The owner of each entry, looked up in the directory (2**depth pointers, at most 2**16)."""
    top = max(d for d, _ in buckets)
    pointers = [
        (q, number)
        for number, (d, p) in enumerate(buckets)
        for q in range(p << (top - d), (p + 1) << (top - d))
    ]
    table = log.sparkSession.createDataFrame(pointers, "pointer long, bucket int")
    return log.withColumn("pointer", _prefix(top)).join(F.broadcast(table), "pointer").drop("pointer")


def find_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per row of ``docs``: its id, the copy that stays, and the size of its group.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest
    id stays; null ids rank last and of repeated rows exactly one stays. A null text counts as empty.
    An empty table gives an empty result; other columns are ignored.
    """
    norm = ascii_lower(text_of(text_col))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    log = cut(
        source.select("doc_id", row_key("doc_id", "text").alias("key"), norm.alias("norm")).select(
            "doc_id",
            "key",
            F.xxhash64("norm").alias("h"),
            F.octet_length("norm").alias("n_bytes"),
            F.sha2("norm", 256).alias("sha"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "log",
    )
    slot = ["bucket", "h", "n_bytes", "sha"]
    index = cut(
        _with_bucket(log, directory(log, capacity))
        .groupBy(*slot)
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("stays")),
        "index",
    )
    # An entry alone in its chain has no equal; every other one is compared on its bytes.
    crowded = index.groupBy("bucket", "h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    shared = cut(log.join(crowded, "h", "left_semi").select("doc_id"), "shared")
    listed = shared.where("doc_id is not null").distinct()
    texts = source.join(bounded_hint(cut(listed, "listed"), 16), "doc_id", "left_semi")
    texts = texts.unionByName(source.where("doc_id is null"))
    equal = (
        texts.select(norm.alias("norm"))
        .groupBy(F.xxhash64("norm").alias("h"), "norm")
        .agg(F.count(F.lit(1)).alias("group_size"))
        .select("h", F.sha2("norm", 256).alias("sha"), "group_size")
    )
    groups = index.where("n > 1").join(equal, ["h", "sha"]).select("h", "sha", "stays", "group_size", "n")
    checked = groups.select(
        "h",
        "sha",
        "stays",
        F.when(F.col("n") == F.col("group_size"), F.col("group_size"))
        .otherwise(F.raise_error(F.lit("equal digests of different texts")))
        .alias("group_size"),
    )
    return log.join(cut(checked, "groups"), ["h", "sha"], "left").select(
        "doc_id",
        F.when(F.col("stays").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("stays.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "key",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, its columns unchanged."""
    found = cut(find_copies(docs, id_col, text_col), "copies")
    verdicts = found.groupBy("key").agg(F.max("kept").alias("keep"), F.count(F.lit(1)).alias("copies"))
    return keep_one(docs, verdicts, id_col, text_col)
