"""Clustered vector tables: latest-wins upsert, leaves, and search of the best leaves."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlake.functions.vectors import (
    SCORE_DIGITS,
    RunningTopK,
    best_leaves,
    matrix,
    object_ids,
    unit_rows,
)
from medlake.operators.search import (
    CELL_BYTES,
    MEASURES,
    TOP_K,
    _hit_schema,
    _prepared,
    best_k,
    conforming,
    grid_top_k,
)
from medlake.plans.bounded import MAX_BROADCAST_BYTES, fetch_if_small, vector_rows_limit
from medlake.plans.durable import cut

# Index settings.
VECTORS_PER_LEAF = 1000
PROBE_SHARE = 0.1

# Vectors used to place the centroids; every vector is assigned to a leaf afterwards.
TRAIN_ROWS = 1_000_000
FILE_ROWS = 250_000
# Longest list of leaves written into a scan filter.
MAX_LEAF_FILTER = 20_000


def upsert_latest(
    current: DataFrame, changes: DataFrame, key: str = "id", version: str = "version"
) -> DataFrame:
    """Union of both tables with the highest version of each key; changes win ties.

    ``max_by`` keeps one row per key and task before the shuffle, so a key rewritten in a
    third of all rows costs no more than any other.
    """
    sides = [df.withColumn("__side", F.lit(n)) for n, df in enumerate((current, changes))]
    return latest(sides[0].unionByName(sides[1]), key, version, ["__side"]).drop("__side")


def latest(
    rows: DataFrame, key: str = "id", version: str = "version", ties: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the highest version, null the lowest of all.

    Of equal versions the one with the highest ``ties`` columns wins, then the highest hash of the
    row, so that no partitioning or retry changes the winner.
    """
    others = [c for c in rows.columns if c != key]
    rank = F.struct(F.col(version).isNotNull(), version, *ties, F.xxhash64(*others))
    return (
        rows.groupBy(key)
        .agg(F.max_by(F.struct(*others), rank).alias("__row"))
        .select(key, *[F.col(f"__row.{c}").alias(c) for c in others])
        .select(*rows.columns)
    )


def leaf_count(rows: int, dim: int, per_leaf: int = VECTORS_PER_LEAF) -> int:
    """About one leaf per ``per_leaf`` vectors, bounded so the centroids can be shipped."""
    return max(1, min(-(-rows // per_leaf), vector_rows_limit(dim)))


def train_leaves(
    corpus: DataFrame,
    dim: int,
    leaves: int | None = None,
    measure: str = "dot",
    seed: int = 42,
    train_rows: int = TRAIN_ROWS,
    max_iter: int = 10,
) -> np.ndarray:
    """Centroids (leaves x dim) of ``corpus(id, embedding)`` by Spark's k-means."""
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    vectors = conforming(corpus, dim).select("embedding")
    rows = vectors.count()
    if rows == 0:
        raise ValueError("cannot build leaves for an empty corpus")
    k = min(leaves or leaf_count(rows, dim), rows)
    if rows > train_rows:
        vectors = vectors.sample(fraction=train_rows / rows, seed=seed)
    if k == 1:
        return np.zeros((1, dim))
    features = vectors.select(array_to_vector("embedding").alias("features"))
    model = KMeans(
        k=k,
        seed=seed,
        maxIter=max_iter,
        distanceMeasure="cosine" if measure == "cosine" else "euclidean",
    ).fit(features)
    return np.array(model.clusterCenters())


def assign_leaves(
    corpus: DataFrame, centroids: np.ndarray, dim: int, measure: str = "dot"
) -> DataFrame:
    """Append ``leaf int``, the nearest centroid. Narrow: no shuffle."""
    schema = T.StructType(corpus.schema.fields + [T.StructField("leaf", T.IntegerType())])
    shipped = corpus.sparkSession.sparkContext.broadcast(_unit(centroids, measure))
    corpus = conforming(corpus, dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _prepared(batch.column(batch.schema.get_field_index("embedding")), dim, measure)
            leaf = best_leaves(shipped.value, vectors, 1)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"]
            )

    return corpus.mapInArrow(assign, schema)


def _unit(m: np.ndarray, measure: str) -> np.ndarray:
    return unit_rows(m) if measure == "cosine" else m


def probe_leaves(
    queries: DataFrame,
    centroids: np.ndarray,
    dim: int,
    probes: int | None = None,
    measure: str = "dot",
) -> DataFrame:
    """Append ``leaves array<int>``: the leaves to search for each query."""
    n = probes or max(1, round(len(centroids) * PROBE_SHARE))
    n = min(n, len(centroids))
    schema = T.StructType(
        queries.schema.fields + [T.StructField("leaves", T.ArrayType(T.IntegerType()))]
    )
    shipped = queries.sparkSession.sparkContext.broadcast(_unit(centroids, measure))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _prepared(batch.column(batch.schema.get_field_index("embedding")), dim, measure)
            order = best_leaves(shipped.value, vectors, n)
            offsets = pa.array(np.arange(0, (len(order) + 1) * n, n, dtype=np.int32))
            leaves = pa.ListArray.from_arrays(offsets, pa.array(order.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, leaves], names=[*batch.schema.names, "leaves"]
            )

    return conforming(queries, dim).mapInArrow(probe, schema)


def write_index(assigned: DataFrame, centroids: np.ndarray, path: str, file_rows: int = FILE_ROWS) -> None:
    """Vectors as a table partitioned by leaf, centroids as a small table beside it.

    A leaf is dealt over as many files as its size asks for, so a crowded leaf is written
    by several tasks and a small one by a single task. Vectors are assigned to leaves once.
    """
    assigned = cut(assigned, "assigned")
    files = assigned.groupBy("leaf").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(file_rows)).alias("files")
    )
    (
        assigned.join(F.broadcast(files), "leaf")
        .withColumn("__file", F.pmod(F.xxhash64("id"), F.col("files")))
        .repartition("leaf", "__file")
        .drop("files", "__file")
        .write.mode("overwrite")
        .partitionBy("leaf")
        .parquet(f"{path}/vectors")
    )
    spark = assigned.sparkSession
    rows = [(i, c.tolist()) for i, c in enumerate(centroids)]
    spark.createDataFrame(rows, "leaf int, centroid array<double>").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/centroids")


def read_index(spark: SparkSession, path: str, dim: int) -> tuple[DataFrame, np.ndarray]:
    table = spark.read.parquet(f"{path}/centroids").orderBy("leaf").toArrow()
    return spark.read.parquet(f"{path}/vectors"), matrix(table.column("centroid"), dim)


def approx_top_k(
    queries: DataFrame,
    index: DataFrame,
    centroids: np.ndarray,
    dim: int,
    k: int = TOP_K,
    probes: int | None = None,
    measure: str = "dot",
    digits: int = SCORE_DIGITS,
    max_queries: int | None = None,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """Top-k among the vectors of each query's best leaves, scored exactly there."""
    queries = probe_leaves(queries.select("query_id", "embedding"), centroids, dim, probes, measure)
    index = conforming(index.select("id", "embedding", "leaf"), dim)
    probed = min(len(centroids), probes or max(1, round(len(centroids) * PROBE_SHARE)))
    # The driver holds the leaves of every query as well, as Python numbers.
    limit = min(vector_rows_limit(dim), max(1, MAX_BROADCAST_BYTES // (40 * probed))) if max_queries is None else max_queries
    packed = fetch_if_small(queries, limit)
    if packed is None:
        spread = cut(queries, "queries").select(
            "query_id", "embedding", F.explode("leaves").alias("leaf")
        )
        return best_k(grid_top_k(spread, index, dim, k, measure, digits, cell_bytes), k)
    return best_k(_shipped_leaves(packed, index, queries, dim, k, measure, digits), k)


def _shipped_leaves(
    packed: pa.Table,
    index: DataFrame,
    queries: DataFrame,
    dim: int,
    k: int,
    measure: str,
    digits: int,
) -> DataFrame:
    spark_schema, arrow = _hit_schema(queries, index)
    interested: dict[int, list[int]] = {}
    for row, leaves in enumerate(packed.column("leaves").to_pylist()):
        for leaf in leaves:
            interested.setdefault(leaf, []).append(row)
    rows_of = {leaf: np.array(rows) for leaf, rows in interested.items()}
    if len(rows_of) <= MAX_LEAF_FILTER:  # prunes partitions of a written index
        index = index.where(f"leaf IN ({', '.join(map(str, sorted(rows_of)))})")
    shipped = index.sparkSession.sparkContext.broadcast(
        (
            packed.column("query_id").combine_chunks(),
            _prepared(packed.column("embedding"), dim, measure),
            rows_of,
        )
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, wanted = shipped.value
        best = RunningTopK(vectors, k, digits)
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            names, rows = object_ids(batch.column("id")), _prepared(batch.column("embedding"), dim, measure)
            for one in np.unique(leaf):
                if one in wanted:
                    at = leaf == one
                    best.add(names[at], rows[at], wanted[one])
        yield best.to_batch(ids, arrow)

    return index.mapInArrow(search, spark_schema)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query: share of the exact hits that the approximate search returned."""
    matched = found.select("query_id", "id", F.lit(1).alias("hit"))
    return (
        exact.join(matched, ["query_id", "id"], "left")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("expected"), F.count("hit").alias("matched"))
        .withColumn("recall", F.col("matched") / F.col("expected"))
    )
