"""Exact top-k similarity search, score thresholds, metadata filters and hit texts.

Corpora never travel whole: each task keeps the k best hits of the queries it sees and
only those leave it. Queries are shipped to every task while their number is within a
checked bound; above it, corpus and queries meet in bounded cells, of which those that cannot
hold a better hit are skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_type

from medlake.functions.vectors import SCORE_DIGITS, RunningTopK, matrix, object_ids, unit_rows
from medlake.plans.batches import slices, tidy
from medlake.plans.bounded import broadcast_if_small, fetch_if_small, vector_rows_limit
from medlake.plans.durable import cut
from medlake.plans.skew import skew_safe_join

# Retrieval defaults.
TOP_K = 10
MIN_SCORE = 0.7

MEASURES = ("dot", "cosine")
# Bytes of float64 vectors per side of one grid cell.
CELL_BYTES = 32 * 1024 * 1024
# Vectors of a batch that a task offers to the shipped queries at once.
SEARCH_ROWS = 2_048
# Groups in which the partial hits of a query are reduced first.
MERGE_GROUPS = 64
# Hit lists up to this many rows are joined to their texts without salts.
MAX_BROADCAST_HITS = 1_000_000


def conforming(df: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """Rows whose vector is present and has ``dim`` values."""
    return df.where(F.col(column).isNotNull() & (F.size(column) == dim))


def best_k(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query from partial lists, ranked from 1; ties go to the smaller id.

    Every task has a list for a query. They are reduced in ``MERGE_GROUPS`` groups by the id's hash
    first, so that no task ranks the lists of all tasks.
    """
    order = [F.desc("distance"), "id"]
    groups = hits.withColumn("__group", F.pmod(F.xxhash64("id"), F.lit(MERGE_GROUPS)))
    for keys in (["query_id", "__group"], ["query_id"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        groups = groups.withColumn("rank", rank).where(F.col("rank") <= k)
    return groups.drop("__group")


def _hit_schema(queries: DataFrame, corpus: DataFrame) -> tuple[T.StructType, pa.Schema]:
    spark_schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in spark_schema])
    return spark_schema, arrow


def _prepared(column, dim: int, measure: str) -> np.ndarray:
    m = matrix(column, dim)
    return unit_rows(m) if measure == "cosine" else m


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    dim: int,
    k: int = TOP_K,
    measure: str = "dot",
    digits: int = SCORE_DIGITS,
    max_queries: int | None = None,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """``queries(query_id, embedding)`` x ``corpus(id, embedding)`` -> query_id, id, distance, rank.

    ``distance`` is a similarity (bigger is better), rounded to ``digits``.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    queries = conforming(queries.select("query_id", "embedding"), dim)
    corpus = conforming(corpus.select("id", "embedding"), dim)
    limit = vector_rows_limit(dim) if max_queries is None else max_queries
    packed = fetch_if_small(queries, limit)
    if packed is not None:
        partial_hits = shipped_top_k(packed, corpus, queries, dim, k, measure, digits)
    else:
        from medlake.operators.tree_index import pruned_top_k  # it builds on this module

        return pruned_top_k(queries, corpus, dim, k, measure, digits, vector_rows_limit(dim, cell_bytes))[0]
    return best_k(partial_hits, k)


def shipped_top_k(
    packed: pa.Table,
    corpus: DataFrame,
    queries: DataFrame,
    dim: int,
    k: int,
    measure: str,
    digits: int,
) -> DataFrame:
    """Partial top-k per task with the (size-checked) queries sent to every executor."""
    spark_schema, arrow = _hit_schema(queries, corpus)
    query_ids = packed.column("query_id").combine_chunks()
    vectors = _prepared(packed.column("embedding"), dim, measure)
    shipped = corpus.sparkSession.sparkContext.broadcast((query_ids, vectors))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = shipped.value
        best = RunningTopK(rows, k, digits)
        for batch in slices(batches, SEARCH_ROWS):
            best.add(object_ids(batch.column("id")), _prepared(batch.column("embedding"), dim, measure))
        yield best.to_batch(ids, arrow)

    return corpus.mapInArrow(tidy(search), spark_schema)


def _cell_topk(
    left: pa.Table, right: pa.Table, dim: int, k: int, measure: str, digits: int, schema: pa.Schema
) -> pa.Table:
    best = RunningTopK(_prepared(right.column("embedding"), dim, measure), k, digits)
    best.add(object_ids(left.column("id")), _prepared(left.column("embedding"), dim, measure))
    batch = best.to_batch(right.column("query_id").combine_chunks(), schema)
    return pa.Table.from_batches([batch], schema=schema)


def grid_top_k(
    queries: DataFrame,
    corpus: DataFrame,
    dim: int,
    k: int,
    measure: str,
    digits: int = SCORE_DIGITS,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """Partial top-k where both sides carry a ``leaf`` and meet only inside equal leaves.

    Each leaf is cut into corpus blocks and query blocks of bounded size, so a leaf holding
    a third of all vectors, or probed by a third of all queries, becomes many cells. A
    vector is repeated once per query block of its leaf and a query once per corpus block.
    """
    block_rows = vector_rows_limit(dim, cell_bytes)
    blocks = (
        corpus.groupBy("leaf")
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("corpus_blocks"))
        .join(
            queries.groupBy("leaf").agg(
                F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("query_blocks")
            ),
            "leaf",
        )
    )
    # One row per leaf; the number of leaves is bounded where the index is built.
    blocks = F.broadcast(blocks)

    def deal(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        return (
            df.join(blocks, "leaf")
            .withColumn(f"{own}_block", F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")))
            .withColumn(
                f"{other}_block",
                F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}_blocks") - 1)),
            )
            .select("leaf", "corpus_block", "query_block", key, "embedding")
        )

    cell = ["leaf", "corpus_block", "query_block"]
    spark_schema, arrow = _hit_schema(queries, corpus)
    work: Callable[[pa.Table, pa.Table], pa.Table] = partial(
        _cell_topk, dim=dim, k=k, measure=measure, digits=digits, schema=arrow
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(left, right)

    return (
        deal(corpus, "id", "corpus", "query")
        .groupBy(*cell)
        .cogroup(deal(queries, "query_id", "query", "corpus").groupBy(*cell))
        .applyInArrow(search, spark_schema)
    )


def top_k_single(hits: DataFrame, k: int = TOP_K) -> DataFrame:
    """Best k hits of a one-query search as a plain ordered limit."""
    return hits.orderBy(F.desc("distance"), "id").limit(k)


def above_threshold(hits: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Hits scoring at least ``min_score``; a missing score counts as 0."""
    return hits.where(F.coalesce(F.col("distance"), F.lit(0.0)) >= min_score)


def filter_corpus(
    corpus: DataFrame, registry: DataFrame, predicate: str, registry_id: str = "document_id"
) -> DataFrame:
    """Vectors whose registry row satisfies the SQL ``predicate``, applied before the search.

    The allowed ids are stored; within the checked bound they are sent to the scan of the corpus,
    and no vector moves.
    """
    allowed = cut(registry.where(predicate).select(F.col(registry_id).alias("id")).distinct(), "allowed")
    return corpus.join(broadcast_if_small(allowed, "id"), "id", "left_semi")


def search_text(
    query_texts: DataFrame,
    corpus: DataFrame,
    embed: Callable[[DataFrame], DataFrame],
    dim: int,
    k: int = TOP_K,
    **options,
) -> DataFrame:
    """Embed ``query_texts(query_id, text)`` with ``embed`` and search."""
    return top_k(embed(query_texts), corpus, dim, k, **options)


def attach_sources(
    hits: DataFrame,
    registry: DataFrame,
    max_hits: int | None = None,
    columns: tuple[str, ...] = ("text", "source"),
) -> DataFrame:
    """Left-join the texts of hits from ``registry(id, ...)``; hits without a row stay.

    The hits are stored first: their ids and the hits themselves are read separately, and the
    scoring behind them must not run twice. The registry is then reduced to the ids that were
    hit. ``max_hits`` (queries x k) is the caller's bound on the number of hits: beyond
    ``MAX_BROADCAST_HITS`` their join is salted. The id list goes to the registry scan if its
    bytes are within the broadcast limit, and then no text is shuffled that was not hit.
    """
    hits = cut(hits, "hits")
    ids = broadcast_if_small(cut(hits.select("id").distinct(), "ids"), "id")
    texts = registry.select("id", *columns).join(ids, "id", "left_semi")
    if max_hits is not None and max_hits <= MAX_BROADCAST_HITS:
        return hits.join(texts, "id", "left")
    return skew_safe_join(hits, texts, "id", spread_by=["query_id"])


def hits_bound(queries: DataFrame, dim: int, k: int) -> int | None:
    """queries x k where the query count is within the shipping bound, else ``None``."""
    limit = vector_rows_limit(dim)
    n = queries.limit(limit + 1).count()
    return n * k if n <= limit else None
