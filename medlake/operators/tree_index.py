"""A tree of leaves over vectors, and a search that decides by bounds how many leaves a query needs.

Nodes with more than ``per_leaf`` vectors are split among at most ``FAN`` children, level by level, by k-means on a bounded
sample of each node; a node whose sample is one single point is dealt by row number. Every vector has one home leaf,
and a copy in its second best sibling where it lies near their border. Leaves keep their mean, the variance of every
coordinate and a radius.

For a query, a leaf's products lie around that with its mean and cannot exceed it by more than the query's length times
the radius. A search probes the ``first`` leaves by mean, and the k-th best score found there tells for each other leaf
how many better ones to expect in it: leaves are added until at most ``1 - target`` of the k hits are expected in those left out. With a
target of 1, every leaf within reach of the radius is searched, and the result is exact.

Vectors are written twice, as rows and in order of leaves; between, only the centers of a level are kept. A search whose queries and
leaves can be shipped stores a bit for each query and leaf and scores the vectors where they lie: neither pairs nor vectors are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlake.functions.vectors import SCORE_DIGITS, RunningTopK, _runs, leaf_scores, matrix, object_ids
from medlake.operators.search import MEASURES, SEARCH_ROWS, TOP_K, _hit_schema, _prepared, best_k, conforming
from medlake.operators.vector_index import MAX_LEAF_FILTER, VECTORS_PER_LEAF
from medlake.plans.batches import SLICE, slices, tidy
from medlake.plans.bounded import MAX_BROADCAST_BYTES, broadcast_if_small, fetch_if_small
from medlake.plans.durable import cut, remove, work_path

FAN = 32
#: Levels that leaf numbers have room for, and the level from which nodes that k-means could not make small are dealt by row number.
DEPTH = 11
DEAL_FROM = 7
#: Vectors of a node that place its children, about.
SAMPLE = 4_096
#: Rows of one node that a task assigns to children.
CHUNK = 100_000
#: A vector is copied into its second best sibling if that is farther by less than this share.
SPILL = 0.01
FIRST = 4
TARGET = 0.95
#: Part of the allowance for leaves that are weighed; the rest is for those of next to no expectation.
KEPT = 0.9
#: Queries of one leaf that a task scores at once, and leaves that a task routes at once.
QUERY_BLOCK = 4_096
LEAF_BLOCK = 4_096
#: Queries that a task routes at once; it holds some matrices of these by its leaves.
ROUTED = 128
#: Where leaves are shipped: query rows that a task routes, and products of queries and leaves that it holds at once.
ROUTE_BLOCK = 512
ROUTE_CELLS = 1_000_000
#: Bytes of masks that are shipped to a scan.
MASK_BYTES = MAX_BROADCAST_BYTES


@dataclass
class TreeIndex:
    """``vectors(id, embedding, leaf, home)`` in order of leaves; ``leaves(leaf, n, mean, variance, radius, longest)``."""

    vectors: DataFrame
    leaves: DataFrame
    dim: int
    measure: str


def _centers(vectors: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """At most ``k`` distinct k-means centers, seeded far apart; the same for the same rows in any order."""
    vectors = vectors[np.lexsort(vectors.T)]
    rng = np.random.default_rng(seed)
    chosen = [vectors[rng.integers(len(vectors))]]
    gap = ((vectors - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k and gap.max() > 1e-12:
        chosen.append(vectors[min(int(np.searchsorted(np.cumsum(gap), rng.random() * gap.sum())), len(vectors) - 1)])
        gap = np.minimum(gap, ((vectors - chosen[-1]) ** 2).sum(axis=1))
    centers = np.array(chosen)
    for _ in range(rounds if len(centers) > 1 else 0):
        near = leaf_scores(centers, vectors).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, vectors)
        counts = np.bincount(near, minlength=len(centers))
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    # Centers of copies differ by rounding only.
    return np.unique(np.round(centers, SCORE_DIGITS), axis=0)


def _split(dim: int, measure: str, per_leaf: int, deal: bool):
    """Children of one node from its sample: rows of (node, child, center)."""
    shape = pa.schema([("node", pa.int64()), ("child", pa.int64()), ("center", pa.list_(pa.float64()))])

    def run(table: pa.Table) -> pa.Table:
        node, n = table["node"][0].as_py(), table["n"][0].as_py()
        wanted = min(FAN, max(2, -(-2 * n // per_leaf)))
        centers = _centers(_prepared(table["embedding"], dim, measure), wanted, node % (1 << 32))
        if deal or len(centers) == 1:  # copies of one vector: dealt by row number
            centers = np.repeat(centers[:1], wanted, axis=0)
        children = node * FAN + np.arange(len(centers))
        return pa.table([[node] * len(centers), children, centers.tolist()], schema=shape)

    return run


def _nearest(rows: np.ndarray, vectors: np.ndarray, children: np.ndarray, centers: np.ndarray, spill: float | None):
    """The child of every row, and the second best where the row is near their border (else -1)."""
    second = np.full(len(rows), -1, dtype=np.int64)
    if len(centers) > 1 and (centers == centers[0]).all():
        return children[rows % len(children)], second
    # Rounded, so that ties do not hang on the batch that a row arrives in.
    far = np.round(np.maximum((vectors**2).sum(axis=1)[:, None] - leaf_scores(centers, vectors), 0), SCORE_DIGITS)
    order = np.argsort(far, axis=1, kind="stable")
    at = np.arange(len(rows))
    if len(centers) > 1 and spill is not None:
        best, next_best = np.sqrt(far[at, order[:, 0]]), np.sqrt(far[at, order[:, 1]])
        close = next_best <= best * (1 + spill)
        second[close] = children[order[close, 1]]
    return children[order[:, 0]], second


def _by_node(centers: pa.Table, dim: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    centers = centers.sort_by("child")
    nodes, children = centers["node"].to_numpy(), centers["child"].to_numpy()
    places = np.array(centers["center"].to_pylist(), dtype=np.float64).reshape(-1, dim)
    return {int(n): (children[nodes == n], places[nodes == n]) for n in np.unique(nodes)}


def _place(rows: np.ndarray, nodes: np.ndarray, second: np.ndarray, vectors: np.ndarray, known: dict, spill: float | None) -> None:
    """Moves every row down to its child, in ``nodes`` and ``second``, while ``known`` has the centers of its node."""
    live = np.arange(len(rows))
    while len(live):
        order = live[np.argsort(nodes[live], kind="stable")]
        moved = [(node, order[start:end]) for node, start, end in _runs(nodes[order]) if node in known]
        for node, at in moved:
            nodes[at], second[at] = _nearest(rows[at], vectors[at], *known[node], spill)
        live = np.concatenate([at for _, at in moved]) if moved else live[:0]


def _placing(types: T.StructType, dim: int, measure: str, spill: float | None):
    """``place(batch, known)``: the rows of a batch of ``types`` with their ``node`` and ``second`` as far down as ``known`` goes."""

    def place(batch: pa.RecordBatch | pa.Table, known: dict) -> pa.Table:
        new = {c: np.array(batch.column(c).to_numpy()) for c in ("node", "second")}
        _place(batch.column("row").to_numpy(), *new.values(), _prepared(batch.column("embedding"), dim, measure), known, spill)
        return pa.table([pa.array(new[c]) if c in new else batch.column(c) for c in types.names], names=types.names)

    return place


def _descend(placed: DataFrame, known: dict, dim: int, measure: str, spill: float | None) -> DataFrame:
    """``placed(row, node, second, id, embedding)`` after the levels whose centers are in ``known``. Narrow: nothing is written."""
    place = _placing(placed.schema, dim, measure, spill)
    shipped = placed.sparkSession.sparkContext.broadcast(known)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from place(batch, shipped.value).to_batches()

    return placed.mapInArrow(narrow, placed.schema)


def _descend_cells(big: DataFrame, centers: DataFrame, dim: int, measure: str, spill: float | None) -> DataFrame:
    """One level down where the centers are too many to be shipped: ``big`` has the size ``n`` of each row's node as well."""
    types = T.StructType([f for f in big.schema if f.name != "n"])
    place = _placing(types, dim, measure, spill)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return place(left.combine_chunks(), _by_node(right, dim) if len(left) else {})

    chunks = F.ceil(F.col("n") / CHUNK)
    dealt = big.withColumn("chunk", F.pmod("row", chunks))
    sizes = big.groupBy("node").agg(F.max(chunks).alias("chunks"))
    repeated = centers.join(sizes, "node").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return dealt.groupBy("node", "chunk").cogroup(repeated.groupBy("node", "chunk")).applyInArrow(meet, types)


def _summaries(dim: int, measure: str):
    """Mean, variances, radius and longest vector of one leaf."""
    lists = pa.list_(pa.float64())
    shape = pa.schema(
        [("leaf", pa.int64()), ("n", pa.int64()), ("mean", lists), ("variance", lists), ("radius", pa.float64()), ("longest", pa.float64())]
    )

    def run(table: pa.Table) -> pa.Table:
        vectors = _prepared(table["embedding"], dim, measure)
        mean = vectors.mean(axis=0)
        radius = float(np.sqrt(((vectors - mean) ** 2).sum(axis=1)).max())
        variance = ((vectors - mean) ** 2).mean(axis=0)
        longest = float(np.sqrt((vectors**2).sum(axis=1)).max())
        return pa.table([[table["leaf"][0].as_py()], [len(vectors)], [mean.tolist()], [variance.tolist()], [radius], [longest]], schema=shape)

    return run, "leaf long, n long, mean array<double>, variance array<double>, radius double, longest double"


def build_tree(
    corpus: DataFrame, dim: int, per_leaf: int = VECTORS_PER_LEAF, measure: str = "dot", spill: float | None = SPILL, sample: int = SAMPLE
) -> TreeIndex:
    """The index of ``corpus(id, embedding)``; vectors that are null or of another dimension take no part.

    No leaf is home to more than ``per_leaf`` vectors, however many of them are equal. Repeated ids are indexed each, and an
    empty corpus gives an index without leaves. ``spill=None`` makes no copies.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    spark, none = corpus.sparkSession, F.lit(-1).cast("long").alias("second")
    rows = conforming(corpus.select("id", "embedding"), dim).select(
        F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("node"), none, "id", "embedding"
    )
    path, stored = _written(rows)
    placed, known, held, small = stored, {}, 0, MAX_BROADCAST_BYTES // (8 * dim)
    for level in range(DEPTH + 1):
        # The least row of a node is always in its sample, which is never empty then.
        sizes = cut(placed.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("least")), "tree-sizes")
        large = F.col("n") > per_leaf
        if level == DEPTH or sizes.where(large).isEmpty():
            break
        big = placed.join(_small(sizes.where(large)), "node")
        draw = F.pmod(F.xxhash64("row", F.lit(level)), F.lit(1 << 20)) / float(1 << 20)
        drawn = big.where((draw < F.lit(float(sample)) / F.col("n")) | (F.col("row") == F.col("least")))
        shape = "node long, child long, center array<double>"
        split = _split(dim, measure, per_leaf, level >= DEAL_FROM)
        centers = cut(drawn.select("node", "n", "embedding").groupBy("node").applyInArrow(split, shape), "tree-centers")
        more = centers.limit(small + 1).count()
        if known and held + more > small:  # the centers so far make way for others
            old, (path, stored) = path, _written(placed)
            remove(spark, old)
            placed, known, held = stored, {}, 0
            big = placed.join(_small(sizes.where(large)), "node")
        if more <= small:
            known, held = known | _by_node(centers.toArrow(), dim), held + more
            placed = _descend(stored, known, dim, measure, spill)
        else:
            done = placed.join(_small(sizes.where(~large)), "node").select(*stored.columns)
            lower = _descend_cells(big.select(*stored.columns, "n"), centers, dim, measure, spill)
            old, (path, stored) = path, _written(done.unionByName(lower))
            remove(spark, old)
            placed = stored
    places = F.array(*[F.struct(F.col(c).alias("leaf"), F.lit(c == "node").alias("home")) for c in ("node", "second")])
    homes = placed.select("id", "embedding", F.inline(places)).where("leaf >= 0")
    # A copy has no leaf to lie in where its second best node was split.
    leaves = _small(sizes.select("node")).select(F.col("node").alias("leaf"), F.lit(True).alias("held"))
    vectors = homes.join(leaves, "leaf", "left").where("home OR held").select("id", "embedding", "leaf", "home")
    vectors = cut(vectors.repartitionByRange("leaf").sortWithinPartitions("leaf"), "tree-vectors")
    remove(spark, path)
    run, shape = _summaries(dim, measure)
    summaries = vectors.select("leaf", "embedding").groupBy("leaf").applyInArrow(run, shape)
    return TreeIndex(vectors, cut(summaries, "tree-summaries"), dim, measure)


def _written(rows: DataFrame) -> tuple[str, DataFrame]:
    """Like ``cut``, with the path, for a table that is removed once nothing reads it."""
    path = work_path(rows.sparkSession, "tree-rows")
    rows.write.parquet(path)
    return path, rows.sparkSession.read.schema(rows.schema).parquet(path)


def _small(nodes: DataFrame) -> DataFrame:
    return broadcast_if_small(nodes, "node")


def write_tree(index: TreeIndex, path: str) -> None:
    """Vectors in order of leaves, so that a scan of some leaves skips the files of others, and the summaries."""
    index.vectors.repartitionByRange("leaf").sortWithinPartitions("leaf").write.mode("overwrite").parquet(f"{path}/vectors")
    index.leaves.write.mode("overwrite").parquet(f"{path}/leaves")


def read_tree(spark: SparkSession, path: str, dim: int, measure: str = "dot") -> TreeIndex:
    return TreeIndex(spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/leaves"), dim, measure)


def _tail(x: np.ndarray) -> np.ndarray:
    """Share of a normal distribution above ``x`` deviations."""
    return 0.5 * np.vectorize(math.erfc, otypes=[float])(np.clip(x, -30, 30) / math.sqrt(2))


def _outlook(vectors: np.ndarray, floor: np.ndarray, leaves: pa.Table, means: np.ndarray, variances: np.ndarray):
    """What ``choose`` of ``_meetings`` is told of each query and leaf."""
    length = np.sqrt((vectors**2).sum(axis=1))[:, None]
    middle = vectors @ means.T
    reach = np.minimum(middle + length * leaves["radius"].to_numpy(), length * leaves["longest"].to_numpy())
    spread = np.sqrt(np.maximum((vectors**2) @ variances.T, 1e-24))
    return floor[:, None], middle, reach + np.abs(reach) * 1e-9 + 1e-12, spread, leaves["n"].to_numpy()


def _meetings(queries: DataFrame, m: int, index: TreeIndex, leaves: int, choose) -> DataFrame:
    """``(query_id, leaf, weight)`` chosen where every block of the ``m`` queries meets every block of leaves.

    ``choose(floor, middle, reach, spread, n)`` returns a mask and weights, a row per query and a column per leaf: products lie
    around ``middle`` by ``spread`` and are at most ``reach``; ``floor`` is the score to beat, if known.
    """
    dim, measure = index.dim, index.measure
    id_type = queries.schema["query_id"].dataType
    types = T.StructType([T.StructField("query_id", id_type), T.StructField("leaf", T.LongType()), T.StructField("weight", T.DoubleType())])

    def route(asked: pa.Table, leaves: pa.Table, means: np.ndarray, variances: np.ndarray) -> pa.Table:
        vectors = _prepared(asked["embedding"], dim, measure)
        floor = asked["floor"].to_numpy(zero_copy_only=False).astype(float)
        floor = np.where(np.isnan(floor), -np.inf, floor)
        take, weight = choose(*_outlook(vectors, floor, leaves, means, variances))
        q, leaf = np.nonzero(take)
        columns = [asked["query_id"].combine_chunks().take(pa.array(q)), leaves["leaf"].combine_chunks().take(pa.array(leaf)), weight[q, leaf]]
        return pa.table(columns, names=["query_id", "leaf", "weight"])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks().sort_by("leaf")
        means, variances = (matrix(right[c], dim) for c in ("mean", "variance"))
        # At least one slice, so that no queries make an empty table of the right types.
        starts = range(0, max(1, len(left)), ROUTED)
        return pa.concat_tables([route(left.slice(start, ROUTED), right, means, variances) for start in starts])

    blocks, shelves = max(1, -(-m // QUERY_BLOCK)), max(1, -(-leaves // LEAF_BLOCK))
    left = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    left = left.withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))
    right = index.leaves.withColumn("shelf", F.pmod(F.xxhash64("leaf"), F.lit(shelves)).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return left.groupBy("block", "shelf").cogroup(right.groupBy("block", "shelf")).applyInArrow(meet, types)


def _highest(weight: np.ndarray, take: np.ndarray, most: int) -> np.ndarray:
    """``take`` with at most the ``most`` highest weights of each row."""
    if weight.shape[1] <= most:
        return take
    weight = np.where(take, weight, -np.inf)
    best = np.argsort(-weight, axis=1, kind="stable")[:, :most]
    out = np.zeros_like(take)
    np.put_along_axis(out, best, True, axis=1)
    return out & take


def _scored(queries: DataFrame, routes: DataFrame, index: TreeIndex, k: int, digits: int) -> DataFrame:
    """Partial hits of the queries in the leaves that ``routes(query_id, leaf)`` names for them.

    A leaf asked for by many queries is scored in blocks of them; leaves are bounded by themselves. Few
    leaves become a filter of the scan.
    """
    dim, measure = index.dim, index.measure
    wanted = routes.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
    wanted = cut(wanted, "wanted-leaves")
    vectors = index.vectors.select("id", "embedding", "leaf")
    listed = [r["leaf"] for r in wanted.select("leaf").limit(MAX_LEAF_FILTER + 1).collect()]
    if len(listed) <= MAX_LEAF_FILTER:
        vectors = vectors.where(F.col("leaf").isin(listed)) if listed else vectors.limit(0)
        side = F.broadcast(wanted)  # as many rows as listed
    else:
        side = broadcast_if_small(wanted, "leaf")
    block = F.pmod(F.xxhash64("query_id"), F.col("blocks"))
    asked = routes.join(side, "leaf").withColumn("block", block).join(queries.select("query_id", "embedding"), "query_id")
    asked = asked.select("leaf", "block", "query_id", "embedding")
    held = vectors.join(side, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    held = held.select("leaf", "block", "id", "embedding")
    spark_schema, arrow = _hit_schema(queries, vectors)
    # A vector near a border may come from two leaves.
    most = 2 * k

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return arrow.empty_table()
        best = RunningTopK(_prepared(right["embedding"], dim, measure), most, digits)
        best.add(object_ids(left["id"]), _prepared(left["embedding"], dim, measure))
        return pa.Table.from_batches([best.to_batch(right["query_id"].combine_chunks(), arrow)])

    return held.groupBy("leaf", "block").cogroup(asked.groupBy("leaf", "block")).applyInArrow(meet, spark_schema)


def _floors(queries: DataFrame, hits: DataFrame | None, k: int) -> DataFrame:
    """``queries`` with ``floor``, the k-th best score among ``hits``, null where there are fewer."""
    if hits is None:
        return queries.withColumn("floor", F.lit(None).cast("double"))
    return queries.join(_kth_best(hits, k), "query_id", "left")


def _kth_best(hits: DataFrame, k: int) -> DataFrame:
    return best_k(hits, k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("distance")).alias("floor"))


@dataclass
class _Shipped:
    """Queries and leaves that every task gets: rows of queries in order of their ids, leaves in order of their numbers.

    ``starts`` has the first row of each id and, at the end, the number of rows; ``blocks`` the first row and the end of what a task
    routes at once, whole ids; ``floor`` the k-th best score known of each row.
    """

    ids: pa.Array
    vectors: np.ndarray
    starts: np.ndarray
    blocks: list[tuple[int, int]]
    floor: np.ndarray
    leaves: pa.Table
    means: np.ndarray
    variances: np.ndarray

    @classmethod
    def of(cls, queries: DataFrame, index: TreeIndex) -> _Shipped | None:
        """``None`` where there are too many of either, or of the rows of one id."""
        dim = index.dim
        packed = fetch_if_small(queries, MAX_BROADCAST_BYTES // (8 * dim))
        leaves = None if packed is None else fetch_if_small(index.leaves, MAX_BROADCAST_BYTES // (16 * dim))
        if leaves is None:
            return None
        numbers: dict[str, int] = {}
        group = np.array([numbers.setdefault(repr(one), len(numbers)) for one in packed["query_id"].to_pylist()], dtype=np.int64)
        order = np.argsort(group, kind="stable")
        starts = np.append(np.flatnonzero(np.diff(group[order], prepend=-1)), len(group))
        if len(group) and np.diff(starts).max() > ROUTED:
            return None
        packed, leaves = packed.take(pa.array(order)), leaves.sort_by("leaf")
        means, variances = (matrix(leaves[c], dim) for c in ("mean", "variance"))
        vectors, ids = _prepared(packed["embedding"], dim, index.measure), packed["query_id"].combine_chunks()
        # Two blocks for each core at least.
        rows = min(ROUTE_BLOCK, -(-len(ids) // (2 * index.vectors.sparkSession.sparkContext.defaultParallelism)))
        blocks, begin = [], 0
        while begin < len(ids):
            end = int(starts[np.searchsorted(starts, min(begin + rows, len(ids)))])
            blocks.append((begin, end))
            begin = end
        leaves, floor = leaves.drop_columns(["mean", "variance"]).combine_chunks(), np.full(len(ids), -np.inf)
        return cls(ids, vectors, starts, blocks, floor, leaves, means, variances)

    def learn(self, floors: pa.Table) -> None:
        known = dict(zip(map(repr, floors["query_id"].to_pylist()), floors["floor"].to_pylist()))
        found = [known.get(repr(one)) for one in self.ids.to_pylist()]
        self.floor = np.array([-np.inf if x is None else x for x in found], dtype=float)


#: A row for each block and leaf that is chosen for a query of the block: bit i stands for the query row ``first + i``.
_MASKS = "first long, leaf long, rows binary"


def _bits(masks: pa.Table | pa.RecordBatch) -> np.ndarray:
    """The masks of one block, a row of booleans for each."""
    data = np.frombuffer(b"".join(masks.column("rows").to_pylist()), dtype=np.uint8).reshape(len(masks), -1)
    return np.unpackbits(data, axis=1, bitorder="little").astype(bool)


def _routes(index: TreeIndex, shipped: _Shipped, choose, count, without: DataFrame | None = None) -> DataFrame:
    """The leaves of each query as masks: of what ``choose`` takes, the ``count(weights)`` of the highest weights.

    Rows of one query id have one list. Leaves that ``without`` has for an id are left out first.
    """
    spark, blocks = index.vectors.sparkSession, shipped.blocks
    # A few leaves for each query.
    past = None if without is None else without.toArrow()
    known = (shipped.ids, shipped.vectors, shipped.starts, shipped.floor, shipped.leaves, shipped.means, shipped.variances, past)
    sent = spark.sparkContext.broadcast(known)

    def route(begin: int, end: int) -> np.ndarray:
        ids, vectors, starts, floor, leaves, means, variances, past = sent.value
        seen, out = np.zeros((2, end - begin, len(leaves)), dtype=bool)
        if past is not None and len(past := past.filter(pc.equal(past["first"], begin))):
            seen[:, np.searchsorted(leaves["leaf"].to_numpy(), past["leaf"].to_numpy())] = _bits(past)[:, : end - begin].T
            seen[ids.slice(begin, end - begin).is_null().to_numpy(zero_copy_only=False)] = False  # null ids never meet
        starts = starts[(starts >= begin) & (starts <= end)]
        step = max(1, ROUTE_CELLS // max(1, len(leaves) * int(np.diff(starts).max())))
        for i in range(0, len(starts) - 1, step):
            groups = starts[i : i + step + 1]
            zero, part = groups[0], slice(groups[0], groups[-1])
            take, weight = choose(*_outlook(vectors[part], floor[part], leaves, means, variances))
            for a, b in zip(groups[:-1], groups[1:]):
                leaf, row = np.nonzero((take[a - zero : b - zero] & ~seen[a - begin : b - begin].any(axis=0)).T)
                weights = weight[a - zero + row, leaf]
                order = np.argsort(-weights, kind="stable")
                order = order[: count(weights[order])]
                out[a - begin + row[order], leaf[order]] = True
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sent.value[4]["leaf"].combine_chunks()
        for batch in batches:
            for begin, end in (blocks[i] for i in batch.column("id").to_pylist()):
                taken = route(begin, end)
                some = np.flatnonzero(taken.any(axis=0))
                rows = [mask.tobytes() for mask in np.packbits(taken[:, some].T, axis=1, bitorder="little")]
                columns = [pa.array(np.full(len(some), begin, dtype=np.int64)), numbers.take(pa.array(some)), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["first", "leaf", "rows"])

    tasks = spark.range(0, len(blocks), 1, max(1, len(blocks)))
    return tasks.mapInArrow(tidy(run), _MASKS)


def _scored_in_place(queries: DataFrame, index: TreeIndex, shipped: _Shipped, masks: DataFrame, k: int, digits: int) -> DataFrame:
    """Partial hits that reach the scores known, found where the vectors lie: a task keeps the k best of every query.

    Masks beyond the bound of what is shipped at once make another scan for each further lot of queries.
    """
    blocks, parts = shipped.blocks, []
    lot = max(1, 8 * MASK_BYTES // max(1, len(shipped.leaves) * max((b - a for a, b in blocks), default=1)))
    for i in range(0, len(blocks), lot):
        begin, end = blocks[i][0], blocks[min(i + lot, len(blocks)) - 1][1]
        table = masks.where(F.col("first").between(begin, end - 1)).toArrow().sort_by("leaf").combine_chunks()
        if len(table):
            parts.append(_scan(queries, index, shipped, table, begin, end, k, digits))
    found = parts[0] if parts else index.vectors.sparkSession.createDataFrame([], _hit_schema(queries, index.vectors)[0])
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _scan(
    queries: DataFrame, index: TreeIndex, shipped: _Shipped, masks: pa.Table, begin: int, end: int, k: int, digits: int
) -> DataFrame:
    """``_scored_in_place`` for the query rows from ``begin`` to ``end``, with their ``masks`` in order of leaves."""
    spark_schema, arrow = _hit_schema(queries, index.vectors)
    dim, measure, vectors = index.dim, index.measure, index.vectors.select("id", "embedding", "leaf")
    listed = masks["leaf"].unique().to_pylist()
    if len(listed) <= min(MAX_LEAF_FILTER, len(shipped.leaves) // 2):
        vectors = vectors.where(F.col("leaf").isin(listed))
    ids = shipped.ids.slice(begin, end - begin)
    # Rows of one id are asked for together; null ids never meet.
    sizes = np.diff(shipped.starts)
    group, named = np.repeat(np.arange(len(sizes)), sizes)[begin:end], ids.is_valid().to_numpy(zero_copy_only=False)
    alone = not len(group) or len(np.unique(group)) == len(group) and named.all()
    sent = index.vectors.sparkSession.sparkContext.broadcast(
        (ids, shipped.vectors[begin:end], shipped.floor[begin:end], None if alone else (group, named), masks)
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked, floor, several, masks = sent.value
        leaves, firsts, bits = masks["leaf"].to_numpy(), masks["first"].to_numpy() - begin, masks["rows"].combine_chunks()
        best = RunningTopK(asked, k, digits, floor, distinct=True)

        def wanted(leaf: int) -> np.ndarray:
            rows = [np.empty(0, dtype=np.int64)]
            for at in range(*np.searchsorted(leaves, [leaf, leaf + 1])):
                mask = np.unpackbits(np.frombuffer(bits[at].as_py(), dtype=np.uint8), bitorder="little")
                rows.append(firsts[at] + np.flatnonzero(mask))
            rows = np.concatenate(rows)
            return rows if several is None else np.flatnonzero(np.isin(several[0], several[0][rows]) & several[1])

        for batch in slices(batches, SEARCH_ROWS):
            leaf = batch.column("leaf").to_numpy()
            names, rows = object_ids(batch.column("id")), _prepared(batch.column("embedding"), dim, measure)
            order = np.argsort(leaf, kind="stable")
            for one, a, b in _runs(leaf[order]):
                best.add(names[order[a:b]], rows[order[a:b]], wanted(one))
        yield best.to_batch(ids, arrow)

    return vectors.mapInArrow(tidy(search), spark_schema)


def _named(masks: DataFrame, shipped: _Shipped, queries: DataFrame) -> DataFrame:
    """The masks as rows ``(query_id, leaf)``, made where they are read."""
    types = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("leaf", T.LongType())])
    sent = masks.sparkSession.sparkContext.broadcast(shipped.ids)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            for first, a, b in _runs(batch.column("first").to_numpy()):
                at, row = np.nonzero(_bits(batch.slice(a, b - a)))
                leaf = batch.column("leaf").slice(a, b - a).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([sent.value.take(pa.array(first + row)), leaf], names=["query_id", "leaf"])

    return masks.mapInArrow(name, types)


def search_tree(
    queries: DataFrame, index: TreeIndex, k: int = TOP_K, target: float = TARGET, first: int = FIRST, digits: int = SCORE_DIGITS
) -> tuple[DataFrame, DataFrame]:
    """The hits ``(query_id, id, distance, rank)`` of ``queries(query_id, embedding)``, and the leaves ``(query_id, leaf)`` searched.

    ``target`` is the share of the true hits to be expected among those found; 1 gives the exact result. Query ids are unique; rows
    of the corpus alike in id and score are one hit.
    """
    if target >= 1:
        return exact_search(queries, index, k, first, digits)
    queries = cut(conforming(queries.select("query_id", "embedding"), index.dim), "tree-queries")
    shipped = _Shipped.of(queries, index)
    m, leaves = (queries.count(), index.leaves.count()) if shipped is None else (len(shipped.ids), len(shipped.leaves))
    allowed, ignored, slack = (1 - target) * k * KEPT, (1 - target) * k * (1 - KEPT) / max(1, leaves), 10.0**-digits

    def best_means(floor, middle, reach, spread, n):
        return _highest(middle, np.ones_like(middle, dtype=bool), first), middle

    def expected_hits(floor, middle, reach, spread, n):
        expected = n * _tail((floor - middle) / spread)
        return (reach >= floor - slack) & (expected >= ignored), expected

    if shipped is not None:
        begun = cut(_routes(index, shipped, best_means, lambda weights: first), "tree-begun")
        hits = cut(_scored_in_place(queries, index, shipped, begun, k, digits).dropDuplicates(["query_id", "id", "distance"]), "tree-hits")
        shipped.learn(_kth_best(hits, k).toArrow())

        def within(weights):
            # Leaves of the highest expectation first, until what is left out is within the allowance.
            before = np.cumsum(weights) - weights
            return int((weights.sum() - before > allowed).sum())

        more = cut(_routes(index, shipped, expected_hits, within, begun), "tree-more")
        rest = _scored_in_place(queries, index, shipped, more, k, digits)
        found = best_k(hits.unionByName(rest).dropDuplicates(["query_id", "id", "distance"]), k)
        return found, _named(begun.unionByName(more), shipped, queries)
    by_weight = Window.partitionBy("query_id").orderBy(F.desc("weight"), "leaf")
    begun = _meetings(_floors(queries, None, k), m, index, leaves, best_means).withColumn("nth", F.row_number().over(by_weight))
    begun = cut(begun.where(F.col("nth") <= first).select("query_id", "leaf"), "tree-begun")
    hits = cut(_scored(queries, begun, index, k, digits).dropDuplicates(["query_id", "id", "distance"]), "tree-hits")
    more = _meetings(_floors(queries, hits, k), m, index, leaves, expected_hits).join(begun, ["query_id", "leaf"], "left_anti")
    # Leaves of the highest expectation first, until what is left out is within the allowance.
    before = F.sum("weight").over(by_weight.rowsBetween(Window.unboundedPreceding, -1))
    left_out = F.sum("weight").over(Window.partitionBy("query_id")) - F.coalesce(before, F.lit(0.0))
    more = more.withColumn("left_out", left_out).where(F.col("left_out") > allowed)
    more = cut(more.select("query_id", "leaf"), "tree-more")
    rest = _scored(queries, more, index, k, digits)
    found = best_k(hits.unionByName(rest).dropDuplicates(["query_id", "id", "distance"]), k)
    return found, begun.unionByName(more)


def exact_search(
    queries: DataFrame, index: TreeIndex, k: int = TOP_K, first: int = FIRST, digits: int = SCORE_DIGITS
) -> tuple[DataFrame, DataFrame]:
    """Like ``search_tree`` with the exact result: leaves by what they can reach at most, from round to round.

    A round searches the next leaves of every query, four times as many as the one before, as long as they can reach
    the k-th best score that the rounds before have found.
    """
    queries = cut(conforming(queries.select("query_id", "embedding"), index.dim), "tree-queries")
    m, leaves, slack = queries.count(), index.leaves.count(), 10.0**-digits
    begin, step, hits, searched = 0, first, None, []
    copied = not index.vectors.where(~F.col("home")).isEmpty()
    by_weight = Window.partitionBy("query_id").orderBy(F.desc("weight"), "leaf")
    while begin < leaves:
        end = begin + step

        def in_reach(floor, middle, reach, spread, n, end=end):
            return _highest(reach, reach >= floor - slack, end), reach

        near = _meetings(_floors(queries, hits, k), m, index, leaves, in_reach).withColumn("nth", F.row_number().over(by_weight))
        near = cut(near.where((F.col("nth") > begin) & (F.col("nth") <= end)).select("query_id", "leaf"), "tree-near")
        if near.isEmpty():
            break
        found = _scored(queries, near, index, k, digits)
        merged = found if hits is None else hits.unionByName(found)
        if copied:
            merged = merged.dropDuplicates(["query_id", "id", "distance"])
        hits = cut(best_k(merged, k).drop("rank"), "tree-hits")
        searched.append(near)
        begin, step = end, step * 4
    if hits is None:
        none = _scored(queries, index.leaves.limit(0).select("leaf").join(queries.select("query_id"), F.lit(False)), index, k, digits)
        return best_k(none, k), queries.select("query_id", F.lit(0).cast("long").alias("leaf")).limit(0)
    every = searched[0]
    for one in searched[1:]:
        every = every.unionByName(one)
    return best_k(hits, k), every


def pruned_top_k(
    queries: DataFrame, corpus: DataFrame, dim: int, k: int, measure: str, digits: int, block_rows: int, first: int = FIRST
) -> tuple[DataFrame, DataFrame, TreeIndex]:
    """Exact top-k where neither side can be shipped: hits, the cells ``(query_id, leaf)`` that met, and the blocks.

    The corpus is dealt into blocks of nearby vectors, at most ``block_rows`` each; a block that cannot reach
    the scores that a query has already is not met.
    """
    index = build_tree(corpus, dim, block_rows, measure, spill=None)
    return *exact_search(queries, index, k, first, digits), index


def share_searched(searched: DataFrame, index: TreeIndex) -> DataFrame:
    """Per query: vectors in the leaves searched, as a share of all."""
    total = index.vectors.where("home").count()
    sizes = searched.join(broadcast_if_small(index.leaves.select("leaf", "n"), "leaf"), "leaf")
    return sizes.groupBy("query_id").agg((F.sum("n") / F.lit(max(1, total))).alias("share"))
