"""Exact top-k by inner product with norm buckets.

Vectors are sorted by length and cut into buckets; a block of queries meets a bucket at once. For a query whose k-th best product
so far is t, a bucket of longest length l can only add a vector whose cosine with the query is at least t / (|q| l), the
local threshold. Above 1 the bucket is skipped. A high local threshold prunes by coordinates: the products of the bucket's strongest
coordinates plus the lengths of what is left bound the cosine. A low one prunes by length: vectors
shorter than t / |q| are left out. What remains is verified by integer products, as one matrix product per block and bucket.

The corpus is dealt into cells of bounded size, each with buckets of its own, and the queries into blocks; a
task works on one cell and one block, starting from thresholds that the longest vectors give.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlake.llm.common import bounded_hint, cut

BUCKET = 512
#: Rows of the corpus in a cell and of the queries in a block, about.
CELL = 16_384
BLOCK = 1_024
#: Longest vectors that give the first thresholds.
SEEDS = 512
#: Local thresholds from which coordinates prune better than lengths.
STEEP = 0.6
COORDINATES = 8
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)
NONE = LONG.min


def scaled(vector_col: str, factor: float = 64.0) -> Column:
    """floor(factor * x) of every component x, as a whole double."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * F.lit(factor)
        # Beyond 2**52 every double is whole.
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector_col, whole)


def usable(vector_col: str, factor: float = 64.0) -> Column:
    """Not null, and every component finite, before and after scaling."""
    fits = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * F.lit(factor)) < float("inf")))
    return F.col(vector_col).isNotNull() & fits


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of numbers as rows of ``dim`` columns, shorter ones filled with zeros."""
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim).astype(np.float64)
    out = np.zeros((len(lengths), dim))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths, by the largest component so that no square overflows."""
    largest = np.abs(vectors).max(axis=1, initial=0)
    return largest * np.sqrt(((vectors / np.where(largest, largest, 1)[:, None]) ** 2).sum(axis=1))


class Best:
    """The k best (score, smaller id) of every query of a block."""

    def __init__(self, k: int, own: np.ndarray, least: np.ndarray):
        self.k, self.own, self.least = k, own, least.astype(np.int64)
        self.rows, self.ids, self.scores = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Pairs of a query and a vector; no pair is offered twice."""
        take = (scores >= self.least[rows]) & (ids != self.own[rows])
        rows, ids, scores = (np.r_[a, b[take]] for a, b in ((self.rows, rows), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, ~scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        starts = np.searchsorted(rows, np.arange(len(self.own) + 1))
        keep = np.arange(len(rows)) - starts[rows] < self.k
        full = np.flatnonzero(np.diff(starts) >= self.k)
        self.least[full] = np.maximum(self.least[full], scores[starts[full] + self.k - 1])
        self.rows, self.ids, self.scores = rows[keep], ids[keep], scores[keep]


def whole_products(queries: np.ndarray, vectors: np.ndarray) -> list[int]:
    """Products of whole numbers, row by row, exact at any size."""
    return [sum(int(a) * int(b) for a, b in zip(q, v)) for q, v in zip(queries, vectors)]


class Cell:
    """A cell of the corpus, longest vectors first, in buckets of ``BUCKET`` rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        length = _lengths(vectors)
        order = np.lexsort((ids, -length))
        self.ids, self.vectors, self.length = ids[order], vectors[order], length[order]
        #: Pairs verified, of all that a search looked at.
        self.verified = 0

    def search(self, queries: np.ndarray, best: Best) -> Best:
        norms = _lengths(queries)
        for begin in range(0, len(self.ids), BUCKET):
            part = slice(begin, min(begin + BUCKET, len(self.ids)))
            least = np.where(best.least == NONE, -np.inf, best.least.astype(np.float64))
            # Rounding of the bounds is met by a margin; products themselves are exact.
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                reach = norms * self.length[begin] * (1 + 1e-9)
                dead = (least > reach) | ((least > 0) & (reach == 0))
                local = np.where((least > 0) & (reach > 0), least / reach, 0.0)
            if dead.all():
                break
            steep = ~dead & (local >= STEEP)
            self._by_length(np.flatnonzero(~dead & ~steep), part, queries, norms, least, best)
            self._by_coordinates(np.flatnonzero(steep), part, queries, norms, local, best)
        return best

    def _by_length(self, rows: np.ndarray, part: slice, queries, norms, least, best: Best) -> None:
        if len(rows):
            with np.errstate(invalid="ignore", divide="ignore"):
                need = np.where((least[rows] > 0) & (norms[rows] > 0), least[rows] / norms[rows] / (1 + 1e-9), 0.0)
            stop = part.start + int(np.searchsorted(-self.length[part], -np.nan_to_num(need).min(), side="right"))
            self._verify(rows, np.arange(part.start, stop), None, queries, norms, best)

    def _by_coordinates(self, rows: np.ndarray, part: slice, queries, norms, local, best: Best) -> None:
        if not len(rows):
            return
        unit = self.vectors[part] / np.maximum(self.length[part], 1e-300)[:, None]
        asked = queries[rows] / np.maximum(norms[rows], 1e-300)[:, None]
        strong = np.argsort(-(asked**2).sum(axis=0) - (unit**2).sum(axis=0), kind="stable")[:COORDINATES]
        rest = [np.sqrt(np.maximum(0, 1 - (u[:, strong] ** 2).sum(axis=1)) + 1e-9) for u in (asked, unit)]
        bound = asked[:, strong] @ unit[:, strong].T + rest[0][:, None] * rest[1]
        mask = bound >= local[rows][:, None] - 1e-9
        columns = np.flatnonzero(mask.any(axis=0))
        self._verify(rows, part.start + columns, mask[:, columns], queries, norms, best)

    def _verify(self, rows: np.ndarray, columns: np.ndarray, mask, queries, norms, best: Best) -> None:
        if not len(rows) or not len(columns):
            return
        asked, vectors = queries[rows], self.vectors[columns]
        share = 1.0 if mask is None else mask.mean()
        self.verified += int(round(share * len(rows) * len(columns)))
        with np.errstate(over="ignore", invalid="ignore"):
            if share < 0.1:
                r, c = np.nonzero(mask)
                products = np.einsum("ij,ij->i", asked[r], vectors[c])
            else:
                products = asked @ vectors.T
                hit = ~(products < best.least[rows][:, None].astype(np.float64) - self._doubt(norms[rows][:, None], self.length[columns]))
                r, c = np.nonzero(hit if mask is None else hit & mask)
                products = products[r, c]
            sizes = np.abs(asked).max(axis=1, initial=0)[r] * np.abs(vectors).max(axis=1, initial=0)[c] * asked.shape[1]
        exact = sizes < EXACT
        scores = np.zeros(len(r), dtype=np.int64)
        scores[exact] = products[exact].astype(np.int64)
        if not exact.all():
            large = np.flatnonzero(~exact)
            exactly = whole_products(asked[r[large]], vectors[c[large]])
            scores[large] = [min(max(s, NONE + 1), LONG.max) for s in exactly]
        best.offer(rows[r], self.ids[columns[c]], scores)

    @staticmethod
    def _doubt(norms: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """By how much a floating-point product may be off; nothing where every sum is below 2**53."""
        reach = norms * lengths
        return np.where(reach < EXACT / 4, 0.5, np.nan_to_num(reach * 1e-9, nan=np.inf, posinf=np.inf) + 2048.0)


def _cell_search(k: int):
    shape = pa.schema([("ask", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(corpus: pa.Table, queries: pa.Table) -> pa.Table:
        corpus, queries = corpus.combine_chunks(), queries.combine_chunks()
        if not len(corpus) or not len(queries):
            return shape.empty_table()
        c, q = (t["vector"].chunk(0) for t in (corpus, queries))
        dim = int(max(np.diff(x.offsets.to_numpy()).max() for x in (c, q)))
        own = queries["vec_id"].to_numpy()
        least = queries["least"].fill_null(NONE).to_numpy()
        best = Cell(corpus["vec_id"].to_numpy(), _matrix(c, dim)).search(_matrix(q, dim), Best(k, own, least))
        return pa.table([queries["ask"].to_numpy()[best.rows], own[best.rows], best.ids, best.scores], schema=shape)

    return run


def _in_cells(corpus: DataFrame, queries: DataFrame, k: int, cells: int, blocks: int) -> DataFrame:
    """Every query against every cell: the k best of each, where they reach the query's threshold."""
    cell = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(cells)).cast("int")
    block = F.pmod(F.xxhash64("ask"), F.lit(blocks)).cast("int")
    all_cells, all_blocks = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (cells, blocks))
    left = corpus.select("vec_id", "vector", cell.alias("cell"), all_blocks.alias("block"))
    right = queries.select("ask", "vec_id", "vector", "least", block.alias("block"), all_cells.alias("cell"))
    return (
        left.groupBy("cell", "block")
        .cogroup(right.groupBy("cell", "block"))
        .applyInArrow(_cell_search(k), "ask long, query_id long, vec_id long, score long")
    )


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", factor: float = 64.0
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all other rows for each row of ``queries``.

    Both tables have ``id_col`` and ``vector_col``; scores are inner products of the scaled integers, and ties go to
    the smaller id. A row is no candidate of a query with its own id. Vectors that are null or hold null or
    non-finite components take no part, nor do null ids. An empty vector has the score 0 with every other; vectors of unlike length
    meet as if the shorter were filled with zeros. Components of any finite size are multiplied exactly, and a
    product beyond 64 bits counts as the largest or smallest long. Repeated ids are candidates of their own; a repeated query
    row is answered once, and one id with two vectors once for each. Empty tables give an empty result; other columns are ignored.
    """
    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
        return rows.where(F.col("vec_id").isNotNull() & usable("vector", factor)).select("vec_id", scaled("vector", factor).alias("vector"))

    corpus = cut(clean(vectors), "corpus")
    asked = cut(clean(queries).dropDuplicates(["vec_id", "vector"]).withColumn("ask", F.monotonically_increasing_id()), "asked")
    n, m = corpus.count(), asked.count()
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    longest = cut(corpus.orderBy(square.desc(), "vec_id").limit(SEEDS), "longest")
    blocks = -(-m // BLOCK) or 1
    seeds = _in_cells(longest, asked.withColumn("least", F.lit(None).cast("long")), k, 1, blocks)
    floors = cut(seeds.groupBy("ask").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least")), "floors")
    started = asked.join(bounded_hint(floors, 16), "ask", "left")
    found = _in_cells(corpus, started, k, -(-n // CELL) or 1, blocks)
    order = Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
