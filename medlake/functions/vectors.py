"""Arrow/numpy helpers that work on one batch of vectors at a time inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SCORE_DIGITS = 9
# Scores computed at once: bounds the working set of a task (8 bytes each).
SCORES_PER_STEP = 4_000_000


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column whose rows all have ``dim`` values, as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(-1, dim)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay zero."""
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _runs(ordered: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, start, end) of every run of equal values in a sorted array."""
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, dtype=np.int64)
    return list(zip(ordered[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(ordered)]))


class RunningTopK:
    """The k best (score, id) of each query among the vectors seen so far.

    Scores are rounded before ranking so that equal vectors tie exactly, whatever batch
    they arrive in; ties go to the smaller id. ``floor`` has scores that a hit must reach; with
    ``distinct``, vectors alike in id and score are one hit.
    """

    def __init__(self, queries: np.ndarray, k: int, digits: int = SCORE_DIGITS, floor: np.ndarray | None = None, distinct: bool = False):
        self.queries, self.k, self.digits, self.distinct = queries, k, digits, distinct
        self.scores = [np.empty(0)] * len(queries)
        self.ids = [np.empty(0, dtype=object)] * len(queries)
        self.floor = np.full(len(queries), -np.inf) if floor is None else floor.copy()

    def add(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Offer vectors to all queries, or only to the query rows given."""
        queries = self.queries if rows is None else self.queries[rows]
        rows = np.arange(len(self.queries)) if rows is None else rows
        if not len(rows):
            return
        step = max(1, SCORES_PER_STEP // len(rows))
        for start in range(0, len(ids), step):
            scores = queries @ vectors[start : start + step].T
            # Only what may reach the floor once rounded is rounded; of large scores, rounding changes the last bits.
            floor = self.floor[rows, None]
            reach = np.where(np.isfinite(floor), floor - 10.0**-self.digits - np.abs(floor) * 1e-12, floor)
            q, v = np.divmod(np.flatnonzero(scores >= reach), scores.shape[1])
            for at, first, end in _runs(q):
                near = v[first:end]
                self._merge(rows[at], ids[start : start + step][near], np.round(scores[at, near], self.digits))

    def _merge(self, row: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores = np.concatenate([self.scores[row], scores])
        ids = np.concatenate([self.ids[row], ids])
        if self.distinct and len(scores) > 1:
            order = np.lexsort((np.argsort(np.argsort(ids, kind="stable")), scores))
            scores, ids = scores[order], ids[order]
            new = np.r_[True, (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])]
            scores, ids = scores[new], ids[new]
        if len(scores) > self.k:
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            near = scores >= kth
            scores, ids = scores[near], ids[near]
        by_id = np.argsort(ids, kind="stable")
        best = by_id[np.argsort(-scores[by_id], kind="stable")][: self.k]
        self.scores[row], self.ids[row] = scores[best], ids[best]
        if len(best) == self.k:
            self.floor[row] = self.scores[row][-1]

    def to_batch(self, query_ids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
        counts = [len(s) for s in self.scores]
        owner = np.repeat(np.arange(len(counts)), counts)
        ids = np.concatenate(self.ids).tolist() if counts else []
        scores = np.concatenate(self.scores) if counts else np.empty(0)
        return pa.RecordBatch.from_arrays(
            [
                query_ids.take(pa.array(owner)).cast(schema.field(0).type),
                pa.array(ids, schema.field(1).type),
                pa.array(scores, pa.float64()),
            ],
            schema=schema,
        )


def object_ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.empty(len(column), dtype=object)
    out[:] = column.to_pylist()
    return out


def leaf_scores(centroids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Negative squared distance to each centroid, up to a constant per vector."""
    return 2.0 * vectors @ centroids.T - (centroids**2).sum(axis=1)


def best_leaves(centroids: np.ndarray, vectors: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` best leaves of each vector, best first, ties to the smaller leaf.

    Scores are computed for blocks of vectors, so their matrix stays small for any number of leaves.
    """
    out = np.empty((len(vectors), n), dtype=np.int32)
    step = max(1, SCORES_PER_STEP // len(centroids))
    for start in range(0, len(vectors), step):
        scores = leaf_scores(centroids, vectors[start : start + step])
        if n == 1:
            out[start : start + step, 0] = scores.argmax(axis=1)
        else:
            out[start : start + step] = np.argsort(-scores, axis=1, kind="stable")[:, :n]
    return out
