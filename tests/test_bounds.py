"""What a task holds at once while it embeds and searches."""

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from medlake.functions.vectors import RunningTopK
from medlake.operators import embedding
from medlake.plans.batches import SLICE


class _Frame:
    """A table whose batch function is handed out instead of run."""

    schema = T.StructType([T.StructField("text", T.StringType())])
    columns = ["text"]

    def mapInArrow(self, run, schema):
        return run


def test_vectors_of_few_texts_are_held_at_once():
    run = embedding.embed_texts(_Frame(), dim=8)
    texts = [None if i % 7 == 0 else f"word{i} other" for i in range(3 * SLICE + 5)]
    out = list(run(iter([pa.record_batch([pa.array(texts, pa.string())], names=["text"])])))
    assert max(map(len, out)) <= SLICE
    got = pa.Table.from_batches(out)
    assert got["text"].to_pylist() == texts
    for text, vector in zip(texts, got["embedding"].to_pylist()):
        assert vector is None if text is None else np.allclose(vector, embedding.embed_text(text, dim=8))


def test_running_top_k_ranks_rounded_scores():
    rng = np.random.default_rng(2)
    vectors, queries = np.round(rng.normal(size=(900, 3)), 1), np.round(rng.normal(size=(7, 3)), 1)
    ids = rng.permutation(900).astype(object)
    best = RunningTopK(queries, 5, digits=1)
    for start in range(0, 900, 50):
        best.add(ids[start : start + 50], vectors[start : start + 50])
    scores = np.round(queries @ vectors.T, 1)
    for row in range(len(queries)):
        want = sorted(zip(-scores[row], ids))[:5]
        assert list(zip(-best.scores[row], best.ids[row])) == want


def test_running_top_k_takes_query_rows_in_any_order():
    best = RunningTopK(np.array([[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]]), 1)
    best.add(np.array([7, 8], dtype=object), np.array([[5.0, 1.0], [2.0, 3.0]]), np.array([2, 0, 1]))
    assert [x.tolist() for x in best.ids] == [[7], [8], [7]] and [x.tolist() for x in best.scores] == [[5.0], [3.0], [6.0]]
