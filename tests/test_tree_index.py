"""The tree index: leaf sizes, radii, recall, the exact mode and plans that do not depend on a size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from medlake.operators import tree_index
from medlake.operators.search import top_k
from medlake.operators.tree_index import build_tree, read_tree, search_tree, share_searched, write_tree
from medlake.operators.vector_index import recall

DIM = 12


def vectors_of(spark, matrix, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(matrix)], "id long, embedding array<double>")


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, DIM)) * 4
    rows = np.concatenate([c + rng.normal(size=(60, DIM)) * 0.5 for c in centers])
    copies = np.repeat(rows[:1], 900, axis=0)  # a group of copies of over a quarter of all rows
    corpus = vectors_of(spark, np.concatenate([rows, copies])).repartition(4).cache()
    queries = corpus.where("id % 80 = 0").withColumnRenamed("id", "query_id")
    index = build_tree(corpus, DIM, per_leaf=50, sample=400)
    return corpus, queries, index


def test_leaves_are_small_and_hold_every_vector_once(clustered):
    corpus, _, index = clustered
    homes = index.vectors.where("home").groupBy("leaf").count().collect()
    assert max(r["count"] for r in homes) <= 50 and sum(r["count"] for r in homes) == corpus.count() == 3300
    held = {r["leaf"]: r for r in index.leaves.collect()}
    assert {r["leaf"] for r in homes} <= set(held)
    for leaf, rows in index.vectors.toPandas().groupby("leaf"):
        m, one = np.array(rows["embedding"].tolist()), held[leaf]
        assert one["n"] == len(m) and np.allclose(one["mean"], m.mean(axis=0)) and np.allclose(one["variance"], m.var(axis=0))
        assert (np.linalg.norm(m - one["mean"], axis=1) <= one["radius"] + 1e-9).all()


def pairs(hits):
    return {(r["query_id"], r["rank"]): (r["id"], r["distance"]) for r in hits.collect()}


@pytest.mark.parametrize("measure", ["dot", "cosine"])
def test_exact_mode_equals_the_exact_search(spark, clustered, measure):
    corpus, queries, index = clustered
    if measure == "cosine":
        index = build_tree(corpus, DIM, per_leaf=200, measure=measure)
    found, searched = search_tree(queries, index, 10, target=1.0)
    assert pairs(found) == pairs(top_k(queries, corpus, DIM, 10, measure))
    assert share_searched(searched, index).agg(F.avg("share")).first()[0] < 1.0


def test_recall_with_a_share_of_the_vectors(clustered):
    corpus, queries, index = clustered
    found, searched = search_tree(queries, index, 10, target=0.95)
    found_scores = {q: d for (q, r), (_, d) in pairs(found).items() if r == 10}
    exact_scores = {q: d for (q, r), (_, d) in pairs(top_k(queries, corpus, DIM, 10)).items() if r == 10}
    # Copies tie: a query is answered if its tenth score is the true one.
    assert np.mean([found_scores[q] == exact_scores[q] for q in exact_scores]) >= 0.9
    shares = [r["share"] for r in share_searched(searched, index).collect()]
    assert len(shares) == len(exact_scores) and np.mean(shares) < 0.6
    unique = corpus.where("id < 2400")
    index = build_tree(unique, DIM, per_leaf=50)
    found, _ = search_tree(queries.where("query_id < 2400"), index, 10, target=0.95)
    assert min(r["recall"] for r in recall(found, top_k(queries.where("query_id < 2400"), unique, DIM, 10)).collect()) >= 0.9


def test_bounded_tables_meet_in_cells(spark, clustered, monkeypatch):
    corpus, queries, index = clustered
    for name, value in {"MAX_BROADCAST_BYTES": 1000, "MAX_LEAF_FILTER": 3, "CHUNK": 300, "QUERY_BLOCK": 7, "LEAF_BLOCK": 9}.items():
        monkeypatch.setattr(tree_index, name, value)
    other = build_tree(corpus, DIM, per_leaf=50, sample=400)
    same = ["id", "leaf", "home"]
    assert sorted(map(tuple, other.vectors.select(*same).collect())) == sorted(map(tuple, index.vectors.select(*same).collect()))
    assert pairs(search_tree(queries, other, 5, target=1.0)[0]) == pairs(top_k(queries, corpus, DIM, 5))


def test_written_tree_skips_files(spark, clustered, tmp_path):
    corpus, queries, index = clustered
    write_tree(index, str(tmp_path / "tree"))
    back = read_tree(spark, str(tmp_path / "tree"), DIM)
    found, _ = search_tree(queries, back, 5, target=1.0)
    assert pairs(found) == pairs(top_k(queries, corpus, DIM, 5))
    plan = back.vectors.where(F.col("leaf").isin([3, 5]))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(leaf, [3,5])]" in plan


def test_odd_vectors_and_empty_tables(spark):
    schema = "id long, embedding array<double>"
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 0.0]), (4, [2.0, 0.0]), (5, [0.0, 1.0])]
    index = build_tree(spark.createDataFrame(rows, schema), 2, per_leaf=1)
    queries = spark.createDataFrame([(9, [1.0, 0.0]), (8, None)], "query_id long, embedding array<double>")
    found, _ = search_tree(queries, index, 2, target=1.0)
    assert [(r["query_id"], r["id"], r["distance"]) for r in found.orderBy("rank").collect()] == [(9, 4, 2.0), (9, 1, 1.0)]
    empty = build_tree(spark.createDataFrame([], schema), 2)
    assert empty.leaves.count() == 0 and search_tree(queries, empty, 2)[0].count() == 0
    assert search_tree(queries.limit(0), index, 2)[0].count() == 0


@pytest.mark.parametrize("measure", ["dot", "cosine"])
def test_blocks_out_of_reach_are_skipped(clustered, measure):
    corpus, queries, _ = clustered
    exact = pairs(top_k(queries, corpus, DIM, 10, measure))
    found, met, index = tree_index.pruned_top_k(queries, corpus, DIM, 10, measure, 9, 100)
    assert pairs(found) == exact
    cells = index.leaves.count() * queries.count()
    assert 0 < met.count() < 0.6 * cells and met.count() == met.distinct().count()
    # The same through top_k where the queries may not be shipped.
    assert pairs(top_k(queries, corpus, DIM, 10, measure, max_queries=5, cell_bytes=8 * DIM * 100)) == exact
