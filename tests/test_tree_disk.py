"""What the tree index and its search write: no pairs of queries and leaves, no vectors over and over."""

import os

import numpy as np
import pytest

from medlake.functions.vectors import RunningTopK
from medlake.operators import tree_index
from medlake.operators.search import top_k
from medlake.operators.tree_index import build_tree, search_tree, share_searched
from medlake.plans.durable import shared_folder

DIM = 12
QUERY = "query_id long, embedding array<double>"


def sphere(rows, seed=5):
    """Vectors in no groups, of which a search has to score nearly all."""
    made = np.random.default_rng(seed).normal(size=(rows, DIM))
    return made / np.linalg.norm(made, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def even(spark):
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(sphere(2000))], "id long, embedding array<double>").repartition(4)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(sphere(300, 6))], QUERY)
    return corpus.cache(), queries, build_tree(corpus, DIM, per_leaf=20)


def size(folder):
    return sum(os.path.getsize(os.path.join(d, name)) for d, _, names in os.walk(folder) for name in names)


def on_disk(spark):
    """Bytes in the shared folder and in the folders that hold shuffled rows."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return size(shared_folder(spark).removeprefix("file:")) + sum(size(d.getPath()) for d in local)


def test_search_writes_less_than_pairs_would_take(spark, even):
    corpus, queries, index = even
    before = on_disk(spark)
    found, searched = search_tree(queries, index, 10)
    shares = [r["share"] for r in share_searched(searched, index).collect()]
    exact = {(r["query_id"], r["id"]) for r in top_k(queries, corpus, DIM, 10).collect()}
    matched = sum((r["query_id"], r["id"]) in exact for r in found.collect())
    assert matched >= 0.95 * len(exact) and len(shares) == 300 and np.mean(shares) > 0.2
    pairs, wrote = searched.count(), on_disk(spark) - before
    assert pairs > 300 * 30 and wrote < 50 * pairs
    plans = [df._jdf.queryExecution().toString() for df in (found, searched)]
    assert not any("CoGroups" in plan for plan in plans)


def test_levels_are_not_stored(spark, even):
    corpus, _, _ = even
    folder = shared_folder(spark).removeprefix("file:")
    there = set(os.listdir(folder))
    build_tree(corpus, DIM, per_leaf=20)
    new = {name: size(f"{folder}/{name}") for name in set(os.listdir(folder)) - there}
    rows = max(new.values())
    assert sum(n >= 0.5 * rows for n in new.values()) == 1, new  # the vectors in order of leaves


def odd_tables(spark):
    v = sphere(260, 7).tolist()
    rows = [(i % 250, x) for i, x in enumerate(v)] + [(i, v[i]) for i in range(60)] * 2 + [(300 + i, v[3]) for i in range(40)]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>")
    q = sphere(30, 8).tolist()
    asked = [(i, x) for i, x in enumerate(q)] + [(i, q[i]) for i in range(5)] + [(7, q[9]), (None, q[1]), (None, q[2]), (99, None)]
    return corpus, spark.createDataFrame(asked, QUERY)


@pytest.mark.parametrize("measure", ["dot", "cosine"])
def test_both_ways_agree_on_repeated_and_null_ids(spark, monkeypatch, measure):
    corpus, queries = odd_tables(spark)
    index = build_tree(corpus, DIM, per_leaf=8, measure=measure)

    def run(k):
        found, searched = search_tree(queries, index, k, target=0.8, first=2, digits=6)
        hits = sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in found.collect())
        return hits, sorted(map(str, searched.collect()))

    shipped = run(3)
    monkeypatch.setattr(tree_index, "ROUTE_BLOCK", 6)
    monkeypatch.setattr(tree_index, "ROUTE_CELLS", 100)
    assert run(3) == shipped
    leaves = index.leaves.count()
    monkeypatch.setattr(tree_index, "MAX_BROADCAST_BYTES", 16 * DIM * leaves)
    scans, scan = [], tree_index._scan
    monkeypatch.setattr(tree_index, "_scan", lambda *a: scans.append(a[4:6]) or scan(*a))
    assert run(3) == shipped and scans
    monkeypatch.setattr(tree_index, "MAX_BROADCAST_BYTES", 1000)
    scans.clear()
    assert run(3) == shipped and not scans
    assert {h[0] for h in shipped[0]} == set(range(30))


def test_masks_beyond_the_bound_make_more_scans(spark, even, monkeypatch):
    _, queries, index = even
    want = {(r["query_id"], r["rank"], r["id"]) for r in search_tree(queries, index, 5)[0].collect()}
    scans, scan = [], tree_index._scan
    monkeypatch.setattr(tree_index, "_scan", lambda *a: scans.append(a[4:6]) or scan(*a))
    monkeypatch.setattr(tree_index, "MASK_BYTES", 1500)
    assert {(r["query_id"], r["rank"], r["id"]) for r in search_tree(queries, index, 5)[0].collect()} == want
    assert len(scans) > 4 and scans[0][0] == 0 and max(end for _, end in scans) == 300


def test_vectors_alike_in_id_and_score_are_one_hit():
    best = RunningTopK(np.array([[1.0, 0.0], [0.0, 1.0]]), 2, 6, np.array([-np.inf, 2.0]), distinct=True)
    ids = np.array([4, 4, 4, 4, 2, 1], dtype=object)
    best.add(ids, np.array([[3.0, 1.0]] * 4 + [[2.0, 2.0], [1.0, 5.0]]))
    best.add(ids[:2], np.array([[3.0, 1.0]] * 2))
    assert [list(zip(i, s)) for i, s in zip(best.ids, best.scores)] == [[(4, 3.0), (2, 2.0)], [(1, 5.0), (2, 2.0)]]
