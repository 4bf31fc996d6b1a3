import numpy as np
import pytest
from pyspark.sql import functions as F

from medlake.functions.vectors import RunningTopK
from medlake.operators import embedding, evaluation, search, vector_index

DIM = 8


def vectors(spark, m, name, start=0, text_ids=False):
    kind = "string" if text_ids else "bigint"
    rows = [((f"d{start + i:04d}" if text_ids else start + i), [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, f"{name} {kind}, embedding array<float>")


def brute(queries, corpus, k, measure="dot"):
    q, c = (np.asarray(m, dtype=np.float32).astype(float) for m in (queries, corpus))
    if measure == "cosine":
        unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        q, c = unit(q), unit(c)
    scores = np.round(q @ c.T, 9)
    out = {}
    for i, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda j: (-row[j], j))[:k]
        out[i] = [(j, row[j], r + 1) for r, j in enumerate(order)]
    return out


def collected(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.distance, r["rank"]))
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    corpus = rng.normal(size=(300, DIM)).astype(np.float32)
    corpus[100:200] = corpus[0]  # a third of the corpus are copies: ties go by id
    return rng.normal(size=(20, DIM)).astype(np.float32), corpus


@pytest.mark.parametrize("measure", ["dot", "cosine"])
@pytest.mark.parametrize("max_queries", [None, 0])
def test_top_k_equals_brute_force(spark, data, measure, max_queries):
    """Shipped queries and the grid of cells give the same hits."""
    q, c = data
    hits = search.top_k(
        vectors(spark, q, "query_id"),
        vectors(spark, c, "id").repartition(3),
        DIM,
        7,
        measure,
        max_queries=max_queries,
        cell_bytes=8 * DIM * 50,  # at most 50 vectors per side of a cell
    )
    got = collected(hits)
    want = brute(q, c, 7, measure)
    for i in want:
        assert [(a, r) for a, _, r in got[i]] == [(a, r) for a, _, r in want[i]]
        assert [s for _, s, _ in got[i]] == pytest.approx([s for _, s, _ in want[i]], abs=1e-8)


def test_text_ids_and_small_corpus(spark, data):
    q, c = data
    hits = search.top_k(vectors(spark, q[:2], "query_id"), vectors(spark, c[:3], "id", text_ids=True), DIM, 10)
    got = collected(hits)
    assert all(len(v) == 3 for v in got.values())
    assert got[0][0][0].startswith("d000")


def test_bad_vectors_are_left_out(spark):
    rows = [(1, [1.0] * DIM), (2, None), (3, [1.0] * (DIM - 1))]
    corpus = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    hits = search.top_k(vectors(spark, [[1.0] * DIM], "query_id"), corpus, DIM)
    assert [r.id for r in hits.collect()] == [1]
    good, bad = embedding.check_dimension(corpus, DIM)
    assert [r.id for r in good.collect()] == [1]
    assert {r.id: r.found_dim for r in bad.collect()} == {2: -1, 3: DIM - 1}


def test_running_top_k_batches_do_not_matter():
    rng = np.random.default_rng(0)
    q, c = rng.normal(size=(5, 4)), np.round(rng.normal(size=(200, 4)), 1)
    ids = np.arange(200).astype(object)
    whole, parts = RunningTopK(q, 6), RunningTopK(q, 6)
    whole.add(ids, c)
    for at in np.array_split(rng.permutation(200), 9):
        parts.add(ids[at], c[at])
    assert all((a == b).all() for a, b in zip(whole.ids, parts.ids, strict=True))


def test_threshold_keeps_equal_scores_and_null_is_zero(spark):
    hits = spark.createDataFrame([(1, 0.7), (2, 0.69), (3, None)], "id int, distance double")
    assert [r.id for r in search.above_threshold(hits).collect()] == [1]
    assert len(search.above_threshold(hits, 0.0).collect()) == 3


def test_filter_runs_before_search(spark, data):
    q, c = data
    registry = spark.createDataFrame([(i, i % 2) for i in range(300)], "document_id bigint, odd int")
    allowed = search.filter_corpus(vectors(spark, c, "id"), registry, "odd = 1")
    hits = search.top_k(vectors(spark, q, "query_id"), allowed, DIM, 5).collect()
    assert len(hits) == 100 and all(r.id % 2 for r in hits)


@pytest.mark.parametrize("max_hits", [None, 100])
def test_sources_are_attached(spark, max_hits):
    hits = spark.createDataFrame(
        [(q, i, 0.5, 1) for q in range(10) for i in (7, q + 20)], "query_id int, id int, distance double, rank int"
    )
    registry = spark.createDataFrame([(7, "seven", None), (21, "x", "s")], "id int, text string, source string")
    got = search.attach_sources(hits, registry, max_hits).collect()
    assert len(got) == 20
    assert sum(r.text == "seven" for r in got) == 10 and sum(r.text == "x" for r in got) == 1
    assert sum(r.text is None for r in got) == 9


def test_search_by_text(spark):
    docs = spark.createDataFrame([(1, "red lung opacity"), (2, "broken arm")], "id int, text string")
    asks = spark.createDataFrame([(5, "lung opacity")], "query_id int, text string")
    embed = lambda df: embedding.embed_texts(df, dim=64)
    hits = search.search_text(asks, embed(docs).select("id", "embedding"), embed, 64, 1).collect()
    assert [(h.query_id, h.id) for h in hits] == [(5, 1)]


# --- leaves ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, DIM)) * 4
    corpus = (centres[np.arange(600) % 12] + rng.normal(size=(600, DIM)) * 0.3).astype(np.float32)
    corpus[400:] = corpus[0]  # one leaf holds a third of all vectors
    queries = (centres + rng.normal(size=(12, DIM)) * 0.1).astype(np.float32)
    return queries, corpus


@pytest.mark.parametrize("max_queries", [None, 0])
def test_leaf_search_recall(spark, clustered, max_queries):
    q, c = clustered
    corpus, queries = vectors(spark, c, "id"), vectors(spark, q, "query_id")
    centroids = vector_index.train_leaves(corpus, DIM, leaves=12, measure="cosine")
    index = vector_index.assign_leaves(corpus, centroids, DIM, "cosine")
    options = {"measure": "cosine", "max_queries": max_queries, "cell_bytes": 8 * DIM * 40}
    found = vector_index.approx_top_k(queries, index, centroids, DIM, 5, probes=3, **options)
    exact = search.top_k(queries, corpus, DIM, 5, "cosine")
    mean = vector_index.recall(found, exact).agg(F.avg("recall")).first()[0]
    assert mean >= 0.9
    everything = vector_index.approx_top_k(queries, index, centroids, DIM, 5, probes=12, **options)
    assert collected(everything) == collected(exact)


def test_index_round_trip_prunes_leaves(spark, clustered, tmp_path):
    q, c = clustered
    corpus = vectors(spark, c, "id")
    centroids = vector_index.train_leaves(corpus, DIM, leaves=6)
    path = str(tmp_path / "index")
    vector_index.write_index(vector_index.assign_leaves(corpus, centroids, DIM), centroids, path, file_rows=100)
    index, loaded = vector_index.read_index(spark, path, DIM)
    assert np.allclose(loaded, centroids) and index.count() == 600
    hits = vector_index.approx_top_k(vectors(spark, q[:1], "query_id"), index, loaded, DIM, 5, probes=1)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [leaf" in plan or "PartitionFilters: [isnotnull(leaf" in plan
    assert hits.count() == 5


def test_leaf_defaults():
    assert vector_index.leaf_count(5_000, 768) == 5
    assert vector_index.leaf_count(10**9, 768) * 768 * 8 <= 64 * 1024 * 1024


def test_upsert_keeps_highest_version(spark):
    current = spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 5)], "id int, embedding array<float>, version int")
    changes = spark.createDataFrame([(1, [9.0], 2), (2, [8.0], 4), (3, [3.0], 1)], current.schema)
    got = {r.id: (r.embedding, r.version) for r in vector_index.upsert_latest(current, changes).collect()}
    assert got == {1: ([9.0], 2), 2: ([2.0], 5), 3: ([3.0], 1)}


def test_precision_and_recall(spark):
    hits = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "query_id int, id int")
    asked = spark.createDataFrame([(1, "a"), (2, "b")], "query_id int, label string")
    items = spark.createDataFrame([(10, "a"), (11, "b"), (12, "b"), (13, "a")], "id int, label string")
    got = {r.query_id: r for r in evaluation.precision_recall_at_k(hits, asked, items).collect()}
    assert (got[1].precision_at_k, got[1].recall_at_k) == (0.5, 0.5)
    assert (got[2].precision_at_k, got[2].recall_at_k) == (1.0, 0.5)


# --- embeddings -------------------------------------------------------------------------------

def test_embed_batches_and_nulls(spark):
    sizes = spark.sparkContext.accumulator(0)

    def model(texts):
        assert len(texts) <= 2
        sizes.add(len(texts))
        return np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([(i, "x" * i if i != 3 else None) for i in range(6)], "i int, body string").coalesce(1)
    got = {r.i: r.embedding for r in embedding.embed_texts(df, "body", model, 2, batch_size=2).collect()}
    assert got[5] == [5.0, 1.0] and got[3] is None and len(got) == 6
    assert sizes.value == 5
    with pytest.raises(ValueError):
        embedding.embed_texts(df, "missing")


def test_hashed_words_are_unit_length_and_case_blind():
    embed = embedding.hashed_words(32)
    m = embed(["Lung LUNG opacity", "lung lung OPACITY!", "", "İstanbul"])
    assert np.allclose(m[0], m[1]) and np.isclose(np.linalg.norm(m[0]), 1.0) and not m[2].any()


def test_sparse_vectors_equal_the_hook(spark):
    texts = ["Lung LUNG opacity", "", None, "\u0130stanbul \u017f \u212a x9 \u00e9!", "a " * 5000 + "b", "\n--\n", "one", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for dim in (1, 7, 768):
        model = embedding.hashed_words(dim)
        sparse = {r.id: r.embedding for r in embedding.embed_sparse(df, dim=dim).collect()}
        assert len(sparse) == len(texts) and sparse[2] is None
        for i, text in enumerate(texts):
            if text is not None:
                wanted = model([text])[0].astype(np.float32)
                assert sparse[i].slots == np.flatnonzero(wanted).tolist()
                assert (np.array(sparse[i].weights, dtype=np.float32) == wanted[sparse[i].slots]).all()
    with pytest.raises(ValueError):
        embedding.embed_sparse(df, "missing")


def test_sparse_vectors_need_no_python_worker_and_hash_once(spark):
    df = spark.createDataFrame([(1, "a b")], "id int, text string")
    found = embedding.embed_sparse(df, dim=8).where("size(embedding.slots) > 1")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("regexp_extract_all") == 1


def test_chunks(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(10)))), (2, "one"), (3, "  ")], "i int, text string")
    rows = embedding.chunk_words(df, size=4, overlap=1, keep=("i",)).orderBy("i", "chunk_no").collect()
    assert [(r.i, r.chunk) for r in rows] == [(1, "0 1 2 3"), (1, "3 4 5 6"), (1, "6 7 8 9"), (2, "one")]
    with pytest.raises(ValueError):
        embedding.chunk_words(df, size=2, overlap=2)


def test_upsert_ties_and_null_versions(spark):
    shape = "id int, embedding array<double>, version int"
    current = spark.createDataFrame([(1, [1.0], 5), (2, [2.0], None), (3, [3.0], None)], shape)
    changes = spark.createDataFrame([(1, [9.0], 5), (3, [8.0], 1)], shape)
    for parts in (1, 4):
        got = vector_index.upsert_latest(current.repartition(parts), changes.repartition(parts)).collect()
        assert {r.id: (r.embedding, r.version) for r in got} == {1: ([9.0], 5), 2: ([2.0], None), 3: ([8.0], 1)}
