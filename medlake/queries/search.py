"""Similarity search, embeddings, answers and retrieval evaluation."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medlake.operators import answering, embedding, evaluation, search, tree_index, vector_index
from medlake.plans.durable import cut
from medlake.queries.catalog import query, table

DIM = 64
K = 10
DIGITS = 6
TEXT_DIM = 768
PER_LEAF = 64
TEXT_MIN_SCORE = 0.3


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _mean_vector(df: DataFrame, key) -> DataFrame:
    """(query_id, embedding): element-wise mean per key, stored for the steps that read it."""
    vectors = df.select(key.alias("query_id"), array_to_vector("embedding").alias("v"))
    means = vectors.groupBy("query_id").agg(Summarizer.mean(F.col("v")).alias("mean"))
    return cut(means.select("query_id", vector_to_array("mean").alias("embedding")), "queries")


def _label_queries(spark: SparkSession, sf: str) -> DataFrame:
    return _mean_vector(table(spark, sf, "embeddings"), F.col("label"))


_MEANS = """
cells AS (SELECT {key} AS query_id, i, avg(CAST(embedding[i] AS DOUBLE)) AS x
          FROM embeddings, range(1, 65) AS r(i) GROUP BY 1, 2),
qv AS (SELECT query_id, list(x ORDER BY i) AS q FROM cells GROUP BY query_id)"""
_BY_LABEL = _MEANS.format(key="label")
_RANKED = """
sims AS (SELECT query_id, vec_id AS id,
                round({measure}(CAST(embedding AS DOUBLE[]), q), 6) AS distance
         FROM embeddings, qv {where}),
hits AS (SELECT query_id, id, distance,
                CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance DESC, id) AS INTEGER) AS rank
         FROM sims QUALIFY rank <= 10)"""
_DOT = _RANKED.format(measure="list_dot_product", where="")


@query("q_topk_exact", f"WITH {_BY_LABEL}, {_DOT} SELECT * FROM hits")
def topk_exact(spark, sf):
    return search.top_k(_label_queries(spark, sf), _corpus(spark, sf), DIM, K, digits=DIGITS)


@query(
    "q_topk_cosine",
    f"WITH {_BY_LABEL}, {_RANKED.format(measure='list_cosine_similarity', where='')} SELECT * FROM hits",
)
def topk_cosine(spark, sf):
    return search.top_k(
        _label_queries(spark, sf), _corpus(spark, sf), DIM, K, measure="cosine", digits=DIGITS
    )


@query("q_topk_single", f"WITH {_MEANS.format(key='0')}, {_DOT} SELECT id, distance FROM hits")
def topk_single(spark, sf):
    one = _mean_vector(table(spark, sf, "embeddings"), F.lit(0))
    hits = search.top_k(one, _corpus(spark, sf), DIM, K, digits=DIGITS)
    return search.top_k_single(hits, K).select("id", "distance")


# The stated query set of a search: ids divisible by 100, against all rows.
_ALL = """
qv AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id % 100 = 0)"""


def _query_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _corpus(spark, sf).where("id % 100 = 0").select(F.col("id").alias("query_id"), "embedding")


@query("q_knn_all", f"WITH {_ALL}, {_DOT} SELECT * FROM hits")
def knn_all(spark, sf):
    return search.top_k(_query_vectors(spark, sf), _corpus(spark, sf), DIM, K, digits=DIGITS)


@query("q_topk_threshold", f"WITH {_ALL}, {_DOT} SELECT * FROM hits WHERE distance >= 0.25")
def topk_threshold(spark, sf):
    return search.above_threshold(knn_all(spark, sf), 0.25)


@query(
    "q_topk_filtered",
    f"""WITH {_BY_LABEL}, {_RANKED.format(
        measure='list_dot_product',
        where="WHERE vec_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")}
    SELECT * FROM hits""",
)
def topk_filtered(spark, sf):
    allowed = search.filter_corpus(
        _corpus(spark, sf), table(spark, sf, "documents"), "lang = 'en'", registry_id="doc_id"
    )
    return search.top_k(_label_queries(spark, sf), allowed, DIM, K, digits=DIGITS)


@query(
    "q_hybrid_modality",
    f"""WITH {_BY_LABEL}, {_RANKED.format(
        measure='list_cosine_similarity',
        where='''WHERE vec_id IN (SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id
                                  WHERE l.quality = 1 AND d.lang <> 'fr')''')}
    SELECT * FROM hits WHERE distance >= 0.1""",
)
def hybrid_modality(spark, sf):
    labels = table(spark, sf, "labels")
    rows = table(spark, sf, "documents").select("doc_id", "lang").join(labels, "doc_id")
    allowed = search.filter_corpus(
        _corpus(spark, sf), rows, "quality = 1 AND lang <> 'fr'", registry_id="doc_id"
    )
    hits = search.top_k(
        _label_queries(spark, sf), allowed, DIM, K, measure="cosine", digits=DIGITS
    )
    return search.above_threshold(hits, 0.1)


def _sources(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "source")


@query(
    "q_hits_with_text",
    f"""WITH {_BY_LABEL}, {_DOT}
    SELECT query_id, id, distance, rank, md5(text) AS text_md5, source
    FROM hits LEFT JOIN documents ON doc_id = id""",
)
def hits_with_text(spark, sf):
    queries = _label_queries(spark, sf)
    hits = search.top_k(queries, _corpus(spark, sf), DIM, K, digits=DIGITS)
    out = search.attach_sources(hits, _sources(spark, sf), search.hits_bound(queries, DIM, K))
    return out.select("query_id", "id", "distance", "rank", F.md5("text").alias("text_md5"), "source")


@query(
    "q_eval_precision_at_k",
    f"""WITH {_BY_LABEL}, {_DOT},
    judged AS (SELECT query_id, count(*) AS returned,
                      count(*) FILTER (WHERE label = query_id) AS relevant
               FROM hits JOIN embeddings ON vec_id = id GROUP BY query_id),
    totals AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
    SELECT query_id, label, returned, relevant,
           round(relevant / returned, 6) AS precision_at_k, round(relevant / n, 6) AS recall_at_k
    FROM judged JOIN totals ON label = query_id""",
)
def eval_precision(spark, sf):
    corpus = _corpus(spark, sf)
    queries = _label_queries(spark, sf)
    hits = search.top_k(queries, corpus, DIM, K, digits=DIGITS)
    out = evaluation.precision_recall_at_k(
        hits,
        queries.select("query_id", F.col("query_id").alias("label")),
        corpus.select("id", "label"),
        max_hits=search.hits_bound(queries, DIM, K),
    )
    return out.withColumns(
        {
            "precision_at_k": F.round("precision_at_k", 6),
            "recall_at_k": F.round("recall_at_k", 6),
        }
    )


@query(
    "q_upsert_latest",
    """WITH changes AS (
      SELECT vec_id AS id, embedding, label, 1 AS version FROM embeddings
      UNION ALL
      SELECT vec_id, list_transform(embedding, lambda x: -x), label + 100,
             CASE WHEN label < 5 THEN 2 ELSE 0 END FROM embeddings),
    best AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1)
    SELECT id, version, label, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value,
           CAST(len(embedding) AS INTEGER) AS dim FROM best""",
)
def upsert_latest(spark, sf):
    current = _corpus(spark, sf).withColumn("version", F.lit(1))
    changes = _corpus(spark, sf).select(
        "id",
        F.transform("embedding", lambda x: -x).alias("embedding"),
        (F.col("label") + 100).alias("label"),
        F.when(F.col("label") < 5, F.lit(2)).otherwise(F.lit(0)).alias("version"),
    )
    return vector_index.upsert_latest(current, changes).select(
        "id",
        "version",
        "label",
        F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"),
        F.size("embedding").alias("dim"),
    )


@query(
    "q_upsert_ties",
    """WITH cur AS (
      SELECT vec_id AS id, embedding, CASE WHEN label % 3 = 0 THEN NULL ELSE label END AS version FROM embeddings),
    chg AS (
      SELECT id, list_transform(embedding, lambda x: -x) AS embedding,
             CASE WHEN id % 4 = 0 THEN version ELSE version - 1 END AS version FROM cur WHERE id % 2 = 0),
    best AS (SELECT * FROM (SELECT *, 0 AS side FROM cur UNION ALL SELECT *, 1 FROM chg)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC NULLS LAST, side DESC) = 1)
    SELECT id, version, unnest(range(len(embedding))) AS place, CAST(unnest(embedding) AS DOUBLE) AS value FROM best""",
)
def upsert_ties(spark, sf):
    """Equal and null versions; every value of the winning vectors."""
    version = F.when(F.col("label") % 3 != 0, F.col("label")).alias("version")
    current = _corpus(spark, sf).select("id", "embedding", version)
    changed = F.when(F.col("id") % 4 == 0, F.col("version")).otherwise(F.col("version") - 1)
    changes = current.where("id % 2 = 0").select(
        "id", F.transform("embedding", lambda x: -x).alias("embedding"), changed.alias("version")
    )
    best = vector_index.upsert_latest(current, changes)
    return best.select("id", "version", F.posexplode("embedding").alias("place", "value")).select(
        "id", "version", F.col("place").cast("long").alias("place"), F.col("value").cast("double").alias("value")
    )


@query(
    "q_dimension_check",
    """SELECT CASE WHEN len(embedding) = 64 THEN 'ok' ELSE 'violation' END AS state,
              count(*) AS n
       FROM (SELECT CASE WHEN label = 3 THEN embedding[1:63] ELSE embedding END AS embedding FROM embeddings)
       GROUP BY 1""",
)
def dimension_check(spark, sf):
    rows = _corpus(spark, sf).withColumn(
        "embedding",
        F.when(F.col("label") == 3, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")),
    )
    good, bad = embedding.check_dimension(rows, DIM)
    both = good.select(F.lit("ok").alias("state")).unionByName(
        bad.select(F.lit("violation").alias("state"))
    )
    return both.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def _indexed(spark: SparkSession, sf: str):
    corpus = _corpus(spark, sf).select("id", "embedding")
    # The test tables hold a few vectors per would-be leaf of 1000: use smaller leaves.
    rows = corpus.count()
    centroids = vector_index.train_leaves(corpus, DIM, leaves=max(8, rows // 1000))
    return vector_index.assign_leaves(corpus, centroids, DIM), centroids


def _tree(spark: SparkSession, sf: str) -> tree_index.TreeIndex:
    # The test tables hold a few vectors per would-be leaf of 1000: use smaller leaves.
    return tree_index.build_tree(_corpus(spark, sf), DIM, per_leaf=PER_LEAF)


@query("q_ann_recall")
def ann_recall(spark, sf):
    """Recall of every query, and the share of the vectors that were scored for it."""
    index, queries = _tree(spark, sf), _query_vectors(spark, sf)
    found, searched = tree_index.search_tree(queries, index, K, digits=DIGITS)
    told = vector_index.recall(found, knn_all(spark, sf))
    return told.join(tree_index.share_searched(searched, index), "query_id")


@query(
    "q_tree_exact",
    f"WITH {_ALL}, {_DOT} SELECT * FROM hits",
)
def tree_exact(spark, sf):
    """Leaves that the radius cannot rule out: equal to the exact search."""
    return tree_index.search_tree(_query_vectors(spark, sf), _tree(spark, sf), K, target=1.0, digits=DIGITS)[0]


@query("q_leaf_sizes")
def leaf_sizes(spark, sf):
    index, _ = _indexed(spark, sf)
    return index.groupBy("leaf").agg(F.count(F.lit(1)).alias("vectors"))


@query(
    "q_leaf_bounds",
    """SELECT vec_id AS id, CAST(1 AS BIGINT) AS homes, true AS leaf_small, true AS within_radius FROM embeddings""",
)
def leaf_bounds(spark, sf):
    """Every vector's number of home leaves, whether its leaf is within size, and its distance within the radius."""
    index = _tree(spark, sf)
    homes = Window.partitionBy("leaf", "home")
    gap = F.aggregate(
        F.zip_with("embedding", "mean", lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda a, x: a + x
    )
    held = index.vectors.withColumn("n_home", F.count(F.lit(1)).over(homes)).join(index.leaves.select("leaf", "mean", "radius"), "leaf")
    return held.groupBy("id").agg(
        F.count(F.when(F.col("home"), 1)).alias("homes"),
        F.bool_and(~F.col("home") | (F.col("n_home") <= PER_LEAF)).alias("leaf_small"),
        F.bool_and(F.sqrt(gap) <= F.col("radius") * (1 + 1e-9)).alias("within_radius"),
    )


@query(
    "q_leaf_probe_all",
    f"WITH {_ALL}, {_DOT} SELECT * FROM hits",
)
def leaf_probe_all(spark, sf):
    """Probing every leaf must equal the exact search."""
    index, centroids = _indexed(spark, sf)
    return vector_index.approx_top_k(
        _query_vectors(spark, sf), index, centroids, DIM, K, probes=len(centroids), digits=DIGITS
    )


# --- text embeddings and answers ---------------------------------------------------------

_WORDS = """
{name}_slots AS (
  SELECT id, slot, count(*) AS c FROM (
    SELECT {id} AS id,
           CAST('0x' || substr(md5(lower(w)), 1, 8) AS BIGINT) % 768 AS slot
    FROM (SELECT {id}, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM {table} {where}))
  GROUP BY id, slot),
{name}_emb AS (
  SELECT s.id, slot, CAST(CAST(c / norm AS FLOAT) AS DOUBLE) AS w
  FROM {name}_slots s JOIN (SELECT id, sqrt(sum(c * c)) AS norm FROM {name}_slots GROUP BY id) n ON s.id = n.id)"""
_DOC_WORDS = _WORDS.format(name="doc", id="doc_id", table="documents", where="")
_ITEM_WORDS = _WORDS.format(name="item", id="item_id", table="benchmark", where="")


def _embedded_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", ["doc_id", "text"]).withColumnRenamed("doc_id", "id")
    return embedding.embed_texts(docs, dim=TEXT_DIM).select("id", "embedding")


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    return embedding.embed_texts(items, text_field="query", dim=TEXT_DIM)


@query(
    "q_hash_embed",
    f"WITH {_DOC_WORDS} SELECT id AS doc_id, CAST(slot AS INTEGER) AS slot, round(w, 6) AS weight FROM doc_emb",
)
def hash_embed(spark, sf):
    return (
        _embedded_documents(spark, sf)
        .select(F.col("id").alias("doc_id"), F.posexplode("embedding").alias("slot", "w"))
        .where(F.col("w") != 0)
        .select("doc_id", "slot", F.round(F.col("w").cast("double"), 6).alias("weight"))
    )


@query(
    "q_hash_embed_sparse",
    f"WITH {_DOC_WORDS} SELECT id AS doc_id, CAST(slot AS INTEGER) AS slot, round(w, 6) AS weight FROM doc_emb",
)
def hash_embed_sparse(spark, sf):
    """The filled places alone, without Python workers."""
    docs = embedding.embed_sparse(table(spark, sf, "documents", ["doc_id", "text"]), dim=TEXT_DIM)
    return docs.select("doc_id", F.inline(F.arrays_zip("embedding.slots", "embedding.weights")).alias("slot", "w")).select(
        "doc_id", "slot", F.round(F.col("w").cast("double"), 6).alias("weight")
    )


_TEXT_HITS = f"""{_DOC_WORDS}, {_ITEM_WORDS},
dots AS (SELECT i.id AS query_id, d.id AS id, sum(i.w * d.w) AS s
         FROM item_emb i JOIN doc_emb d ON i.slot = d.slot GROUP BY 1, 2),
text_sims AS (SELECT item_id AS query_id, doc_id AS id, round(coalesce(s, 0.0), 6) AS distance
              FROM benchmark CROSS JOIN documents
              LEFT JOIN dots ON dots.query_id = item_id AND dots.id = doc_id),
text_hits AS (SELECT query_id, id, distance,
                CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance DESC, id) AS INTEGER) AS rank
         FROM text_sims QUALIFY rank <= 10)"""


@query("q_search_text", f"WITH {_TEXT_HITS} SELECT * FROM text_hits")
def search_text(spark, sf):
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return search.search_text(
        items,
        _embedded_documents(spark, sf),
        lambda texts: embedding.embed_texts(texts, dim=TEXT_DIM),
        TEXT_DIM,
        K,
        digits=DIGITS,
    )


_TURN_WORDS = _WORDS.format(
    name="turn", id="turn_id",
    table="(SELECT conv_id * 1000 + turn AS turn_id, role, text FROM conversations)",
    where="WHERE role = 'user'",
)


@query(
    "q_search_turns",
    f"""WITH {_TURN_WORDS}, {_ITEM_WORDS},
    dots AS (SELECT t.id AS query_id, i.id AS id, sum(i.w * t.w) AS s
             FROM turn_emb t JOIN item_emb i ON i.slot = t.slot GROUP BY 1, 2),
    sims AS (SELECT turn_id AS query_id, item_id AS id, round(coalesce(s, 0.0), 6) AS distance
             FROM (SELECT conv_id * 1000 + turn AS turn_id FROM conversations WHERE role = 'user')
             CROSS JOIN benchmark LEFT JOIN dots ON dots.query_id = turn_id AND dots.id = item_id)
    SELECT query_id, id, distance,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance DESC, id) AS INTEGER) AS rank
    FROM sims QUALIFY rank <= 3""",
)
def search_turns(spark, sf):
    """User turns of conversations as questions against the benchmark passages."""
    turns = (
        table(spark, sf, "conversations")
        .where(F.col("role") == "user")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")
    )
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    return search.search_text(
        turns,
        embedding.embed_texts(items, dim=TEXT_DIM),
        lambda texts: embedding.embed_texts(texts, dim=TEXT_DIM),
        TEXT_DIM,
        3,
        digits=DIGITS,
    )


def _kept_hits(spark: SparkSession, sf: str):
    questions = _questions(spark, sf)
    hits = search.top_k(questions, _embedded_documents(spark, sf), TEXT_DIM, K, digits=DIGITS)
    return (
        questions.select("query_id", "query"),
        search.above_threshold(hits, TEXT_MIN_SCORE),
        search.hits_bound(table(spark, sf, "benchmark"), TEXT_DIM, K),
    )


_CONTEXT = f"""{_TEXT_HITS},
kept AS (SELECT h.*, text, source FROM text_hits h LEFT JOIN documents ON doc_id = id WHERE distance >= 0.3),
joined AS (SELECT query_id,
                  string_agg('[Source ' || rank || ': ' || coalesce(source, 'Document ' || rank) || ']' || chr(10)
                             || coalesce(text, ''), chr(10) || chr(10) ORDER BY rank) AS body,
                  avg(distance) FILTER (WHERE rank <= 3) AS conf,
                  count(*) AS n,
                  max(CASE WHEN rank = 1 THEN text END) AS top_text
           FROM kept GROUP BY query_id),
ctx AS (SELECT item_id AS query_id, benchmark.text AS query,
               coalesce(CASE WHEN length(body) > 8000 THEN substr(body, 1, 8000) || '...' ELSE body END, '') AS context,
               coalesce(conf, 0.0) AS confidence, coalesce(n, 0) AS n, top_text
        FROM benchmark LEFT JOIN joined ON query_id = item_id)"""


@query("q_context", f"WITH {_CONTEXT} SELECT query_id, context FROM ctx")
def context(spark, sf):
    queries, hits, bound = _kept_hits(spark, sf)
    sourced = search.attach_sources(hits, _sources(spark, sf), bound)
    return answering.with_contexts(queries, answering.build_context(sourced)).select(
        "query_id", "context"
    )


@query("q_confidence", f"WITH {_CONTEXT} SELECT query_id, round(confidence, 6) AS confidence FROM ctx")
def confidence(spark, sf):
    queries, hits, bound = _kept_hits(spark, sf)
    sourced = search.attach_sources(hits, _sources(spark, sf), bound)
    return answering.with_contexts(queries, answering.build_context(sourced)).select(
        "query_id", F.round("confidence", 6).alias("confidence")
    )


@query(
    "q_prompt",
    f"""WITH {_CONTEXT}
    SELECT query_id, md5('Role: assistant for clinical record questions.' || chr(10) || 'Rules:' || chr(10)
      || '- rely on the context alone and name the sources you use' || chr(10)
      || '- say so when the context is not enough' || chr(10) || chr(10)
      || 'Context:' || chr(10) || context || chr(10) || chr(10)
      || 'Question: ' || query || chr(10) || 'Answer:') AS prompt_md5 FROM ctx""",
)
def prompt(spark, sf):
    queries, hits, bound = _kept_hits(spark, sf)
    sourced = search.attach_sources(hits, _sources(spark, sf), bound)
    ready = answering.with_contexts(queries, answering.build_context(sourced))
    return ready.select(
        "query_id",
        F.md5(answering.build_prompt(F.col("context"), F.col("query"))).alias("prompt_md5"),
    )


_ANSWER = rf"""{_CONTEXT},
sentences AS (SELECT *, trim(regexp_extract(coalesce(top_text, ''), '^\s*([^.!?\n]+[.!?]?)', 1)) AS sentence FROM ctx),
answers AS (SELECT query_id, query, n, confidence, CASE WHEN sentence = ''
      THEN 'The indexed sources do not answer this question.' ELSE sentence || ' [Source 1]' END AS answer
    FROM sentences)"""


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    queries, hits, bound = _kept_hits(spark, sf)
    return answering.answer_hits(queries, hits, _sources(spark, sf), bound)


@query(
    "q_answer_batch",
    f"""WITH {_ANSWER}
    SELECT query_id, query, answer, round(confidence, 6) AS confidence, CAST(n AS INTEGER) AS n_sources,
           'For study and research only; ask a clinician before acting on this text.' AS disclaimer
    FROM answers""",
)
def answer_batch(spark, sf):
    return _answers(spark, sf).select(
        "query_id",
        "query",
        "answer",
        F.round("confidence", 6).alias("confidence"),
        F.size("sources").alias("n_sources"),
        "disclaimer",
    )


@query(
    "q_citations",
    f"""WITH {_ANSWER}
    SELECT a.query_id, 1 AS source_no, k.id, k.source
    FROM answers a JOIN kept k ON k.query_id = a.query_id AND k.rank = 1
    WHERE answer LIKE '%[Source 1]'""",
)
def citations(spark, sf):
    return answering.citations(_answers(spark, sf))


@query(
    "q_generate_hook",
    f"""WITH {_CONTEXT}
    SELECT query_id, 'length ' || CAST(length('Role: assistant for clinical record questions.' || chr(10) || 'Rules:' || chr(10)
      || '- rely on the context alone and name the sources you use' || chr(10)
      || '- say so when the context is not enough' || chr(10) || chr(10)
      || 'Context:' || chr(10) || context || chr(10) || chr(10)
      || 'Question: ' || query || chr(10) || 'Answer:') AS VARCHAR) AS answer FROM ctx""",
)
def generate_hook(spark, sf):
    """A pluggable batch text model: here one that reports the length of its prompt."""
    queries, hits, bound = _kept_hits(spark, sf)
    return answering.answer_hits(
        queries,
        hits,
        _sources(spark, sf),
        bound,
        generate_fn=lambda prompts: [f"length {len(p)}" for p in prompts],
    ).select("query_id", "answer")


@query(
    "q_chunks",
    """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS words
                  FROM documents),
    c AS (SELECT doc_id, words,
                 unnest(range(0, CAST(greatest(ceil((len(words) - 20) / 180.0), 1) AS BIGINT))) AS chunk_no
          FROM w WHERE len(words) > 0)
    SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no,
           CAST(len(words[chunk_no * 180 + 1 : chunk_no * 180 + 200]) AS INTEGER) AS n_words,
           md5(array_to_string(words[chunk_no * 180 + 1 : chunk_no * 180 + 200], ' ')) AS chunk_md5 FROM c""",
)
def chunks(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "text"])
    return embedding.chunk_words(docs, size=200, overlap=20, keep=("doc_id",)).select(
        "doc_id", "chunk_no", "n_words", F.md5("chunk").alias("chunk_md5")
    )
