"""The operators as queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlake.llm import bpe, collocations, exact, langid, licenses, maxent, merkle, mixing, sharding, simhash, topk, toxicity, urls
from medlake.llm.common import key_remainder

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Score from which a text counts as toxic.
TOXIC = 0.7
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = key_remainder("doc_id", 4) == 2
    model = langid.learn(docs.where(~held_out))
    judged = langid.identify(docs, model, keep=["doc_id"])
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    ranks = bpe.share_ranks(spark, RANKS)
    both = bpe.decode(bpe.encode(docs, ranks, PATTERN), ranks)
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "toxic").where("toxic is not null")
    held_out = key_remainder("doc_id", 3) == 1
    model = toxicity.learn(docs.join(labels, "doc_id").where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op6_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mix(_table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op7_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(_table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")
    return found.select(
        "doc_id",
        F.array_join(F.transform("licenses", lambda x: x["name"]), ",").alias("licenses"),
        F.aggregate("licenses", F.lit(0), lambda a, x: a + x["n_pieces"]).alias("n_pieces"),
        F.array_max(F.transform("licenses", lambda x: x["dice"])).alias("best_dice"),
    )


def op9_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = key_remainder("doc_id", 7) == 2
    model, counts = maxent.train(docs.where(~held_out))
    return maxent.score(docs, model, counts).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.layout.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op10_extendible_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.find_copies(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_bounded_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents", "text", "lang"))


def op12_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(_table(spark, sf_dir, "documents", "doc_id", "text"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_interval_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", *merkle.FIELDS)
    cleared = F.when(key_remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit("")))
    made = merkle.manifest(docs, altered=F.when(F.col("doc_id").isNotNull(), cleared))
    return made.rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_filters,
        op2_byte_bpe,
        op3_toxicity_grammar,
        op4_simhash_groups,
        op5_norm_bucket_topk,
        op6_cube_mix,
        op7_url_trie,
        op8_license_dice,
        op9_maxent_scores,
        op10_extendible_dedup,
        op11_bounded_collocations,
        op12_ring_shards,
        op13_interval_manifest,
    )
}

_TOPK_SQL = """
WITH ints AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM ints q JOIN ints c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""

_URL_SQL = """
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages
), rules(host, path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), ranked AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, coalesce(r.verdict, 'allow') AS verdict,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) DESC NULLS LAST, length(r.path) DESC) AS nth
    FROM parts p LEFT JOIN rules r
        ON ('.' || p.host) LIKE ('%.' || r.host) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, verdict FROM ranked WHERE nth = 1
"""

_LICENSE_SQL = f"""
WITH templates AS (
    SELECT name, list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS grams
    FROM (
        SELECT name, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
        FROM (VALUES {", ".join(f"('{n}', '{t}')" for n, t in licenses.TEMPLATES)}) v(name, text)
    )
), lines AS (
    SELECT doc_id, row_number() OVER () AS row, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
        lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS lines
    FROM documents
), pieces AS (
    SELECT row, string_split(unnest(CASE WHEN len(lines) > 1
        THEN list_append(lines, array_to_string(lines, ' ')) ELSE lines END), ' ') AS w
    FROM lines
), grams AS (
    SELECT row, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams
    FROM pieces WHERE len(w) > 1
), dices AS (
    SELECT g.row, t.name, round(2.0 * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)), 9) AS dice
    FROM grams g JOIN templates t ON len(g.grams) BETWEEN len(t.grams) * 0.6 AND len(t.grams) * 1.6
), found AS (
    SELECT row, name, max(dice) AS dice, CAST(count(*) AS INTEGER) AS n_pieces FROM dices WHERE dice >= 0.8 GROUP BY row, name
), told AS (
    SELECT row, string_agg(name, ',' ORDER BY name) AS licenses, CAST(sum(n_pieces) AS INTEGER) AS n_pieces, max(dice) AS best_dice
    FROM found GROUP BY row
)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_pieces, 0) AS n_pieces, best_dice
FROM lines LEFT JOIN told USING (row)
"""

_EXACT_SQL = """
WITH norm AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM norm
WINDOW w AS (PARTITION BY norm)
"""

_COLLOCATION_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), sizes AS (
    SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
        FROM words, range(1, 4) t(k)
    ) GROUP BY ALL
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10
), cuts AS (
    SELECT c.lang, c.k, c.phrase, c.a, i, x.f AS l, y.f AS r,
        (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM candidates c, range(1, 3) t(i)
    JOIN counts x ON x.lang = c.lang AND x.k = i AND x.phrase = array_to_string(c.w[1 : i], ' ')
    JOIN counts y ON y.lang = c.lang AND y.k = c.k - i AND y.phrase = array_to_string(c.w[i + 1 : c.k], ' ')
    WHERE i < c.k
), worst AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), inside AS (
    SELECT lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase, a FROM candidates WHERE k = 3
), longer AS (
    SELECT lang, phrase, max(a) AS longest FROM inside GROUP BY ALL
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM worst LEFT JOIN longer USING (lang, phrase) JOIN sizes USING (lang)
WHERE k = 3 OR longest IS NULL OR 100 * longest < 50 * a
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= 2000
"""

_MANIFEST_SQL = """
WITH RECURSIVE fields AS (
    SELECT *, list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
            lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')) AS head,
        list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
            lambda i: ascii(CAST(doc_id AS VARCHAR)[i]))),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
    FROM documents
), entries AS (
    SELECT coalesce('=' || source, '') AS tree, doc_id,
        sha256(array_to_string(head, '') || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        CASE WHEN crc & 1 = 1 THEN sha256(array_to_string(head, '')
            || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) END AS altered
    FROM fields
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth FROM entries
), levels(tree, level, hs) AS (
    SELECT tree, 0, list(leaf ORDER BY nth) FROM leaves GROUP BY tree
    UNION ALL
    SELECT tree, level + 1, list_transform(range(0, (len(hs) + 2) // 3), lambda i: sha256(array_to_string(hs[3 * i + 1 : 3 * i + 3], '')))
    FROM levels WHERE len(hs) > 1
), subroots AS (
    SELECT tree, hs[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS nth FROM levels WHERE len(hs) = 1
), crown(level, hs) AS (
    SELECT 0, list(subroot ORDER BY nth) FROM subroots
    UNION ALL
    SELECT level + 1, list_transform(range(0, (len(hs) + 2) // 3), lambda i: sha256(array_to_string(hs[3 * i + 1 : 3 * i + 3], '')))
    FROM crown WHERE len(hs) > 1
), runs AS (
    SELECT l.tree, l.nth, v.level, v.hs, CAST(floor(l.nth / pow(3, v.level)) AS BIGINT) AS i
    FROM leaves l JOIN levels v ON v.tree = l.tree WHERE len(v.hs) > 1
    UNION ALL
    SELECT l.tree, l.nth, 1000 + c.level, c.hs, CAST(floor(s.nth / pow(3, c.level)) AS BIGINT)
    FROM leaves l JOIN subroots s USING (tree), crown c WHERE len(c.hs) > 1
), steps AS (
    SELECT tree, nth, row_number() OVER (PARTITION BY tree, nth ORDER BY level) AS step,
        CASE WHEN i % 3 > 0 THEN array_to_string(hs[i - i % 3 + 1 : i], '') ELSE '' END AS before,
        array_to_string(hs[i + 2 : i - i % 3 + 3], '') AS after
    FROM runs
), folded(tree, nth, step, h) AS (
    SELECT tree, nth, 0, coalesce(altered, leaf) FROM leaves
    UNION ALL
    SELECT f.tree, f.nth, f.step + 1, sha256(s.before || f.h || s.after)
    FROM folded f JOIN steps s ON s.tree = f.tree AND s.nth = f.nth AND s.step = f.step + 1
), proofs AS (
    SELECT tree, nth, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256, max(step) AS last FROM steps GROUP BY tree, nth
)
SELECT l.doc_id, l.leaf, s.subroot, r.hs[1] AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
    f.h AS folded_root, f.h = r.hs[1] AS verified
FROM leaves l
JOIN subroots s USING (tree)
LEFT JOIN proofs p ON p.tree = l.tree AND p.nth = l.nth
JOIN folded f ON f.tree = l.tree AND f.nth = l.nth AND f.step = coalesce(p.last, 0)
CROSS JOIN (SELECT hs FROM crown WHERE len(hs) = 1) r
"""

ORACLES: dict[str, str] = {
    "op5_norm_bucket_topk": _TOPK_SQL,
    "op7_url_trie": _URL_SQL,
    "op8_license_dice": _LICENSE_SQL,
    "op10_extendible_dedup": _EXACT_SQL,
    "op11_bounded_collocations": _COLLOCATION_SQL,
    "op13_interval_manifest": _MANIFEST_SQL,
}
