"""Edge cases and brute-force comparisons of the training-data operators on small fixtures."""

import base64
import itertools
import math
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from medlake.llm import bpe, exact, langid, licenses, maxent, mixing, simhash, topk, toxicity, urls
from medlake.llm.queries import PATTERN, RANKS, URL_RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "keep_id string, kept string, score string, rule string, host string, licenses string, decoded string, target string"


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", f"s{i % 2}", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " \t\n", "One two three.", "ONE two three.", "One two three.", "x" * 70_000, "a b " * 40_000, "é ü"]


@pytest.fixture(scope="module")
def odd(spark):
    repeated = docs_of(spark, ["One two three."], 3)
    nulls = spark.createDataFrame([(None, "null id", None, None, None)] * 2, DOCS)
    clashing = docs_of(spark, ODD).unionByName(repeated).unionByName(nulls)
    return clashing.withColumns({c.split()[0]: F.lit("other") for c in CLASH.split(", ")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_copies(odd, empty):
    rows = exact.find_copies(odd).collect()
    assert len(rows) == 12 and exact.find_copies(empty).count() == 0
    by_text = Counter(lower(r["text"]) for r in odd.collect())
    assert sorted(r["group_size"] for r in rows) == sorted(n for n in by_text.values() for _ in range(n))
    three = [r for r in rows if r["group_size"] == 4]
    assert {r["keep_id"] for r in three} == {5} and sum(r["kept"] for r in three) == 1
    assert sum(r["kept"] for r in rows) == len(by_text)
    kept = exact.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(by_text)


def test_directory_doubles_until_buckets_fit(spark):
    log = spark.range(5000).select(F.xxhash64("id").alias("h")).unionByName(spark.range(3000).select(F.lit(7).cast("long").alias("h")))
    buckets = exact.directory(log, capacity=400)
    assert math.isclose(sum(2.0**-d for d, _ in buckets), 1.0)
    hashes = [r["h"] % 2**64 for r in log.collect()]
    for d, p in buckets:
        inside = [h for h in hashes if h >> (64 - d) == p]
        assert len(inside) <= 400 or len(set(inside)) == 1 or d == exact.MAX_DEPTH


def brute_fingerprint(text):
    words = lower(text).encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_four_positions_contain_a_triple():
    triples = [set(t) for t in simhash.position_triples()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in itertools.combinations(range(8), 4))


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, 3).astype(np.uint64)) for _ in range(600)]
    prints = sorted({int(c) for c in centres} | {int(centres[i % 40] ^ f) for i, f in enumerate(flips)})
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 4:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    for block in (simhash.BLOCK, 7):
        monkeypatch.setattr(simhash, "BLOCK", block)
        links = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"))
        roots = {r["node"] % 2**64: r["root"] % 2**64 for r in simhash.components(links).collect()}
        groups = Counter(find(p) for p in prints)
        assert len({roots.get(p, p) for p in prints}) == len(groups)
        assert all((roots.get(a, a) == roots.get(b, b)) == (find(a) == find(b)) for a, b in zip(prints, prints[1:]))


def test_near_copies(odd, empty):
    rows = simhash.near_groups(odd).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert len(rows) == 12 and simhash.near_groups(empty).count() == 0
    assert all(r["fp"] % 2**64 == brute_fingerprint(texts[r["doc_id"]]) for r in rows if r["doc_id"] is not None)
    assert {r["component_id"] for r in rows if r["doc_id"] in (0, 1, 2)} == {0}
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len({r["root"] for r in rows})


def test_mix(spark, odd, empty):
    rows, _ = mixing.mix(odd)
    assert rows.count() == 12 and mixing.mix(empty)[0].count() == 0 and mixing.take_mix(empty).count() == 0
    assert mixing.take_mix(odd).columns == odd.columns
    rng = np.random.default_rng(5)
    many = spark.createDataFrame(
        [(i, "w " * int(rng.integers(0, 60)), None, None if i % 3 == 0 else f"s{i % 3}", None) for i in range(3000)], DOCS
    )
    first, again = (sorted(map(tuple, mixing.mix(d)[0].collect())) for d in (many, many.repartition(7)))
    assert first == again
    for source in many.select("source").distinct().collect():
        part = many.where(F.col("source").eqNullSafe(source["source"])).select("doc_id")
        got = mixing.mix(many)[0].join(part, "doc_id").agg(F.sum("taken"), F.max("target"), F.max("copies")).first()
        assert abs(got[0] - got[1]) <= 0.01 * got[1] + 60 and got[2] <= 3


def test_buckets_fly_from_one_stream():
    """Buckets of several batches, and several of a batch, settle as each does alone."""
    rng = np.random.default_rng(7)
    keys = [(s, b) for s in ("=a", "~") for b in range(9) for _ in range(40 if b else 150)]
    rows = {"skey": [s for s, _ in keys], "bucket": pa.array([b for _, b in keys], pa.int32()), "unit": list(range(len(keys)))}
    rows |= {"words": rng.integers(0, 90, len(keys)).astype(float), "documents": np.ones(len(keys)), "chance": rng.random(len(keys))}
    table = pa.table(rows).select(["skey", "unit", "words", "documents", "chance", "bucket"])
    for last in (False, True):
        flown = pa.Table.from_batches(mixing._fly(last)(iter(table.to_batches(max_chunksize=64))))
        assert flown.drop_columns("chance") == table.drop_columns("chance")
        for key in sorted(set(keys)):
            at = np.array([k == key for k in keys])
            units, chances = list(zip(rows["words"][at], rows["documents"][at])), rows["chance"][at].tolist()
            want = mixing.flight(units, chances, int(np.flatnonzero(at)[0]) ^ len(units))
            want = mixing.landing(units, want, chances) if last else want
            assert flown["chance"].to_numpy()[at].tolist() == want
    assert not list(mixing._fly(False)(iter([])))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    units = [(float(rng.integers(0, 500)), 1.0) for _ in range(300)]
    chances = rng.random(300).tolist()
    flown = mixing.flight(units, chances, 9)
    assert sum(0 < p < 1 for p in flown) <= 2 and all(0 <= p <= 1 for p in flown)
    for k in (0, 1):
        assert math.isclose(sum(u[k] * p for u, p in zip(units, flown)), sum(u[k] * p for u, p in zip(units, chances)), rel_tol=1e-6)


def test_bpe_is_what_the_library_gives(spark, odd, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    shared = bpe.share_ranks(spark, RANKS)
    long = ["it's we're  \t\n 12 " * 9000, " " * 70_000 + "z", "!'" * 40_000, "ü" * 40_000 + " é's" * 9000, "日本語 テキスト " * 9000]
    rows = docs_of(spark, long, 100).unionByName(odd.select(*DOCS.replace(",", "").split()[::2]))
    got = bpe.decode(bpe.encode(rows, shared, PATTERN), shared).collect()
    want = Counter((r["doc_id"], tuple(library.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in rows.collect())
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["decoded"])) for r in got) == want
    assert bpe.encode(empty, shared, PATTERN).count() == 0


def test_language(spark, odd, empty, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.learn(docs)
    judged = langid.identify(odd, model).collect()
    assert all(0 <= r["score"] <= 1 for r in judged)
    assert {r["lang_pred"] for r in judged if r["doc_id"] in (0, 1, 2)} == {"und"}
    assert langid.identify(empty, model).count() == 0
    right = langid.identify(docs, model).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert {r["lang_pred"] for r in langid.identify(odd, langid.learn(empty)).collect()} == {"und"}


def test_language_filter_serves_many_languages():
    grams = [np.arange(n * 100, n * 100 + 150, dtype=np.uint64) for n in range(70)]
    model = langid.LanguageFilter.build([f"l{n:02}" for n in range(70)], grams)
    masks = model.masks(np.array([120, 6920], dtype=np.uint64))
    named = [{n for n in range(70) if int(m[n // 64]) >> (n % 64) & 1} for m in masks]
    assert {0, 1} <= named[0] and {68, 69} <= named[1]


def test_toxicity(spark, odd, empty):
    model = toxicity.learn(empty.withColumn("toxic", F.lit(None).cast("int")))
    texts = ["You are an idiot.", "You are not an idiot.", "A fine day.", None, ""]
    scores = [r["score"] for r in toxicity.score(docs_of(spark, texts), model).orderBy("doc_id").collect()]
    assert scores[0] > scores[2] == scores[3] == scores[4] and all(0 <= s <= 1 for s in scores)
    assert toxicity.score(odd, model).count() == 12 and toxicity.score(empty, model).count() == 0
    follow, written = toxicity.grammar()
    state = follow[follow[0][toxicity.NEGATION]][toxicity.OTHER]
    assert written[0][toxicity.INSULT] == 0 and written[state][toxicity.INSULT] == 1
    assert written[follow[0][toxicity.TARGET]][toxicity.THREAT] == 8 + 4


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(float).tolist()) for i in range(400)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, []), (None, [1.0] * 8), (404, [0.0] * 8), (7, [2.0] * 8), (405, [1.0] * 3)]
    # Beyond 32 bits after scaling, beyond 64 bits in the product, repeated ids and an empty query.
    rows += [(406, [2.0**26 + 0.5] * 8), (407, [-(2.0**40)] * 8), (408, [2.0**27] * 2), (420, [2.0**33, 0.25]), (20, [5.0] * 8), (440, [])]
    rows += [(0, rows[0][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("other"))
    got = sorted(map(tuple, topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 5).collect()))
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    want = []
    for q, v in {(i, tuple(v)) for i, v in ok if i % 20 == 0}:
        products = [(max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j) for j, w in ok if j != q]
        best = sorted((-s, j) for s, j in products)[:5]
        want += [(q, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert got == sorted(want)
    none = vectors.where("false")
    assert topk.top_k(none, none).count() == 0


def brute_top(vectors, query, k):
    scores = vectors @ query
    order = np.lexsort((np.arange(len(vectors)), -scores))[:k]
    return list(zip(order.tolist(), scores[order].astype(int).tolist()))


def searched(vectors, queries, k, least):
    cell = topk.Cell(np.arange(len(vectors)), vectors.astype(float))
    best = cell.search(queries.astype(float), topk.Best(k, np.full(len(queries), -1), np.asarray(least)))
    return [[(int(i), int(s)) for i, s in zip(best.ids[best.rows == n], best.scores[best.rows == n])] for n in range(len(queries))], cell.verified


def test_buckets_keep_copies_along_one_strong_coordinate():
    rng = np.random.default_rng(5)
    for sign in (-1, 1):
        rows = rng.integers(-40, 41, size=(3_000, 6))
        rows[:, 0] = sign * rng.integers(60, 140, size=len(rows))
        queries = np.array([[sign * 95, 10, 12, -9, 20, 5], [sign * 95, 31, 0, 0, 0, 0], [sign * 60, 30, 30, -30, 0, 0]])
        vectors = np.r_[rows, queries, queries + 1, 2 * queries, np.array([[sign * 139, 1, 0, 0, 0, 0]])]
        want = [brute_top(vectors, q, 10) for q in queries]
        # From nothing, and from thresholds that seeds would have given.
        for least in ([topk.NONE] * 3, [w[-1][1] for w in want], [w[-1][1] * 9 // 10 for w in want]):
            assert searched(vectors, queries, 10, least)[0] == want


@pytest.mark.parametrize("kind", ["lengths", "directions"])
def test_buckets_prune(kind):
    rng = np.random.default_rng(8)
    if kind == "lengths":  # few long vectors, many short ones
        vectors = np.round(rng.normal(size=(8_000, 16)) * np.r_[np.full(500, 100), np.full(7_500, 4)][:, None])
        queries = np.round(rng.normal(size=(40, 16)) * 30)
    else:  # groups along few strong coordinates
        centers = rng.normal(size=(50, 24)) * np.r_[np.full(6, 60), np.full(18, 3)]
        vectors = np.round(np.repeat(centers, 160, axis=0) + rng.normal(size=(8_000, 24)))
        queries = np.round(centers[:40])
    found, verified = searched(vectors, queries, 10, [topk.NONE] * 40)
    assert found == [brute_top(vectors, q, 10) for q in queries]
    assert verified < 0.5 * len(vectors) * len(queries)


def test_urls(spark):
    given = [None, "", "no scheme", "http://com", "http://A.Com/x", "https://example.com/en/1?x", "https://www.example.com/en/", "http://m.www.example.com/en/#a",
             "http://a.net/es/", "http://a.net/es", "http://net.example.org/fr/", "http://x.com?y://example.com/en/", "http://notexample.com/en/"]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("rule", F.lit("other"))
    trie = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, URL_RULES).collect()}
    assert [trie[i][0] for i in range(13)] == [None, None, None, None, "com/", "example.com/en/", "www.example.com/en/", "www.example.com/en/", "net/es/", None, None, None, "com/"]
    assert trie[5][1] == "block" and trie[6][1] == "allow" and trie[0][1] == "allow"
    table = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, table).collect()} == trie
    host, path = urls.host_and_path("url")
    joined = urls._joined(pages.drop("rule").withColumns({"host": host, "path": path}), table, "allow").collect()
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in joined} == trie
    assert urls.judge(pages.where("false"), URL_RULES).count() == 0


def test_licenses(spark, odd, empty):
    texts = ["a line\nReleased under the MIT License.\nend", "released UNDER the mit license", "Released under the MIT", None, ""]
    found = [r["licenses"] for r in licenses.scan(docs_of(spark, texts)).orderBy("doc_id").collect()]
    assert [[x["name"] for x in f] for f in found] == [["MIT"], ["MIT"], ["MIT"], [], []]
    assert found[0][0]["dice"] == 1.0 and found[2][0]["dice"] == round(6 / 7, 9)
    assert licenses.scan(odd).count() == 12 and licenses.scan(empty).count() == 0


def test_wrapped_and_inline_licenses(spark):
    isc, full = dict(licenses.TEMPLATES)["ISC"], dict(licenses.FULL_TEXTS)
    number = itertools.count()
    filler = lambda n: " ".join(f"w{next(number)}" for _ in range(n)) + " "
    wrap = lambda t, n: "\n".join(" ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    mit = "Released under the MIT License."
    texts = [
        filler(240) + "\n" + wrap(isc, 11) + "\n" + filler(240),
        filler(12) + mit + " " + filler(12),
        filler(12) + mit + " " + filler(12) + mit + "\n" + mit + "\n" + filler(40),
        *[filler(200) + "\n" + wrap(t, 9) + "\n" + filler(200) for _, t in sorted(full.items())],
        filler(360),
        "MIT released License. " + filler(12) + " under the",
    ]
    found = [r["licenses"] for r in licenses.scan(docs_of(spark, texts)).orderBy("doc_id").collect()]
    got = [{x["name"]: (x["dice"], x["n_pieces"]) for x in f} for f in found]
    assert got[0] == {"ISC": (1.0, 1)} and got[1] == {"MIT": (1.0, 1)} and got[2] == {"MIT": (1.0, 3)}
    for row, name in zip(got[3:6], sorted(full)):
        assert row[name] == (1.0, 1)
    assert got[6:] == [{}, {}]


def test_language_model(spark, odd, empty):
    model, counts = maxent.train(odd)
    got = {r["doc_id"]: r for r in maxent.score(odd, model, counts).collect()}
    words = {r["doc_id"]: lower(r["text"]).encode().split() + [b""] for r in odd.collect()}
    seen = Counter(w for r in odd.collect() for w in lower(r["text"]).encode().split() + [b""])
    n, v = sum(seen.values()), len(seen)
    assert model.layout.train_tokens == n
    for key, tokens in words.items():
        assert math.isclose(got[key]["base_score"], sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)
        assert got[key]["n_tokens"] == got[key]["n_known"] == len(tokens) and got[key]["score"] < 0
    norm, _ = model.tables()
    one = np.arange(maxent.HISTORY + 1)
    total = np.exp(model.weights.logits(one, one) - norm[one, one][:, None]).sum(axis=1)
    assert np.allclose(total, 1)
    assert maxent.score(empty, model, counts).count() == 0
    blank, no_counts = maxent.train(empty)
    assert {r["n_known"] for r in maxent.score(odd, blank, no_counts).collect()} == {0}
    assert {r["base_score"] for r in maxent.score(odd, blank, no_counts).collect()} == {0.0}


def test_language_model_knows_a_rare_end(spark, monkeypatch):
    monkeypatch.setattr(maxent, "FREQUENT", 4)
    docs = docs_of(spark, ["a b c d e f " * 50, "a b c d e g " * 40 + "h"])
    model, counts = maxent.train(docs)
    assert model.layout.words[-1] == b"" and model.layout.counts[-1] == 2
    got = {r["doc_id"]: r for r in maxent.score(docs, model, counts).collect()}
    words = {r["doc_id"]: r["text"].encode().split() + [b""] for r in docs.collect()}
    seen = Counter(w for tokens in words.values() for w in tokens)
    n, v = sum(seen.values()), len(seen)
    assert model.layout.rare_words.sum() == v - 5 and model.layout.rare_tokens.sum() == n - model.layout.counts.sum()
    for key, tokens in words.items():
        assert got[key]["n_tokens"] == got[key]["n_known"] == len(tokens)
        assert math.isclose(got[key]["base_score"], sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)


def test_language_model_learns_what_stands_before_rare_words(spark, monkeypatch):
    monkeypatch.setattr(maxent, "FREQUENT", 4)
    pairs = [("north", "qazzing"), ("south", "wexxing")]
    docs = docs_of(spark, [" ".join(f"{a} {b} it was" for _ in range(30)) for a, b in pairs] + ["north south it was " * 90])
    model, counts = maxent.train(docs)
    assert not {b.encode() for _, b in pairs} & set(model.layout.words) and {b"north", b"south"} <= set(model.layout.words)
    texts = ["north qazzing", "north wexxing", "south wexxing", "south qazzing", "north neverseening", "south neverseening"]
    got = [r["score"] for r in maxent.score(docs_of(spark, texts), model, counts).orderBy("doc_id").collect()]
    # All three words end alike, so that they share a class.
    assert got[0] > got[1] + 0.5 and got[2] > got[3] + 0.5 and got[0] > got[4] + 0.5 and got[2] > got[5] + 0.5
    _, logp = model.tables()
    for row in logp:
        total = np.bincount(model.layout.class_of, 10**row, maxent.CLASSES)
        assert np.allclose(total[np.unique(model.layout.class_of)], 1)


@pytest.mark.parametrize("piece", [16, 4_000_000])
def test_language_model_looks_a_word_up_once_for_all_its_places(monkeypatch, piece):
    monkeypatch.setattr(maxent, "PIECE_BYTES", piece, raising=False)
    crc, looked = zlib.crc32, []
    monkeypatch.setattr(maxent, "zlib", SimpleNamespace(crc32=lambda word: looked.append(word) or crc(word)))
    frequent, side = [b"the", b"", b"a"], maxent.HISTORY + 1
    rare = {b"rare": 7000, b"\xc3\xa9\x1cx\xc2\xa0y\xc2\x85": 2, b"so": 4}
    buckets = np.zeros((2, maxent.RARE_CLASSES * maxent.BUCKETS), dtype=np.int64)

    def bucket(word):
        return crc(word[-2:]) % maxent.RARE_CLASSES * maxent.BUCKETS + crc(word) % maxent.BUCKETS

    for word, n in rare.items():
        buckets[:, bucket(word)] += n, 1
    layout = maxent.Layout(frequent, np.array([50, 30, 20]), 7106, 6, *buckets)
    texts = ["", "  \x0b\r\n", " The RARE\x0c a\tso\x1f ", "\u00e9\x1cx\u00a0y\u0085 a \u00c9 the", "rare " * 7000 + "the", "so"]
    read = [t.encode().lower().split() + [b""] for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([5, 2, 5, 2, 2, 5], pa.int32())], ["text", "block"])

    def word(w):
        return (frequent.index(w), crc(w) & 0xFFFF) if w in frequent else (3 + bucket(w), crc(w[-2:]) & 0xFFFF)

    def slot(tokens, i, size):
        return size if i < 0 else word(tokens[i])[1] % size

    # Counts of words and of histories.
    counted = Counter()
    for part in maxent._count_words(iter([batch, batch])):
        counted.update(dict(zip(part["word"].to_pylist(), part["n"].to_pylist())))
    assert counted == Counter(w.decode() for tokens in read * 2 for w in tokens)
    cells = Counter()
    for tokens in read:
        for i, w in enumerate(tokens):
            history = slot(tokens, i - 2, maxent.HISTORY) * side + slot(tokens, i - 1, maxent.HISTORY)
            cells[0, history * maxent.CLASSES + layout.class_of[word(w)[0]]] += 1
            cells[1, slot(tokens, i - 1, maxent.WORD_HISTORY) * len(layout.class_of) + word(w)[0]] += 1
    parts = list(maxent._count_histories(layout)(iter([batch])))
    assert cells == {(k, c): n for part in parts for k, c, n in zip(*(part[name].to_pylist() for name in ("kind", "cell", "n")))}

    # Distinct rare words of each block.
    found = {(b, w) for part in maxent._rare_words(layout)(iter([batch])) for b, w in zip(part["block"].to_pylist(), part["word"].to_pylist())}
    assert found == {(b, w.decode()) for b, tokens in zip([5, 2, 5, 2, 2, 5], read) for w in tokens if w not in frequent}

    # Scores beside the sum over the tokens, one after another.
    made = np.random.default_rng(3)
    weights = maxent.ClassWeights(made.normal(size=maxent.CLASSES), *made.normal(size=(2, side, maxent.CLASSES)))
    model = maxent.MaxEntModel(layout, weights, -made.random((maxent.WORD_HISTORY + 1, len(layout.class_of))))
    known = pa.table({"word": [w.decode() for w in rare] * 2, "n": list(rare.values()) * 2})
    docs = pa.table({"doc_id": pa.chunked_array([[5, 4], [3, 2, 1, 0]]), "text": pa.chunked_array([texts[:2], texts[2:]])})
    got = maxent._score_block(model)(docs, known)
    norm, words = model.tables()
    assert got["doc_id"].to_pylist() == [5, 4, 3, 2, 1, 0]
    for row, tokens in zip(got.to_pylist(), read):
        base = score = 0.0
        for i, w in enumerate(tokens):
            unit, n = word(w)[0], int(layout.counts[frequent.index(w)]) if w in frequent else rare.get(w, 0)
            two, one, cls = slot(tokens, i - 2, maxent.HISTORY), slot(tokens, i - 1, maxent.HISTORY), layout.class_of[unit]
            base += math.log10((n + 1) / (7106 + 6 + 1))
            score += (weights.bias[cls] + weights.one[one, cls] + weights.two[two, cls] - norm[two, one]) / math.log(10)
            score += words[slot(tokens, i - 1, maxent.WORD_HISTORY), unit if n else layout.unseen(unit)]
            if w in rare:
                score += math.log10((n + 1) / buckets[:, bucket(w)].sum())
        assert (row["n_tokens"], row["n_known"]) == (len(tokens), sum(w in frequent or w in rare for w in tokens))
        assert math.isclose(row["base_score"], base, rel_tol=1e-9) and math.isclose(row["score"], score, rel_tol=1e-9)
    # The word that comes 7,000 times.
    assert looked.count(b"rare") < 20


def test_pipeline_stages(spark, sf, empty):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf)
        assert kept.columns == docs.columns, name
        assert name == "mix" or kept.exceptAll(before).count() == 0
    assert kept.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
    junk = docs_of(spark, [None, "", "123 456", "!!!"], 10**9)
    assert corpus_pipeline.language(spark, docs.unionByName(junk), sf).where(f"doc_id >= {10**9}").count() == 0
