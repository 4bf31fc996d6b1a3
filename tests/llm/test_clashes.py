"""Columns named like an operator's own, and structs with odd field names, pass through unchanged."""

from pyspark.sql import functions as F

import corpus_pipeline
from medlake.llm import bpe, exact, langid, mixing, simhash, toxicity, urls
from medlake.llm.queries import PATTERN, RANKS, URL_RULES

OWN = ["__llm_key", "__llm_letters", "__llm_unit", "__llm_copies", "__llm_copy", "__llm_host", "__llm_path", "key", "row"]


def given(spark):
    rows = [(i, f"one two three four five six {i // 2}", "en", f"s{i % 2}", None) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = F.struct(F.lit(1).alias("a-b"), F.lit("x").alias("c d")).alias("odd struct")
    return docs.select("*", odd, *[F.lit("other").alias(c) for c in OWN])


def test_filters_keep_such_columns(spark):
    docs = given(spark)
    for kept in (exact.drop_copies(docs), simhash.drop_near_copies(docs), mixing.take_mix(docs), corpus_pipeline.language(spark, docs, "")):
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert rows and all(r["odd struct"] == (1, "x") and all(r[c] == "other" for c in OWN) for r in rows)
    assert exact.drop_copies(docs).count() == 6


def test_scores_keep_such_columns(spark):
    docs = given(spark)
    model = langid.learn(docs)
    pages = docs.withColumn("url", F.lit("http://example.com/en/x"))
    encoded = bpe.encode(docs, bpe.share_ranks(spark, RANKS), PATTERN).withColumn("odd struct", F.struct(F.lit(1).alias("a-b"), F.lit("x").alias("c d")))
    for out in (langid.identify(docs, model), toxicity.score(docs, toxicity.ToxicityModel()), urls.judge(pages, URL_RULES)):
        rows = out.collect()
        assert len(rows) == 12 and all(r["odd struct"] == (1, "x") and all(r[c] == "other" for c in OWN) for r in rows)
    assert all(r["odd struct"] == (1, "x") for r in bpe.decode(encoded, bpe.share_ranks(spark, RANKS)).collect())


def test_hosts_fold_only_ascii_in_both_forms(spark):
    kelvin, dotted = "Kelvin.com", "İ.org"
    rules = [(kelvin, "/", "block"), (dotted, "/", "block"), ("Plain.COM", "/", "block")]
    hosts = ["kelvin.com", kelvin, "i̇.org", dotted, "PLAIN.com"]
    pages = spark.createDataFrame([(f"http://{h}/x",) for h in hosts], "url string")
    listed = [(r["host"], r["verdict"]) for r in urls.judge(pages, rules).collect()]
    host, path = urls.host_and_path("url")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    joined = urls._joined(pages.withColumns({"host": host, "path": path}), table, "allow").collect()
    assert sorted(listed) == sorted((r["host"], r["verdict"]) for r in joined)
    assert sorted(v for _, v in listed) == ["allow", "allow", "block", "block", "block"]
