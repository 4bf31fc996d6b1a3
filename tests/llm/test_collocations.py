"""Collocations against a plain evaluation, in one round and in several, with nulls, ties and long texts."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from medlake.llm import collocations


def plain(rows, top, least):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\f\r]", lower):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            of = counts.setdefault(lang, Counter())
            for k in (1, 2, 3):
                of.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in found.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = [q for q in found if len(q) > len(p) and p in (q[:2], q[1:])]
            if not any(100 * found[q] >= 50 * a for q in inside):
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def texts(seed=5, many=400):
    dice = random.Random(seed)
    names = ["new york city", "per se", "ad hoc", "vice versa", "United Nations", "ü ö", "a a a"]
    rare = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(many):
        words = [dice.choice(["the", "of", "and", *rare, *names]) + dice.choice([" ", " ", " ", "\t", ", ", ".\n", "\v", "\x85"]) for _ in range(dice.randint(0, 60))]
        rows.append((dice.choice(["en", "en", "en", "de", None]), "".join(words)))
    return rows + [("en", None), ("fr", ""), ("fr", "..."), (None, None), ("de", "ad hoc " * 20_000)] + rows[:20]


@pytest.mark.parametrize("top, rounds", [(5, (250_000, 20_000, 1_000, 0)), (30, (600_000, 50_000)), (10_000, (0,))])
def test_collocations_equal_a_plain_evaluation(spark, top, rounds):
    rows = texts()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    clashing = docs.withColumns({c: F.lit("other") for c in ("phrase", "words", "a", "n", "score", "rank")})
    got = collocations.mine(clashing, top=top, least=5, rounds=rounds, block=3_000)
    assert sorted(map(tuple, got.collect())) == plain(rows, top, 5)


def test_shared_slots_only_loosen_bounds(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLOTS", 4)
    monkeypatch.setattr(collocations, "PAIRS", 8)
    rows = texts(7, 120)
    got = collocations.mine(spark.createDataFrame(rows, "lang string, text string"), top=8, least=5, block=2_000)
    assert sorted(map(tuple, got.collect())) == plain(rows, 8, 5)


def test_exact_beyond_64_bits(spark):
    big = spark.createDataFrame([(10**13, 10**13 + 1, 10**13 + 3)], "a long, l long, r long")
    score = big.select(collocations._score("a", "l", "r")).first()[0]
    assert score == 10**6 * 10**26 // ((10**13 + 1) * (10**13 + 3))


def test_empty(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine(docs).count() == 0
