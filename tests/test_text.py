import random
import re

import pytest
from pyspark.sql import functions as F

from medlake.functions import text

CASES = [
    (None, ""),
    ("", ""),
    ("a\r\nb\rc", "a\nb\nc"),
    ("a \t  b", "a b"),
    ("x   \n  kept lead", "x\n kept lead"),
    ("a\n\n\n\n\nb", "a\n\nb"),
    ("　\x85 a  \n", "a"),
    ("98°F café", "98F caf"),
    ("“quote” — dash…", "quote  dash"),
    ("no significant findings", "no significant FINDINGS"),
    ("Finding: x. Clinical\n  indication: y", "FINDINGS: x. CLINICAL INDICATION: y"),
    ("Impressions stay, impression goes", "Impressions stay, IMPRESSION goes"),
    ("conclusion", "CONCLUSION"),
    ("find°ings", "FINDINGS"),
]


def test_cleaning_edges(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)], "i int, raw string")
    got = {r.i: r.c for r in df.select("i", text.clean_text(F.col("raw")).alias("c")).collect()}
    assert [got[i] for i in range(len(CASES))] == [want for _, want in CASES]


def test_preserved_punctuation(spark):
    df = spark.createDataFrame([("“q” — ‘x’…",)], "raw string")
    got = df.select(text.clean_text(F.col("raw"), "preserve")).first()[0]
    assert got == "\"q\" - 'x'..."
    with pytest.raises(ValueError):
        text.clean_text(F.col("raw"), "other")


def test_strip_equals_python_on_random_unicode(spark):
    rng = random.Random(7)
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"
    letters = "ab​᠎﻿é"
    rows = [
        (i, "".join(rng.choice(spaces + letters) for _ in range(rng.randint(0, 12))))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "i int, s string")
    got = {r.i: r.t for r in df.select("i", text.strip_unicode(F.col("s")).alias("t")).collect()}
    assert got == {i: s.strip() for i, s in rows}


def test_chain_on_random_unicode(spark):
    """Each step stated once more with Python's own regular expressions."""
    rng = random.Random(11)
    pieces = ["a", " ", "\t", "\n", "\r", "\r\n", "é", "’", "finding", "Indication", "clinical", "\x07", "　"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))) for i in range(500)]

    def expected(s):
        for pattern, to in [("\r\n|\r", "\n"), ("[ \t]+", " "), (" +\n", "\n"), ("\n\n\n+", "\n\n")]:
            s = re.sub(pattern, to, s)
        s = "".join(c for c in s.strip() if c in "\n\t" or " " <= c <= "~")
        s = re.sub(r"(?i)\bclinical\s+indication\b", "CLINICAL INDICATION", s)
        for word in ("indication", "finding", "findings"):
            s = re.sub(rf"(?i)\b{word}\b", "FINDINGS" if word[0] == "f" else word.upper(), s)
        return s

    df = spark.createDataFrame(rows, "i int, s string")
    got = {r.i: r.t for r in df.select("i", text.clean_text(F.col("s")).alias("t")).collect()}
    assert got == {i: expected(s) for i, s in rows}


def test_length_gate(spark):
    df = spark.createDataFrame([("x" * 49,), ("x" * 50,)], "c string")
    assert [r[0] for r in df.select(text.long_enough(F.col("c"))).collect()] == [False, True]


def test_decode_falls_back_to_latin1(spark):
    rows = [(bytearray("café".encode()),), (bytearray("café".encode("latin-1")),), (None,)]
    df = spark.createDataFrame(rows, "content binary")
    got = [r[0] for r in df.select(text.decode_bytes(F.col("content"))).collect()]
    assert got == ["café", "café", None]
