"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the frequent n-grams of all languages: each slot is a bitmask with
one bit per language. The AND of an n-gram's slots names all languages that contain it at once. Over a text,
the bits of each language are counted; a count is corrected for the false positives that the fill of
its slice makes likely, and the language with the largest corrected share wins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlake.llm.common import added, received, replace, ship, slices, spare, text_of, tidy

#: Bytes per n-gram.
SIZES = (3, 5)
#: Documents learned from, about, per language: a bounded sample, drawn by the hash of the text.
TRAIN_DOCS = 2_000
#: N-grams kept per language and size, the most frequent ones.
KEPT = 6_000
MIN_SEEN = 2
HASHES = 3
SLOT_BITS = 18
#: n-grams judged in one go.
STEP = 1 << 18
UNKNOWN = "und"


def letters_only(text_col: str) -> Column:
    """Lower-case letters with one blank around every run of others; empty if there is no letter."""
    words = F.trim(F.regexp_replace(F.lower(text_of(text_col)), r"[^\p{L}\p{M}]+", " "))
    return F.when(words.rlike(r"\p{L}"), F.concat(F.lit(" "), words, F.lit(" "))).otherwise(F.lit(""))


def _codes(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """n-grams of all texts of a batch as integers, at most ``STEP`` at a time.

    With each piece come the number of its first text and where each text's n-grams begin in it.
    """
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    for begin in range(0, len(data), STEP):
        part = data[begin : begin + STEP + size - 1]
        count = max(0, len(part) - size + 1)
        codes = np.zeros(count, dtype=np.uint64)
        for k in range(size):
            codes = codes << np.uint64(8) | part[k : k + count].astype(np.uint64)
        codes |= np.uint64(size) << np.uint64(56)
        # n-grams that would run into the next text are left out.
        keep = np.ones(count, dtype=bool)
        first = int(np.searchsorted(offsets, begin, "right")) - 1
        last = int(np.searchsorted(offsets, begin + count + size, "left"))
        for k in range(1, size):
            inner = offsets[first + 1 : last] - begin - k
            keep[inner[(inner >= 0) & (inner < count)]] = False
        edges = np.clip(offsets[first : last + 1] - begin, 0, count)
        yield codes[keep], first, np.r_[0, np.cumsum(keep)][edges]


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            texts = batch.column("text").filter(pa.array(langs == lang))
            for size in SIZES:
                for found, _, _ in _codes(texts, size):
                    codes, seen = np.unique(found, return_counts=True)
                    columns = [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(seen, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "n"])


@dataclass
class LanguageFilter:
    """``slots[i, w]``: bitmask word w of slot i; bit b of word w stands for language 64 w + b."""

    langs: list[str]
    slots: np.ndarray

    @classmethod
    def build(cls, langs: list[str], grams: list[np.ndarray], bits: int = SLOT_BITS) -> LanguageFilter:
        slots = np.zeros((1 << bits, max(1, -(-len(langs) // 64))), dtype=np.uint64)
        for n, codes in enumerate(grams):
            for place in _places(codes, bits):
                slots[place, n // 64] |= np.uint64(1) << np.uint64(n % 64)
        return cls(langs, slots)

    def false_positive(self) -> np.ndarray:
        """Per language, the chance that an absent n-gram is reported."""
        fill = [((self.slots[:, n // 64] >> np.uint64(n % 64)) & np.uint64(1)).mean() for n in range(len(self.langs))]
        return np.array(fill) ** HASHES

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """All languages containing each n-gram, as bitmask words."""
        bits = int(len(self.slots) - 1).bit_length()
        first, *others = _places(codes, bits)
        found = self.slots[first]
        for place in others:
            found &= self.slots[place]
        return found

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per text: n-grams found in each language, and all n-grams."""
        found, total = np.zeros((len(column), len(self.langs))), np.zeros(len(column))
        for size in SIZES:
            for codes, first, edges in _codes(column, size):
                texts = slice(first, first + len(edges) - 1)
                total[texts] += np.diff(edges)
                masks = self.masks(codes)
                for n in range(len(self.langs)):
                    bit = (masks[:, n // 64] >> np.uint64(n % 64)) & np.uint64(1)
                    found[texts, n] += np.diff(np.r_[0, np.cumsum(bit, dtype=np.int64)][edges])
        return found, total

    def judge(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score (corrected share of the n-grams that the language contains) of each text."""
        if not self.langs:
            return [UNKNOWN] * len(column), np.zeros(len(column))
        found, total = self.counts(column)
        wrong = self.false_positive()
        share = found / np.maximum(total, 1)[:, None]
        share = np.clip((share - wrong) / np.maximum(1 - wrong, 1e-9), 0, 1)
        best = share.argmax(axis=1)
        known = total > 0
        names = [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, share[np.arange(len(best)), best], 0.0)


def _places(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        mixed = (codes ^ (codes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        other = (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(20) | np.uint64(1)
        mask = np.uint64((1 << bits) - 1)
        return [((mixed + np.uint64(i) * other) & mask).astype(np.int64) for i in range(HASHES)]


def learn(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_DOCS
) -> LanguageFilter:
    """A filter from rows with a language; rows without one are not used.

    ``per_language`` bounds the sample: languages with more rows are thinned to about that many by
    the hash of the text. Counting runs on Spark; the driver gets at most ``KEPT`` n-grams per language
    and size. No labelled row gives a filter without languages, which calls every text ``und``.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.broadcast(sizes.select("lang", (F.lit(float(per_language)) / F.col("n")).alias("share")))
    sample = rows.join(share, "lang").where(draw < F.col("share")).select("lang", letters_only("text").alias("text"))
    grams = (
        sample.mapInArrow(tidy(_count_ngrams), "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= MIN_SEEN)
        .withColumn("size", F.shiftright("code", 56))
    )
    rank = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "code"))
    found = grams.withColumn("rank", rank).where(F.col("rank") <= KEPT).select("lang", "code").toArrow()
    names, codes = np.array(found["lang"].to_pylist(), dtype=object), found["code"].to_numpy().view(np.uint64)
    langs = sorted(set(names))
    return LanguageFilter.build(langs, [codes[names == lang] for lang in langs])


def identify(
    docs: DataFrame, model: LanguageFilter, text_col: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``lang_pred`` and ``score``; columns of these names are replaced.

    A text that is null, empty or has no letter is ``und`` with score 0; one too short for
    an n-gram that any language contains gets score 0 and the first language. Whole texts are read,
    repeated rows get the same answer, an empty table gives an empty one.
    """
    clean = spare(docs, "__llm_letters")
    docs = replace(docs.withColumn(clean, letters_only(text_col)), ["lang_pred", "score"])
    given = [c for c in docs.columns if c != clean and (keep is None or c in keep)]
    docs = docs.select(*[f"`{c}`" for c in given], clean)
    shared = ship(docs.sparkSession, model)
    schema = added(docs.drop(clean).schema, lang_pred="string", score="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = received(shared)
        for batch in slices(batches):
            names, scores = judge.judge(batch.column(clean))
            kept = [batch.column(c) for c in given]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*given, "lang_pred", "score"]
            )

    return docs.mapInArrow(tidy(run), schema)
