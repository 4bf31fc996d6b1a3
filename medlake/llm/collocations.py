"""Phrase collocations by best-first branch and bound over word and phrase counts.

A phrase of two or three words scores by the share of its occurrences in those of the parts that its worst cut leaves. As
a phrase is never more frequent than its rarest part, the counts of its prefix and of the words that follow bound
its score from above before it is counted. The frontier is expanded from the highest bounds down:

1. One pass counts words. Words below the least frequency can be in no candidate. Count ranges of the others go into a table of
   fixed size by hash (``SLOTS``): of words that share a slot, the range covers all, so a bound is only ever too high.
2. A pass counts the phrases whose bound reaches the round's threshold.
3. From the surviving prefixes, a second pass counts the parts that the cuts of three-word phrases need, and the
   longer phrases around two-word ones. Which pairs it looks for is again a table of fixed size (``PAIRS``) that can
   only name too many.
4. Scores of at least the threshold are now exact and complete. Languages with enough surviving phrases there, ties included,
   are settled; the others go on with the next threshold. The last is zero, which expands everything.

Texts are cut into words and phrases in tasks, in blocks of ``BLOCK`` characters; a block's phrases are counted before they leave it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlake.llm.common import bounded_hint, cut, small_batches, tidy

TOP = 2_000
LEAST = 10
SCALE = 1_000_000
#: Scores down to which a round expands; the last leaves nothing out.
ROUNDS = (250_000, 20_000, 1_000, 0)
BLOCK = 8 << 20
SLOTS = 1 << 22
PAIRS = 1 << 24
UNKNOWN = "und"
BLANKS = b"\x20\x09"
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
#: A bound is met where it misses the threshold by no more than rounding could.
MARGIN = 1 - 1e-9
ROWS = 32_768


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    lower, kind = np.arange(256, dtype=np.uint8), np.zeros(256, dtype=np.uint8)
    lower[65:91] += 32
    kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
    return lower, kind


def _count_edges(least: int) -> np.ndarray:
    """Borders of count ranges, a twentieth apart."""
    edges = [max(1, least)]
    while edges[-1] < 1 << 61:
        edges.append(max(edges[-1] + 1, edges[-1] * 21 // 20))
    return np.array(edges, dtype=np.int64)


class Words:
    """The words of texts in order, as codes, and whether each is followed by the next in one piece."""

    def __init__(self, texts: list[str]):
        lower, kinds = _byte_tables()
        raw = lower[np.frombuffer("\n".join(texts).encode(), dtype=np.uint8)]
        kind = kinds[raw]
        word = kind == 0
        edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[word])]
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        self.distinct, self.codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        self.linked = piece[1:] == piece[:-1]

    def phrases(self, at: np.ndarray, length: int) -> tuple[pa.Array, np.ndarray]:
        """Distinct phrases of ``length`` words that begin at the positions ``at``, and how often each does."""
        many, parts = max(1, len(self.distinct)), self.codes[at]
        for i in range(1, length):
            known, place = np.unique(parts, return_inverse=True)
            parts = place.astype(np.int64) * many + self.codes[at + i]
        _, first, counts = np.unique(parts, return_index=True, return_counts=True)
        begin = at[first]
        words = [self.distinct.take(pa.array(self.codes[begin + i])) for i in range(length)]
        return pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())), counts


def _hashes(lang: str, words: Sequence[str]) -> np.ndarray:
    head = f"{lang}\n".encode()
    return np.fromiter((xxhash.xxh64_intdigest(head + w.encode()) for w in words), dtype=np.uint64, count=len(words))


def _pair_slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + second
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed ^ (mixed >> np.uint64(29))) & np.uint64(PAIRS - 1)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[str, Words]]:
    """Whole texts of one language at a time, together about ``block`` characters or one longer text."""
    waiting: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                waiting.setdefault(lang, []).append(text)
                size += len(text)
            if size >= block:
                yield from ((name, Words(texts)) for name, texts in waiting.items())
                waiting, size = {}, 0
    yield from ((name, Words(texts)) for name, texts in waiting.items())


FOUND = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("a", pa.int64())])


def _told(lang: str, words: int, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(phrases), ROWS):
        part = phrases[i : i + ROWS].cast(pa.string())
        n = len(part)
        yield pa.record_batch([pa.array([lang] * n), pa.array([words] * n, pa.int32()), part, pa.array(counts[i : i + n])], FOUND)


def _count_words(block: int):
    def run(batches):
        for lang, words in _blocks(batches, block):
            # The row with no words holds the number of all.
            yield from _told(lang, 0, pa.array([""], pa.large_string()), np.array([len(words.codes)]))
            yield from _told(lang, 1, words.distinct, np.bincount(words.codes, minlength=len(words.distinct)))

    return run


def _ranges(words: Words, lang: str, low, high, edges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, least and greatest possible count of every position's word; 0 where it is below the least frequency."""
    hashes = _hashes(lang, words.distinct.to_pylist())
    slots = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
    least = np.where(low[slots] > 0, edges[np.maximum(low[slots], 1) - 1], 0).astype(np.float64)
    most = np.where(high[slots] > 0, edges[np.minimum(high[slots], len(edges) - 1)] - 1, 0).astype(np.float64)
    return hashes[words.codes], least[words.codes], most[words.codes]


def _grow(table, threshold: int, least_count: int, block: int):
    """Counts the phrases that could score ``threshold`` or more."""

    def run(batches):
        low, high = table.value
        edges = _count_edges(least_count)
        for lang, words in _blocks(batches, block):
            _, least, most = _ranges(words, lang, low, high, edges)
            known = most > 0
            pair = words.linked & known[:-1] & known[1:]
            # A pair is at most as frequent as its rarer word, and every part at least as frequent as the pair.
            reach = np.minimum(most[:-1], most[1:]) * SCALE >= threshold * np.maximum(least[:-1], least[1:]) * MARGIN
            yield from _told(lang, 2, *words.phrases(np.flatnonzero(pair & reach), 2))
            # The same for three: their count over that of the first word, or of the last.
            rarest = np.minimum(np.minimum(most[:-2], most[1:-1]), most[2:])
            reach = rarest * SCALE >= threshold * np.maximum(least[:-2], least[2:]) * MARGIN
            yield from _told(lang, 3, *words.phrases(np.flatnonzero(pair[:-1] & pair[1:] & reach), 3))

    return run


def _complete(table, wanted, least_count: int, block: int):
    """Counts wanted pairs, and phrases of three words around pairs that are candidates."""

    def run(batches):
        low, high = table.value
        parts, candidates = (np.unpackbits(np.frombuffer(w, dtype=np.uint8)).astype(bool) for w in wanted.value)
        edges = _count_edges(least_count)
        for lang, words in _blocks(batches, block):
            hashes, _, most = _ranges(words, lang, low, high, edges)
            known = most > 0
            pair = words.linked & known[:-1] & known[1:]
            slots = _pair_slots(hashes[:-1], hashes[1:])
            yield from _told(lang, 2, *words.phrases(np.flatnonzero(pair & parts[slots]), 2))
            near = candidates[slots]
            around = pair[:-1] & pair[1:] & (near[:-1] | near[1:])
            yield from _told(lang, 3, *words.phrases(np.flatnonzero(around), 3))

    return run


def _range_table(words: DataFrame, least_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest count range of the words in every slot, 0 where there is none."""

    def run(batches):
        edges = _count_edges(least_count)
        for batch in batches:
            slots = np.fromiter(
                (xxhash.xxh64_intdigest(f"{g}\n{w}".encode()) & (SLOTS - 1) for g, w in zip(*(c.to_pylist() for c in batch.columns[:2]))),
                dtype=np.int64,
                count=len(batch),
            )
            ranges = np.searchsorted(edges, batch.column(2).to_numpy(), side="right")
            yield pa.record_batch([pa.array(slots), pa.array(ranges, pa.int64())], names=["slot", "range"])

    found = words.select("lang", "phrase", "a").mapInArrow(run, "slot long, range long")
    spans = found.groupBy("slot").agg(F.min("range").alias("low"), F.max("range").alias("high")).toArrow()
    low, high = np.zeros(SLOTS, dtype=np.uint16), np.zeros(SLOTS, dtype=np.uint16)
    slots = spans["slot"].to_numpy()
    low[slots], high[slots] = spans["low"].to_numpy(), spans["high"].to_numpy()
    return low, high


def _pair_filter(pairs: DataFrame) -> bytes:
    """Bits of the slots that ``pairs(lang, phrase)`` fall into."""

    def run(batches):
        for batch in batches:
            split = [(g, *p.split(" ")) for g, p in zip(*(c.to_pylist() for c in batch.columns))]
            sides = (np.fromiter((xxhash.xxh64_intdigest(f"{x[0]}\n{x[i]}".encode()) for x in split), np.uint64, len(split)) for i in (1, 2))
            yield pa.record_batch([pa.array(np.unique(_pair_slots(*sides)))], names=["slot"])

    bits = np.zeros(PAIRS, dtype=bool)
    bits[pairs.select("lang", "phrase").mapInArrow(run, "slot long").distinct().toArrow()["slot"].to_numpy()] = True
    return np.packbits(bits).tobytes()


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly."""
    big = "cast({} as decimal(18,0))".format
    return F.expr(f"({SCALE} * {big(a)} * {big(a)}) div ({big(left)} * {big(right)})")


def _word(which: int) -> Column:
    return F.element_at(F.split("phrase", " "), which)


def _counted(docs: DataFrame, run, least: int, label: str) -> DataFrame:
    found = docs.mapInArrow(tidy(run), "lang string, words int, phrase string, a long")
    sums = found.groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a"))
    return cut(sums.where((F.col("a") >= least) | (F.col("words") == 0)), label)


def _round(texts: DataFrame, words: DataFrame, table, threshold: int, least: int, block: int) -> DataFrame:
    """``(lang, phrase, a, l, r, score)``: every surviving phrase that scores ``threshold`` or more."""
    spark = texts.sparkSession
    grown = _counted(texts, _grow(table, threshold, least, block), least, "grown")
    single = bounded_hint(words.where("words = 1").select("lang", "phrase", "a"), 96)

    def with_count(df: DataFrame, key: Column, counts: DataFrame, name: str) -> DataFrame:
        side = counts.select(F.col("lang"), F.col("phrase").alias("__part"), F.col("a").alias(name))
        return df.withColumn("__part", key).join(side, ["lang", "__part"]).drop("__part")

    pairs = with_count(with_count(grown.where("words = 2"), _word(1), single, "l"), _word(-1), single, "r")
    pairs = pairs.withColumn("score", _score("a", "l", "r")).where(F.col("score") >= threshold)
    pairs = cut(pairs.select("lang", "phrase", "a", "l", "r", "score"), "pairs")
    triples = with_count(with_count(grown.where("words = 3"), _word(1), single, "first"), _word(-1), single, "last")
    reach = F.col("a") * SCALE * 1.0 >= F.lit(threshold * MARGIN) * F.greatest("first", "last")
    head, tail = F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)
    triples = cut(triples.where(reach).select("lang", "phrase", "a", "first", "last", head.alias("head"), tail.alias("tail")), "triples")
    parts = triples.select("lang", F.explode(F.array("head", "tail")).alias("phrase")).distinct()
    wanted = spark.sparkContext.broadcast((_pair_filter(parts), _pair_filter(pairs)))
    try:
        completed = _counted(texts, _complete(table, wanted, least, block), least, "completed")
    finally:
        wanted.unpersist()
    counted = completed.where("words = 2")
    triples = with_count(with_count(triples, F.col("head"), counted, "head_count"), F.col("tail"), counted, "tail_count")
    triples = triples.withColumn("after1", _score("a", "first", "tail_count")).withColumn("after2", _score("a", "head_count", "last"))
    earlier = F.col("after1") <= F.col("after2")
    triples = triples.select(
        "lang",
        "phrase",
        "a",
        F.when(earlier, F.col("first")).otherwise(F.col("head_count")).alias("l"),
        F.when(earlier, F.col("tail_count")).otherwise(F.col("last")).alias("r"),
        F.least("after1", "after2").alias("score"),
    ).where(F.col("score") >= threshold)
    longer = completed.where("words = 3").select("lang", F.explode(F.array(head, tail)).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = pairs.join(longer, ["lang", "phrase"], "left").where("longest is null or 100 * longest < 50 * a").drop("longest")
    return cut(kept.unionByName(triples), "survivors")


def mine(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = TOP,
    least: int = LEAST,
    rounds: Sequence[int] = ROUNDS,
    block: int = BLOCK,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of every language.

    Words are runs without blank and tab inside pieces between punctuation and line ends, A-Z lower-cased. Candidates are phrases of two
    or three words that occur ``least`` times or more. Cut after its first words, a phrase scores ``a * a / (l * r)`` in millionths, by its
    lowest-scoring cut, then the shortest first part. A phrase that lies in a longer candidate with at least half its occurrences is dropped.
    Ties of score go to the larger ``a``, then to the phrase in byte order. A null language is ``und``; null and empty texts have no words; texts
    are read whole. Repeated rows count again; other columns are ignored. An empty table gives an empty result. ``rounds`` only decides
    when what is counted: a final 0 is added where it is missing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where("text is not null")
    words = _counted(texts, _count_words(block), least, "words")
    sizes = words.where("words = 0").select("lang", F.col("a").alias("n"))
    table = spark.sparkContext.broadcast(_range_table(words.where("words = 1"), least))
    waiting, settled = cut(sizes.select("lang"), "waiting"), []
    for threshold in rounds if 0 in rounds else (*rounds, 0):
        if waiting.isEmpty():
            break
        survivors = _round(texts.join(bounded_hint(waiting, 64), "lang", "left_semi"), words, table, threshold, least, block)
        if threshold == 0:
            settled.append(survivors)
            break
        enough = cut(survivors.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= top).select("lang"), "enough")
        settled.append(survivors.join(bounded_hint(enough, 64), "lang", "left_semi"))
        waiting = cut(waiting.join(bounded_hint(enough, 64), "lang", "left_anti"), "waiting")
    best = spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, score long")
    for more in settled:
        best = best.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    told = ranked.join(bounded_hint(cut(sizes, "sizes"), 64), "lang")
    return told.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
