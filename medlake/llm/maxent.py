"""Language-model scoring with a hashed maximum-entropy model and a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). The ``FREQUENT`` most frequent
training tokens and the end are dealt into classes by frequency; all others, also unseen ones, into classes by
the hash of their last two bytes.

* Class factor: softmax over a bias, the hash of the word before (bigram) and of the word before that
  (skip); of words that are not frequent, the ending is hashed. The sums over the corpus that its gradient needs are counted in one pass; every update then runs
  over them on Spark, and the driver gets one bounded gradient.
* Word factor: softmax within the class over the frequency of every training word and a feature that hashes the word before
  with the word, trained by gradient updates for one hash value of the word before per task. A frequent word has such a feature to
  itself, the others share those of ``BUCKETS`` hash values in their class, so that all of them depend on the word before. The sum
  over a class is exact: words that share a feature add up to the smoothed count of their bucket.

Tasks split texts into words with Arrow, a few megabytes at once, look each distinct word up once and then work on arrays of
numbers. Scoring joins counts to the distinct rare words of a block of documents.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlake.llm.common import cut, text_of, tidy

FREQUENT = 4_096
CLASSES = 32
#: Classes of the words that are not frequent, the last ones.
RARE_CLASSES = 16
ENDING = 2
#: Hash values of the words that are not frequent, in each of their classes.
BUCKETS = 512
#: Hash values of the words before in the class factor, and in the word factor.
HISTORY = 128
WORD_HISTORY = 32
UPDATES = 12
WORD_UPDATES = 20
#: Bytes of text in a scoring block, of words that a task holds back, and of text that it works on at once.
BLOCK_BYTES = 24_000_000
HELD_BYTES = 24_000_000
PIECE_BYTES = 4_000_000
#: Pull towards the word frequencies, in observations.
PRIOR = 8.0
FIXED_POINT = float(1 << 20)
END = ""


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in their order, ``PIECE_BYTES`` and one text more at most."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // PIECE_BYTES)) + 1).tolist(), len(texts)]
    return (texts.slice(i, j - i) for i, j in zip(cuts, cuts[1:]) if j > i)


def _split(texts: pa.Array) -> pa.Array:
    """The words of each text lower-cased in A-Z; blanks at its edges leave empty ones."""
    return pc.ascii_split_whitespace(pc.ascii_lower(texts))


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words with the end as the last one, the number of every token's word, and the tokens of each text, the end included."""
    lists = _split(texts)
    found = lists.flatten().dictionary_encode()
    numbers, words = found.indices.to_numpy(), found.dictionary
    real = numbers != pc.index(words, END).as_py()
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    sizes = np.bincount(text[real], minlength=len(texts)) + 1
    inner = np.ones(sizes.sum(), dtype=bool)
    inner[np.cumsum(sizes) - 1] = False
    token = np.full(len(inner), len(words))
    token[inner] = numbers[real]
    return pa.concat_arrays([words, pa.array([END], words.type)]), token, sizes


def _before(values: np.ndarray, sizes: np.ndarray, first: int) -> np.ndarray:
    """The values one token before in texts of the given sizes; ``first`` stands before a text."""
    moved = np.r_[first, values[:-1]]
    moved[np.cumsum(sizes) - sizes] = first
    return moved


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts, once per task or per ``HELD_BYTES`` of words; the end is the empty word."""
    def out(words: list[pa.Array]) -> pa.RecordBatch:
        counts = pa.chunked_array(words).value_counts()
        counts = counts.filter(pc.not_equal(counts.field("values"), END))
        return pa.RecordBatch.from_arrays([counts.field("values").cast(pa.string()), counts.field("counts")], ["word", "n"])

    words, size, texts = [], 0, 0
    for batch in batches:
        texts += len(batch)
        for piece in _pieces(batch.column("text")):
            words.append(_split(piece).flatten())
            size += words[-1].nbytes
            if size >= HELD_BYTES:
                yield out(words)
                words, size = [], 0
    if words:
        yield out(words)
    if texts:
        yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([texts])], ["word", "n"])


@dataclass
class Layout:
    """Numbers of the frequent tokens, their classes, and the totals of the training tokens."""

    words: list[bytes]
    counts: np.ndarray
    train_tokens: int
    vocabulary: int
    #: Tokens and words of each bucket of words that are not frequent, class by class.
    rare_tokens: np.ndarray
    rare_words: np.ndarray

    def __post_init__(self) -> None:
        """The class of every unit: the frequent words, the buckets, and the unseen words of each class of buckets."""
        weight = np.cumsum(np.sqrt(self.counts))
        share, classes = weight / weight[-1] if len(weight) else weight, CLASSES - RARE_CLASSES
        rare = classes + np.arange(RARE_CLASSES)
        self.class_of = np.r_[np.minimum((share * classes).astype(int), classes - 1), np.repeat(rare, BUCKETS), rare]

    def masses(self) -> np.ndarray:
        """Smoothed counts of the units; what was never seen counts once in each class."""
        return np.r_[self.counts, self.rare_tokens + self.rare_words, np.ones(RARE_CLASSES)].astype(float)

    def unseen(self, unit: np.ndarray) -> np.ndarray:
        """The unit of unseen words in the class of a bucket."""
        return len(self.words) + RARE_CLASSES * BUCKETS + (unit - len(self.words)) // BUCKETS

    def reader(self) -> _Reader:
        return _Reader(self)


class _Reader:
    """Looks up units and hashes; of words that are not frequent the unit is their bucket, and the ending is hashed."""

    def __init__(self, layout: Layout):
        self.words = pa.array(layout.words, pa.binary()).cast(pa.string())
        self.hashes = np.fromiter(map(zlib.crc32, layout.words), np.int64, len(layout.words)) & 0xFFFF

    def read(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        unit = pc.index_in(words, value_set=self.words.cast(words.type)).fill_null(-1).to_numpy().astype(np.int64)
        often, rare = np.flatnonzero(unit >= 0), np.flatnonzero(unit < 0)
        others = words.take(pa.array(rare)).cast(pa.binary()).to_pylist()
        whole = np.fromiter(map(zlib.crc32, others), np.int64, len(others))
        ending = np.fromiter((zlib.crc32(w[-ENDING:]) for w in others), np.int64, len(others))
        hashes = np.empty_like(unit)
        hashes[often], hashes[rare] = self.hashes[unit[often]], ending & 0xFFFF
        unit[rare] = len(self.words) + ending % RARE_CLASSES * BUCKETS + whole % BUCKETS
        return unit, hashes


def _count_histories(layout: Layout):
    """Cells of (skip, bigram, class) and of (bigram, unit) of a task's training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, class_of, width = layout.reader(), layout.class_of, len(layout.class_of)
        classes = np.zeros((HISTORY + 1) ** 2 * CLASSES, dtype=np.int64)
        words = np.zeros((WORD_HISTORY + 1) * width, dtype=np.int64)
        for batch in batches:
            for piece in _pieces(batch.column("text")):
                distinct, token, sizes = _tokens(piece)
                unit, hashes = reader.read(distinct)
                one = _before((hashes % HISTORY)[token], sizes, HISTORY)
                two = _before(one, sizes, HISTORY)
                np.add.at(classes, (two * (HISTORY + 1) + one) * CLASSES + class_of[unit][token], 1)
                one = _before((hashes % WORD_HISTORY)[token], sizes, WORD_HISTORY)
                np.add.at(words, one * width + unit[token], 1)
        for kind, cells in ((0, classes), (1, words)):
            found = np.flatnonzero(cells)
            columns = [pa.array(np.full(len(found), kind, np.int32)), pa.array(found), pa.array(cells[found])]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "cell", "n"])

    return run


@dataclass
class ClassWeights:
    """Natural-log weights of the class factor."""

    bias: np.ndarray
    one: np.ndarray
    two: np.ndarray

    def logits(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        return self.bias + self.one[one] + self.two[two]


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def _gradient(weights: ClassWeights):
    """Expected counts per (feature, class) over the histories of a task, in fixed point so that sums agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = 2 * (HISTORY + 1) + 1
        total = np.zeros((rows, CLASSES))
        for batch in batches:
            history, n = batch.column("history").to_numpy(), batch.column("n").to_numpy().astype(float)
            two, one = history // (HISTORY + 1), history % (HISTORY + 1)
            expected = _softmax(weights.logits(two, one)) * n[:, None]
            total[0] += expected.sum(axis=0)
            np.add.at(total, 1 + one, expected)
            np.add.at(total, 2 + HISTORY + two, expected)
        cells = np.rint(total.ravel() * FIXED_POINT).astype(np.int64)
        found = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(cells[found])], ["cell", "n"])

    return run


def _train_classes(cells: DataFrame) -> ClassWeights:
    """Gradient updates on the class factor, scaled by what was observed and expected of each feature."""
    side = HISTORY + 1
    history = F.floor(F.col("cell") / CLASSES)
    cls = F.col("cell") % CLASSES
    feature = F.explode(F.array(F.lit(0), 1 + history % side, 2 + HISTORY + F.floor(history / side)))
    sums = (
        cells.select(feature.alias("feature"), cls.alias("cls"), "n")
        .groupBy((F.col("feature") * CLASSES + F.col("cls")).alias("cell"))
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    seen = np.zeros((2 * side + 1) * CLASSES)
    seen[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    seen = seen.reshape(-1, CLASSES)
    histories = cut(cells.groupBy(history.alias("history")).agg(F.sum("n").alias("n")), "histories")
    bias = np.log((seen[0] + 1) / (seen[0].sum() + CLASSES))
    start = (seen[1:] + PRIOR * np.exp(bias)) / (seen[1:].sum(axis=1, keepdims=True) + PRIOR)
    start = (np.log(start) - bias) / 2
    weights = ClassWeights(bias, start[:side], start[side:])
    for _ in range(UPDATES):
        got = histories.mapInArrow(_gradient(weights), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        expected = np.zeros(seen.size)
        expected[got["cell"].to_numpy()] = got["n"].to_numpy() / FIXED_POINT
        step = (seen - expected.reshape(-1, CLASSES)) / (seen + expected.reshape(-1, CLASSES) + PRIOR)
        weights = ClassWeights(weights.bias + 0.5 * step[0], weights.one + 0.5 * step[1 : 1 + side], weights.two + 0.5 * step[1 + side :])
    return weights


def _train_words(layout: Layout):
    """Weights of (one hash of the word before, unit) by gradient updates; returns log P(unit | class)."""
    class_of = layout.class_of
    with np.errstate(divide="ignore"):  # an empty bucket
        base = np.log(layout.masses())
    learned = len(base) - RARE_CLASSES

    def within(logits: np.ndarray) -> np.ndarray:
        top = np.full(CLASSES, -np.inf)
        np.maximum.at(top, class_of, logits)
        total = np.bincount(class_of, np.exp(logits - top[class_of]), CLASSES)
        return logits - top[class_of] - np.log(total[class_of])

    def run(table: pa.Table) -> pa.Table:
        seen = np.zeros(len(base))
        seen[table["word"].to_numpy()] = table["n"].to_numpy()
        in_class = np.bincount(class_of, seen, CLASSES)[class_of]
        weight = np.zeros(len(base))
        for _ in range(WORD_UPDATES):
            expected = in_class * np.exp(within(base + weight))
            weight += 0.8 * (seen - expected - weight) / (seen + expected + PRIOR)
            weight[learned:] = 0
        out = within(base + weight)
        return pa.table({"slot": table["slot"][:1], "logp": pa.array([out.tolist()], pa.list_(pa.float64()))})

    return run, within(base)


@dataclass
class MaxEntModel:
    layout: Layout
    weights: ClassWeights
    #: log P(unit | class) per hash of the word before.
    words: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Normalisers of all histories, and log10 of the word factor."""
        side = np.arange(HISTORY + 1)
        logits = self.weights.bias + self.weights.one[None, :, None, :] + self.weights.two[:, None, None, :]
        logits = logits.reshape(len(side), len(side), CLASSES)
        top = logits.max(axis=-1)
        return top + np.log(np.exp(logits - top[..., None]).sum(axis=-1)), self.words / math.log(10)


def train(texts: DataFrame, text_col: str = "text") -> tuple[MaxEntModel, DataFrame]:
    """A model and the table of its word counts, from all rows of ``texts`` (null: empty)."""
    rows = texts.select(text_of(text_col).alias("text"))
    counts = cut(rows.mapInArrow(tidy(_count_words), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    words, often = [w.encode() for w in top["word"].to_pylist()], top["n"].to_numpy().astype(np.int64)
    if words and END.encode() not in words:
        # The end is looked up by its number only; in long documents it is not among the most frequent.
        words, often = [*words, END.encode()], np.r_[often, counts.where(F.col("word") == END).first()["n"]]
    ending = F.crc32(F.substring(F.col("word").cast("binary"), -ENDING, ENDING))
    bucket = F.pmod(ending, F.lit(RARE_CLASSES)) * BUCKETS + F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(BUCKETS))
    sums = counts.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()
    rare = np.zeros((2, RARE_CLASSES * BUCKETS), dtype=np.int64)
    rare[:, sums["bucket"].to_numpy()] = sums["n"].to_numpy(), sums["v"].to_numpy()
    for word, n in zip(words, often):
        rare[:, zlib.crc32(word[-ENDING:]) % RARE_CLASSES * BUCKETS + zlib.crc32(word) % BUCKETS] -= (n, 1)
    layout = Layout(words, often, totals["n"], totals["v"], *rare)
    side = HISTORY + 1
    run, base = _train_words(layout)
    logp = np.tile(base, (WORD_HISTORY + 1, 1))
    if not layout.words:
        flat = ClassWeights(np.zeros(CLASSES), np.zeros((side, CLASSES)), np.zeros((side, CLASSES)))
        return MaxEntModel(layout, flat, logp), counts
    cells = rows.mapInArrow(tidy(_count_histories(layout)), "kind int, cell long, n long")
    cells = cut(cells.groupBy("kind", "cell").agg(F.sum("n").alias("n")), "cells")
    weights = _train_classes(cells.where("kind = 0"))
    width = len(layout.class_of)
    pairs = cells.where("kind = 1").select(
        F.floor(F.col("cell") / width).cast("int").alias("slot"), (F.col("cell") % width).cast("int").alias("word"), "n"
    )
    for row in pairs.groupBy("slot").applyInArrow(run, "slot int, logp array<double>").collect():
        logp[row["slot"]] = row["logp"]
    return MaxEntModel(layout, weights, logp), counts


def _rare_words(layout: Layout):
    """Distinct words of a task's blocks that are not frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = pa.array([*layout.words, END.encode()], pa.binary()).cast(pa.string())

        def out(held: dict[int, list[pa.Array]]) -> Iterator[pa.RecordBatch]:
            for block, words in held.items():
                found = pa.chunked_array(words).unique().cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block, np.int32)), found], ["block", "word"])

        held, size = {}, 0
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for block in np.unique(blocks).tolist():
                for piece in _pieces(batch.column("text").filter(pa.array(blocks == block))):
                    words = _split(piece).flatten().unique()
                    words = words.filter(pc.invert(pc.is_in(words, value_set=frequent.cast(words.type))))
                    held.setdefault(block, []).append(words)
                    size += words.nbytes
            if size >= HELD_BYTES:
                yield from out(held)
                held, size = {}, 0
        yield from out(held)

    return run


def _score_block(model: MaxEntModel):
    def run(docs: pa.Table, rare: pa.Table) -> pa.Table:
        layout, reader = model.layout, model.layout.reader()
        norm, word_logp = model.tables()
        weights = model.weights
        # log10 of the class factor, of every word two before, word before and class.
        class_logp = ((weights.bias + weights.one + weights.two[:, None] - norm[..., None]) / math.log(10)).ravel()
        known, count = rare["word"].combine_chunks(), np.r_[rare["n"].to_numpy(), 0]
        base_rest = math.log10(layout.train_tokens + layout.vocabulary + 1)
        inside = np.log10(np.maximum(layout.rare_tokens + layout.rare_words, 1.0))
        width, columns = len(layout.words), [[], [], [], []]
        for piece in (p for chunk in docs["text"].chunks for p in _pieces(chunk)):
            words, token, sizes = _tokens(piece)
            unit, hashes = reader.read(words)
            others = np.flatnonzero(unit >= width)
            seen = np.r_[layout.counts, np.zeros(len(word_logp[0]) - width, np.int64)][unit]
            seen[others] = count[pc.index_in(words.take(pa.array(others)), value_set=known.cast(words.type)).fill_null(len(known)).to_numpy()]
            gained, cls, within = np.log10(seen + 1.0), layout.class_of[unit], np.zeros(len(unit))
            # A word's share of its bucket; a word that was never seen is a unit of its own.
            within[others] = np.where(seen[others] > 0, gained[others] - inside[unit[others] - width], 0.0)
            unit[others] = np.where(seen[others] > 0, unit[others], layout.unseen(unit[others]))
            one = _before((hashes % HISTORY)[token], sizes, HISTORY)
            two = _before(one, sizes, HISTORY)
            score = class_logp[(two * (HISTORY + 1) + one) * CLASSES + cls[token]]
            one = _before((hashes % WORD_HISTORY)[token], sizes, WORD_HISTORY)
            score += word_logp[one, unit[token]] + within[token]
            starts = np.cumsum(sizes) - sizes
            columns[0].append(sizes)
            columns[1].append(np.add.reduceat((seen > 0).astype(np.int64)[token], starts))
            columns[2].append(np.add.reduceat(gained[token], starts) - sizes * base_rest)
            columns[3].append(np.add.reduceat(score, starts))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        columns = [pa.chunked_array([pa.array(part, k) for part in c], k) for c, k in zip(columns, kinds)]
        names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
        return pa.table([docs["doc_id"], *columns], names=names)

    return run


def score(docs: DataFrame, model: MaxEntModel, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` per row of ``docs``, whole texts (null: empty).

    ``score`` is the model's log10 probability of the words and the end, ``base_score`` that of smoothed word
    counts. An empty text is scored on its end. Without any training text every token is unseen. Repeated rows and
    null ids give a row each; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = total // BLOCK_BYTES + 1
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    dealt = rows.withColumn("block", block).repartition(int(blocks), "block")
    rare = dealt.select("block", "text").mapInArrow(tidy(_rare_words(model.layout)), "block int, word string")
    told = rare.join(counts, "word")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        dealt.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(_score_block(model), f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    )
