"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols (insult, threat, target, negation, reported speech, other). Small
transducers read the symbols of a clause one after the other: each passes them on and rewrites
insults and threats in its context, as negated, reported or aimed at somebody. Their composition is one table
of states; each insult or threat leaves it as one of 16 patterns. A clause is scored by the weights of its words
and patterns, and the document by its clauses. Lists of general words are given; insult stems,
pattern weights and the final scale are learned from labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlake.llm.common import added, cut, received, replace, ship, slices, tidy

#: Labelled documents learned from, at most about (drawn by hash), and stems kept.
TRAIN_DOCS = 16_000
STEMS = 5_000
#: Beginnings of words in toxic texts that are looked up in the others, the most frequent ones.
CANDIDATES = 200_000
STEM_LENGTHS = range(3, 9)
MIN_TOXIC = 6
MIN_WEIGHT = math.log(20)
#: How many words a negation, a reporting verb or a target reaches.
REACH = {"negation": 3, "report": 6, "target": 5}

# Fixed word lists of the grammar.
WORDS = {
    "insult": "idiot moron stupid fool loser scum trash worthless pathetic disgusting imbecile jerk",
    "threat": "kill hurt destroy beat burn punish crush",
    "target": "you your yours u he she they him her them everyone people",
    "negation": "not no never neither nor without isn aren wasn don doesn didn",
    "report": "said says say called calls wrote told claimed reported quoted asked",
}
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SYMBOL = {"insult": INSULT, "threat": THREAT, "target": TARGET, "negation": NEGATION, "report": REPORT}
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
MEMO = 300_000


@dataclass(frozen=True)
class Transducer:
    """Reads symbols and marks insults and threats within ``reach`` words after ``trigger``.

    States count the words left; a symbol is (kind, marks).
    """

    trigger: int
    mark: int
    reach: int

    def step(self, state: int, symbol: tuple[int, int]) -> tuple[int, tuple[int, int]]:
        kind, marks = symbol
        if kind == self.trigger:
            return self.reach, symbol
        if kind in (INSULT, THREAT) and state:
            symbol = (kind, marks | self.mark)
        return max(0, state - 1), symbol


@dataclass(frozen=True)
class Composed:
    """Two transducers in a row, the second reading what the first writes."""

    first: Transducer | Composed
    second: Transducer

    def step(self, state, symbol):
        one, passed = self.first.step(state[0], symbol)
        two, written = self.second.step(state[1], passed)
        return (one, two), written


def grammar() -> tuple[list[list[int]], list[list[int]]]:
    """The composed machine as tables: next state and written pattern (-1: none) per state and kind.

    Patterns are 8 * threat + marks, with marks 1 negated, 2 reported, 4 aimed at somebody.
    """
    machine = Composed(
        Composed(Transducer(NEGATION, 1, REACH["negation"]), Transducer(REPORT, 2, REACH["report"])),
        Transducer(TARGET, 4, REACH["target"]),
    )
    number, queue = {((0, 0), 0): 0}, [((0, 0), 0)]
    follow, written = [], []
    for state in queue:
        follow.append([])
        written.append([])
        for kind in range(6):
            to, (_, marks) = machine.step(state, (kind, 0))
            if to not in number:
                number[to] = len(number)
                queue.append(to)
            follow[-1].append(number[to])
            written[-1].append({INSULT: marks, THREAT: 8 + marks}.get(kind, -1))
    return follow, written


@dataclass
class ToxicityModel:
    stems: dict[str, float] = field(default_factory=dict)
    #: Weights of the document features, the constant last.
    scale: list[float] = field(default_factory=lambda: [1.0, 0.3] + [0.2] * 16 + [-3.0])

    def reader(self):
        """word -> (kind, weight), remembered."""
        fixed = {w: SYMBOL[k] for k, words in WORDS.items() for w in words.split()}
        stems, base = self.stems, 4.0

        class Memo(dict):
            def __missing__(self, word: str) -> tuple[int, float]:
                found = (fixed[word], base if fixed[word] in (INSULT, THREAT) else 0.0) if word in fixed else (OTHER, 0.0)
                if found[0] in (OTHER, INSULT):
                    weight = stems.get(word + "$")
                    for n in reversed(STEM_LENGTHS):
                        if weight is None and len(word) >= n:
                            weight = stems.get(word[:n])
                    if weight is not None:
                        found = (INSULT, weight)
                found = None if found[0] == OTHER and word not in ".!?;:\n" else found
                if len(self) >= MEMO:
                    self.clear()
                self[word] = found
                return found

        return Memo()


def features(text: str | None, memo: dict, tables) -> list[float]:
    """Best clause weight, sum over clauses (damped), and how often each pattern was written.

    Clauses end at sentence marks and line ends, where the machine starts anew.
    """
    follow, written = tables
    patterns, clauses = [0] * 16, []
    state, weight, quiet = 0, 0.0, 0
    words = TOKEN.findall((text or "").lower())
    if not any(f and f[0] in (INSULT, THREAT) for f in map(memo.__getitem__, set(words))):
        words = []  # no pattern can be written
    for word in words:
        found = memo[word]
        if found is None:
            quiet += 1
            continue
        if quiet and state:
            for _ in range(min(quiet, 8)):
                state = follow[state][OTHER]
        quiet = 0
        if len(word) == 1 and word in ".!?;:\n":
            if weight:
                clauses.append(weight)
            state, weight = 0, 0.0
            continue
        kind, gain = found
        pattern = written[state][kind]
        if pattern >= 0:
            patterns[pattern] += 1
            weight += gain
        state = follow[state][kind]
    if weight:
        clauses.append(weight)
    return [max(clauses, default=0.0), math.log1p(sum(clauses)), *map(math.log1p, patterns)]


def _stem_counts(wanted: Broadcast | None = None):
    """Documents in which each word and word beginning occurs; ``wanted`` limits which are counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        among = wanted and wanted.value
        for batch in batches:
            for text in batch.column("text"):
                words = {w for w in TOKEN.findall((text.as_py() or "").lower()) if len(w) > 2}
                stems = {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n} | {w + "$" for w in words}
                seen.update(stems if among is None else stems & among)
        stems = list(seen)
        for i in range(0, len(stems), 100_000):
            part = stems[i : i + 100_000]
            columns = [pa.array(part, pa.string()), pa.array([seen[s] for s in part], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["stem", "n"])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 25) -> np.ndarray:
    """Weights and constant of a ridge logistic regression, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    pull = np.full(len(w), ridge * len(x) / 100)
    pull[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - pull * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(labelled: DataFrame, text_col: str = "text", toxic_col: str = "toxic", most: int = TRAIN_DOCS) -> ToxicityModel:
    """A model from rows with a label 0 or 1; other rows are not used.

    ``most`` bounds the sample: with more labelled rows, about that many are drawn by the hash
    of the text. Stems are counted on Spark, and the driver gets at most ``STEMS`` of them and the
    features of the sample. With labels of one class or none, the given word lists and weights are used.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(toxic_col).cast("int").alias("toxic")).where("toxic in (0, 1)")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = ToxicityModel()
    if len(sizes) < 2:
        return model
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = cut(rows.where(draw < most / sum(sizes.values())), "labelled")
    shape = "stem string, n long"

    def counted(label: int, wanted: Broadcast | None = None) -> DataFrame:
        stems = rows.where(F.col("toxic") == label).mapInArrow(tidy(_stem_counts(wanted)), shape)
        return stems.groupBy("stem").agg(F.sum("n").alias("n"))

    usual = counted(1).where(F.col("n") >= MIN_TOXIC).orderBy(F.desc("n"), "stem").limit(CANDIDATES)
    toxic = {r["stem"]: r["n"] for r in usual.collect()}
    wanted = rows.sparkSession.sparkContext.broadcast(set(toxic))
    clean = {r["stem"]: r["n"] for r in counted(0, wanted).collect()}
    drawn = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    gains = {
        s: math.log((n + 0.5) / (drawn.get(1, 0) + 1)) - math.log((clean.get(s, 0) + 0.5) / (drawn.get(0, 0) + 1))
        for s, n in toxic.items()
    }
    best = sorted((-g, s) for s, g in gains.items() if g >= MIN_WEIGHT)[:STEMS]
    model.stems = {s: -g for g, s in best}
    found = _with_features(rows, model, "text", ["toxic"]).toArrow()
    x, y = np.array(found["__llm_features"].to_pylist(), dtype=float), found["toxic"].to_numpy().astype(float)
    if len(set(y)) == 2:
        order = np.lexsort((*x.T, y))  # the order of rows must not touch the sums
        model.scale = fit_logistic(x[order], y[order]).tolist()
    return model


def _with_features(docs: DataFrame, model: ToxicityModel, text_col: str, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of ``docs`` and the features of its texts."""
    shared = ship(docs.sparkSession, model)
    schema = added(docs.select(*[f"`{c}`" for c in kept]).schema, __llm_features="array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, tables = received(shared).reader(), grammar()
        for batch in slices(batches):
            rows = [features(t.as_py(), memo, tables) for t in batch.column(text_col)]
            columns = [batch.column(c) for c in kept] + [pa.array(rows, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "__llm_features"])

    return docs.mapInArrow(tidy(run), schema)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` between 0 and 1; a column of that name is replaced.

    Null and empty texts have no clause and get the score of none, the model's constant. Whole texts are
    read; repeated rows get the same score; an empty table gives an empty one.
    """
    docs = replace(docs, ["score", "__llm_features"])
    rows = _with_features(docs, model, text_col, docs.columns)
    total = F.lit(float(model.scale[-1]))
    for n, weight in enumerate(model.scale[:-1]):
        total = total + F.lit(float(weight)) * F.element_at("__llm_features", n + 1)
    return rows.withColumn("score", 1 / (1 + F.exp(-total))).drop("__llm_features")
