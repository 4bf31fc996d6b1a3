"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is to be taken target / source size times on average. The whole part is
certain; the fractional part is an inclusion probability. The flight phase moves these
probabilities three units at a time along the null space of the two balancing equations (words and
documents), so that both totals stay what they are while at least one unit per step settles at 0 or 1.
It runs in buckets of about ``BUCKET`` units of one source; the two or fewer units that each leaves open
go on to the next level, until one bucket per source is left. Its last open units, with a
few others, are the landing problem: the rounding nearest to the balanced totals.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlake.llm.common import WORD, bounded_hint, cut, spare, text_of

WEIGHTS = (5.0, 2.0, 1.0)
MAX_TIMES = 3
BUCKET = 512
EPSILON = 1e-9
#: Units settled together at the end of a source: 2**14 roundings are compared.
LANDING = 14


def word_count(text_col: str):
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MAX_TIMES) -> DataFrame:
    """``sizes(skey, source_size)`` -> with ``target``: shares by weight, at most ``most`` times the size.

    Sources are ranked by code point (null last) to get their weight; there is one row per source.
    What a source cannot take is shared again by weight until none is above its limit.
    """
    rank = F.row_number().over(Window.orderBy("skey")) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = cut(
        sizes.withColumn("weight", F.element_at(cycle, (rank % len(weights) + 1).cast("int"))), "sources"
    )
    limit = F.col("source_size") * F.lit(float(most))
    total = float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level, full = 0.0, -1
    while True:
        # Sources at their limit under the present level are fixed there; the rest share what is left.
        over = F.col("weight") * F.lit(level) > limit
        row = ranked.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("free"),
            F.count(F.when(over, 1)).alias("full"),
        ).first()
        if row["full"] == full or not row["free"]:
            break
        full, level = row["full"], max(0.0, total - row["fixed"]) / row["free"]
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), limit))


def flight(units: Sequence[tuple[float, float]], chances: list[float], seed: int) -> list[float]:
    """Flight phase of one bucket: ``units`` are (words, documents); at most two chances stay open.

    One step takes three open units. The two balancing rows over them have a null vector, the cross
    product; moving along it to either border keeps both totals, and the side is drawn so that each
    unit's expected chance stays the same.
    """
    draw = random.Random(seed)
    chances = list(chances)
    open_units: list[int] = []
    waiting = iter([i for i, p in enumerate(chances) if EPSILON < p < 1 - EPSILON])
    while True:
        while len(open_units) < 3 and (nxt := next(waiting, None)) is not None:
            open_units.append(nxt)
        if len(open_units) < 3:
            return chances
        (a1, b1), (a2, b2), (a3, b3) = (units[i] for i in open_units)
        move = (a2 * b3 - a3 * b2, a3 * b1 - a1 * b3, a1 * b2 - a2 * b1)
        size = max(map(abs, move))
        if size <= EPSILON * max(1.0, abs(a1), abs(a2), abs(a3)):
            # Proportional rows: two units are enough, and their own null vector keeps both totals.
            move = (b2, -b1, 0.0) if b1 or b2 else (a2, -a1, 0.0) if a1 or a2 else (1.0, 0.0, 0.0)
        else:
            move = tuple(m / size for m in move)
        now = [chances[i] for i in open_units]
        up = min((1 - p) / m if m > 0 else p / -m for p, m in zip(now, move) if abs(m) > 1e-12)
        down = min(p / m if m > 0 else (1 - p) / -m for p, m in zip(now, move) if abs(m) > 1e-12)
        way = up if draw.random() * (up + down) < down else -down
        for i, p, m in zip(open_units, now, move):
            p += way * m
            chances[i] = 0.0 if p < EPSILON else 1.0 if p > 1 - EPSILON else p
        open_units = [i for i in open_units if 0 < chances[i] < 1]


def landing(units: Sequence[tuple[float, float]], chances: list[float], before: Sequence[float]) -> list[float]:
    """Settle the last bucket: the rounding whose word total, then document total, is nearest ``before``.

    The open units are few, but one may be long. ``LANDING`` units are therefore settled together:
    the open ones, and of the others some of all lengths.
    """
    order = sorted(range(len(units)), key=lambda i: (units[i][0], i))
    still = [i for i, p in enumerate(chances) if 0 < p < 1]
    if not still:
        return list(chances)
    rest = [i for i in order if not 0 < chances[i] < 1]
    spread = max(1, len(rest) // max(1, LANDING - len(still)))
    chosen = still + rest[::spread][: LANDING - len(still)]
    words, documents = np.array([units[i] for i in chosen], dtype=float).T
    fixed = [i for i in range(len(units)) if i not in set(chosen)]
    want = [sum(units[i][k] * before[i] for i in range(len(units))) - sum(units[i][k] * chances[i] for i in fixed) for k in (0, 1)]
    ways = (np.arange(1 << len(chosen))[:, None] >> np.arange(len(chosen))) & 1
    off_words, off_documents = np.abs(ways @ words - want[0]), np.abs(ways @ documents - want[1])
    # A document too many or too few is as bad as a thousandth of the words.
    cost = off_words / max(1.0, sum(w for w, _ in units)) + off_documents / 1000
    best = int(np.lexsort((np.arange(len(cost)), np.round(cost, 12)))[0])
    settled = list(chances)
    for n, i in enumerate(chosen):
        settled[i] = float(ways[best, n])
    return settled


def _fly(last: bool):
    """Flight of every bucket of a task's rows, which come in order of source, bucket and unit.

    Buckets follow each other in one stream: as groups of their own, Spark would hold the buffers of all that a task has seen.
    """

    def one(table: pa.Table) -> pa.RecordBatch:
        units = list(zip(table["words"].to_pylist(), table["documents"].to_pylist()))
        seed = table["unit"][0].as_py() ^ len(units)
        before = table["chance"].to_pylist()
        chances = flight(units, before, seed)
        if last:
            chances = landing(units, chances, before)
        table = table.set_column(table.schema.get_field_index("chance"), "chance", pa.array(chances, pa.float64()))
        return table.combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            skey, bucket = batch.column("skey"), batch.column("bucket")
            same = pc.and_(pc.equal(skey[1:], skey[:-1]), pc.equal(bucket[1:], bucket[:-1]))
            starts = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1).tolist(), len(batch)]
            for begin, end in zip(starts, starts[1:]):
                part = batch.slice(begin, end - begin)
                if held and any(held[0].column(c)[0] != part.column(c)[0] for c in ("skey", "bucket")):
                    yield one(pa.Table.from_batches(held))
                    held = []
                held.append(part)
        if held:
            yield one(pa.Table.from_batches(held))

    return run


def _settle(units: DataFrame) -> list[DataFrame]:
    """Flight levels, then landing: tables of ``(skey, unit, chance)`` with chance 0 or 1."""
    schema = "skey string, unit long, words double, documents double, chance double, bucket int"
    settled, level = [], 0
    while True:
        counts = cut(units.groupBy("skey").agg(F.count(F.lit(1)).alias("n")), "counts")
        largest = counts.agg(F.max("n")).first()[0]
        if largest is None:
            return settled
        last = largest <= BUCKET
        dealt = units.join(bounded_hint(counts, 64), "skey").withColumn(
            "bucket", F.pmod(F.xxhash64("unit", F.lit(level)), F.ceil(F.col("n") / BUCKET)).cast("int")
        )
        dealt = dealt.drop("n").repartition("skey", "bucket").sortWithinPartitions("skey", "bucket", "unit")
        flown = dealt.mapInArrow(_fly(last), schema)
        flown = cut(flown.drop("bucket"), "flight")
        is_open = F.col("chance").between(EPSILON, 1 - EPSILON)
        settled.append(flown.where(~is_open).select("skey", "unit", "chance"))
        units, level = flown.where(is_open), level + 1


def _keys(source_col: str, id_col: str, text_col: str):
    shown = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in (source_col, id_col, text_col)]
    return shown[0].alias("skey"), F.xxhash64(*shown).alias("unit")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MAX_TIMES,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Decisions of the mix: one row per row of ``docs``, and one per distinct unit.

    The first table has ``doc_id, size, source_size, target, copies, taken``; the second
    ``skey, unit, copies``, to be joined to the documents. Rows repeated in id, source and text form one
    unit and are taken equally often. Null ids and texts take part (a null text has size 0, which is taken
    0 words); a null source is a source of its own, ranked last. Empty tables give empty results.
    Draws are seeded by the units' hashes: reruns and other partitionings agree.
    """
    rows = cut(
        docs.select(F.col(id_col).alias("doc_id"), *_keys(source_col, id_col, text_col), word_count(text_col).alias("size")),
        "sizes",
    )
    sizes = rows.groupBy("skey").agg(F.sum("size").alias("source_size"))
    sources = cut(targets(sizes, weights, most).select("skey", "source_size", "target"), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + EPSILON)
    units = (
        rows.groupBy("skey", "unit")
        .agg(F.sum("size").cast("double").alias("words"), F.count(F.lit(1)).cast("double").alias("documents"))
        .join(bounded_hint(sources, 64), "skey")
        .withColumn("whole", whole.cast("int"))
        .withColumn("chance", F.greatest(ratio - whole, F.lit(0.0)))
    )
    units = cut(units.select("skey", "unit", "words", "documents", "whole", "chance"), "units")
    drawn = F.col("chance").between(EPSILON, 1 - EPSILON)
    settled = _settle(units.where(drawn).drop("whole"))
    decided = units.where(~drawn).select("skey", "unit", F.col("whole").alias("copies"))
    if settled:
        flown = settled[0]
        for part in settled[1:]:
            flown = flown.unionByName(part)
        flown = units.where(drawn).select("skey", "unit", "whole").join(flown, ["skey", "unit"])
        decided = decided.unionByName(
            flown.select("skey", "unit", (F.col("whole") + F.round("chance").cast("int")).alias("copies"))
        )
    decided = cut(decided, "copies")
    told = rows.join(decided, ["skey", "unit"]).join(bounded_hint(sources, 64), "skey")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return told.select("doc_id", "size", "source_size", "target", "copies", taken), decided


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, its columns unchanged."""
    _, decided = mix(docs, **options)
    names = [options.get(k, d) for k, d in (("source_col", "source"), ("id_col", "doc_id"), ("text_col", "text"))]
    skey, unit = _keys(*names)
    mark, copies = spare(docs, "__llm_unit"), spare(docs, "__llm_copies")
    kept = decided.where("copies > 0").select(F.struct("skey", "unit").alias(mark), F.col("copies").alias(copies))
    joined = docs.withColumn(mark, F.struct(skey, unit)).join(bounded_hint(cut(kept, "taken"), 64), mark)
    copy = spare(docs, "__llm_copy")
    once = F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy)
    return joined.select(*[f"`{c}`" for c in docs.columns], once).drop(copy)
