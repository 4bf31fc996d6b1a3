"""Near duplicates: SimHash fingerprints found through an index of positional bytes.

Fingerprints of 64 bits at ``MAX_BITS`` = 4 or fewer differing bits agree in at least 4 of their
8 bytes, as each differing bit spoils one byte at most. The index therefore posts each distinct
fingerprint under positional bytes; within a posting list the shared positional bytes of a pair are
tallied, pairs with the guaranteed four are kept, and their differing bits are counted.

A list of one positional byte would hold 1/256 of all fingerprints. A posting names three
positions at once, from 20 triples chosen so that any four positions contain one of them:
every pair with four agreeing bytes still meets, in lists 65,536 times shorter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlake.llm.common import bounded_hint, cut, keep_one, row_key, slices, tidy
from medlake.llm.components import components

WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints compared in one go; longer posting lists are cut into blocks of this size.
BLOCK = 4096
STEP = 1 << 15


def position_triples() -> list[tuple[int, int, int]]:
    """20 triples of the positions 0-7 such that any four positions contain one.

    Positions form the cycle of groups {0,1,2} {3,4,5} {6,7}: all triples inside a group, and all
    with two positions in a group and one in the next. Of four positions either three share a group
    or two do, with another one in the group after or before it.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    chosen = []
    for triple in combinations(range(8), 3):
        count = [sum(group[p] == g for p in triple) for g in range(3)]
        if 3 in count or any(count[g] == 2 and count[(g + 1) % 3] == 1 for g in range(3)):
            chosen.append(triple)
    return chosen


def fingerprint(text: str | None) -> int:
    """SimHash over the shingles of ``WORDS`` words of the text lower-cased in A-Z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends, at = [], -1
    for length in map(len, words):
        at += length + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    hash_of = xxhash.xxh64_intdigest
    hashes = [hash_of(whole[s:e], SEED) for s, e in zip(starts, ends[WORDS - 1 :])] or [hash_of(whole, SEED)]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), STEP):
        block = np.array(hashes[i : i + STEP], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, len(batch))
        kept = [batch.column(c) for c in ("doc_id", "key")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(prints.view(np.int64))], ["doc_id", "key", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, fp)`` per row; a text without words, empty or null has fingerprint zero."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        row_key(id_col, text_col).alias("key"),
        F.col(text_col).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(_fingerprints), f"doc_id {kind}, key binary, fp long")


def _postings(prints: DataFrame) -> DataFrame:
    """``(list, fp)``: one row per distinct fingerprint and triple of positional bytes."""
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    lists = [
        F.lit(n << 24) + byte[a] * 65536 + byte[b] * 256 + byte[c]
        for n, (a, b, c) in enumerate(position_triples())
    ]
    return prints.select("fp", F.explode(F.array(*lists)).alias("list"))


def _work_units(postings: DataFrame) -> DataFrame:
    """``(list, i, j, fp)``: lists over ``BLOCK`` are cut into blocks, each pair of blocks a unit."""
    long_lists = postings.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    long_lists = cut(long_lists.select("list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "long")
    dealt = postings.join(bounded_hint(long_lists, 32), "list", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = dealt.select("list", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks"), F.coalesce(own, F.lit(0)).alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("list", "fp", "own", other).select(
        "list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )


def _agree(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which of ``many`` reach the guaranteed tally of shared positional bytes, and the bit limit."""
    differ = one ^ many
    tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    near = tally >= 8 - MAX_BITS
    near[near] = np.bitwise_count(differ[near]) <= MAX_BITS
    return near


def _forest(prints: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links of one posting list that connect what is linked: (root, member).

    Walks outward from one fingerprint at a time and compares it with those not yet
    reached only, so that a dense group of n costs about n comparisons, not n * n.
    """
    rest = prints
    while len(rest) > 1:
        root, rest, frontier = rest[0], rest[1:], [rest[0]]
        while frontier and len(rest):
            near = _agree(frontier.pop(), rest)
            if near.any():
                found, rest = rest[near], rest[~near]
                frontier.extend(found)
                yield from ((int(root), int(f)) for f in found)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit -> links, with the unit that a batch ends in carried over."""
    held: list[np.ndarray] = []
    held_unit = None

    def out(pairs):
        pairs = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        pairs.sort(axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    for batch in batches:
        if not len(batch):
            continue
        unit = np.stack([batch.column(c).to_numpy() for c in ("list", "i", "j")], axis=1).astype(np.int64)
        prints = batch.column("fp").to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(unit)]
        pairs: list[tuple[int, int]] = []
        first = 0
        if held_unit == tuple(unit[0]):
            held.append(prints[: ends[0]])
            first = 1
        if held and (first < len(starts) or not first):
            pairs += _forest(np.concatenate(held))
            held = []
        if first < len(starts):
            inner_starts, inner_ends = starts[first:-1], ends[first:-1]
            size = inner_ends - inner_starts
            two = inner_starts[size == 2]
            ok = _agree(prints[two], prints[two + 1]) if len(two) else np.zeros(0, bool)
            pairs += zip(prints[two[ok]].tolist(), prints[two[ok] + 1].tolist())
            for s, e in zip(inner_starts[size > 2], inner_ends[size > 2]):
                pairs += _forest(prints[s:e])
            held, held_unit = [prints[starts[-1] :]], tuple(unit[-1])
        if pairs:
            yield out(pairs)
    if held and (last := list(_forest(np.concatenate(held)))):
        yield out(last)


def links(prints: DataFrame) -> DataFrame:
    """``prints(fp)`` distinct -> ``(u, v)``: enough links to connect all that are within ``MAX_BITS``."""
    units = _work_units(_postings(prints)).repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")
    return units.mapInArrow(tidy(_links), "u long, v long").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, fp, component_id)`` per row of ``docs``; the component's smallest id names it.

    Rows with null ids take part; a component of null ids only has a null id. Repeated rows and
    equal fingerprints share a component; texts without words share fingerprint zero, which is
    linked like any other. An empty table gives an empty result; other columns are ignored.
    """
    found = cut(fingerprints(docs, id_col, text_col), "prints")
    nodes = cut(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = cut(components(links(nodes.select("fp"))).withColumnRenamed("node", "fp"), "roots")
    joined = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(joined.select("fp", "root").join(least, "root"), "named")
    return found.join(named, "fp").select("doc_id", "key", "fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id, and of repeated ids the smallest key."""
    found = cut(near_groups(docs, id_col, text_col), "near")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    stays = found.groupBy("root").agg(F.min(rank).alias("stays")).select(F.col("stays.key").alias("key"), F.lit(True).alias("keep"))
    rows = found.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    verdicts = rows.join(stays, "key", "left").withColumn("keep", F.coalesce("keep", F.lit(False)))
    return keep_one(docs, verdicts, id_col, text_col)
