"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` points of a ring; a row belongs to the first point clockwise of its key's hash. A shard takes
as many rows as its share and no more: rows that find it full continue clockwise to the next
shard with room. With no slack the shares sum up to the number of rows, so counts differ by one at most.

1. One scan leaves a narrow entry per row: id, size, checksum and the hash of its key.
2. Entries find their arc of the ring and are ranked in it, in range-sorted tasks: an arc that holds a hot key
   fills as many tasks as it needs.
3. The driver walks the ring once with the number of rows per arc (shards x virtual nodes, nothing that grows) and cuts arcs
   into segments of one shard each.
4. A row's rank in its arc names its segment, hence its shard and its slot.

All of it is DataFrame operations.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlake.llm.common import cut, replace, text_of
from medlake.llm.ranks import ranked

VNODES = 128
RING = 1 << 32
#: Cells of the table that finds the arc of a position.
CELL_BITS = 20


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """Points as (position, shard), ascending; those of a shard do not depend on how many others there are."""
    points: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            place = int.from_bytes(hashlib.sha256(f"{shard}/{v}".encode()).digest()[:4], "big")
            points.setdefault(place, shard)
    return sorted(points.items())


def shares(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may take: equal parts of all rows, wider by ``slack``."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments ``(arc, first rank, rank after the last, shard, slot of the first)`` of rows that stay together.

    Going round clockwise, an arc's own rows come before those that overflowed into it, oldest first. A second
    round places what is left, since together the shards have room for all.
    """
    room, slots = list(room), [0] * len(room)
    segments, carried = [], []
    for step in range(2 * len(owners)):
        arc = step % len(owners)
        shard = owners[arc]
        own = [(arc, 0, counts[arc])] if step < len(owners) and counts.get(arc) else []
        carried = own + carried
        while carried and room[shard]:
            origin, first, end = carried[0]
            taken = min(end - first, room[shard])
            segments.append((origin, first, first + taken, shard, slots[shard]))
            slots[shard] += taken
            room[shard] -= taken
            carried[0] = (origin, first + taken, end)
            if first + taken == end:
                carried.pop(0)
    return segments


def _arc_cells(points: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """``(cell, lowest, highest, arc)``: the positions of every arc, cut at the borders of cells."""
    ends = [p for p, _ in points]
    spans = [(0 if i == 0 else ends[i - 1] + 1, end, i) for i, end in enumerate(ends)]
    if ends[-1] < RING - 1:
        spans.append((ends[-1] + 1, RING - 1, 0))
    return [
        (cell, max(low, cell << CELL_BITS), min(high, ((cell + 1) << CELL_BITS) - 1), arc)
        for low, high, arc in spans
        for cell in range(low >> CELL_BITS, (high >> CELL_BITS) + 1)
    ]


def place(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    key: Column | None = None,
    slack: float = 0.0,
    vnodes: int = VNODES,
    carry: list[str] | None = None,
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` and the columns ``carry``, one row per row of ``docs``.

    ``key`` is what is hashed onto the ring, the text by default, so that equal texts lie side by side and only an
    overflow parts them. ``size`` is the text's UTF-8 bytes plus 1; a null text counts as empty (size 1, checksum 0). ``slot``
    counts from 0 without gaps in every shard. Repeated rows take a slot each; rows alike in id and text may swap theirs.
    Null ids come first in their arc. Long texts move only if carried. Columns of the names above are replaced;
    an empty table gives an empty result.
    """
    names = ["doc_id", "size", "text_crc32", "shard", "slot"]
    extra = [c for c in carry or [] if c.lower() not in names]
    text = text_of(text_col)
    entries = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text if key is None else key).alias("h"),
        *[f"`{c}`" for c in extra],
    )
    spark, points = docs.sparkSession, ring(shards, vnodes)
    position = F.shiftrightunsigned("h", 32)
    cells = spark.createDataFrame(_arc_cells(points), "cell long, low long, high long, arc int")
    located = entries.withColumn("cell", F.shiftright(position, CELL_BITS)).join(F.broadcast(cells), "cell")
    located = located.where(position.between(F.col("low"), F.col("high"))).drop("cell", "low", "high")
    rows = ranked(cut(located, "entries"), "arc", ["h", "doc_id", "text_crc32"])
    counts = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments = walk(counts, [shard for _, shard in points], shares(sum(counts.values()), shards, slack))
    table = spark.createDataFrame(segments, "arc int, start long, stop long, shard int, base long")
    told = rows.join(F.broadcast(table), "arc").where((F.col("nth") >= F.col("start")) & (F.col("nth") < F.col("stop")))
    slot = F.col("base") + F.col("nth") - F.col("start")
    return told.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"), *[f"`{c}`" for c in extra])


def write_shards(docs: DataFrame, path: str, shards: int = 16, **options) -> None:
    """Write whole rows as Parquet under ``path/shard=N``, in the order of their slots.

    Ranges of slots are written by as many tasks as they need; a repeated write replaces the shards. Options are
    those of ``place``.
    """
    rows = place(replace(docs, ["shard", "slot"]), shards, carry=docs.columns, **options)
    ordered = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(path)
