"""Byte-level BPE encoding and decoding with overlapping chunks.

Long texts are cut into chunks that overlap, and every chunk is split into pre-tokens on its own. A
split depends only on the text after its start, so once a chunk and its successor have a
boundary in common inside the overlap, they agree from there on: that is where they are stitched.
The stretches between the stitches are encoded in parallel and joined in order. A text in
which some overlap has no common boundary (one pre-token longer than the overlap) is encoded whole.
Decoding joins the raw bytes of the ids.

Ids travel as packed little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medlake.llm.common import added, bounded_hint, cut, slices, text_of, tidy

CHUNK = 32_768
OVERLAP = 1_024
#: A split may look this many characters past its end.
MARGIN = 4
#: Pre-tokens remembered by a task.
REMEMBERED = 80_000
LONG_PIECE = 64


def read_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, content.splitlines()) if t}


def share_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank file (some 50,000 lines, about a megabyte) for every executor."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


class _Packed(dict):
    """Pre-token -> packed ids; the library merges a pre-token when it is first met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        # One pre-token is one match of the pattern, alone as in its text.
        self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, piece: str) -> bytes:
        packed = array("I", self.merge(piece)).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) <= LONG_PIECE:
            self[piece] = packed
        return packed


def latin_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern for texts within U+00FF, for the faster standard module.

    Its property classes become plain sets of the characters below U+0100; None if it has others.
    """
    def members(test) -> str:
        return "".join(f"\\x{c:02x}" for c in range(256) if test(chr(c)))

    letters = members(lambda c: unicodedata.category(c)[0] == "L")
    numbers = members(lambda c: unicodedata.category(c)[0] == "N")
    spaces = members(lambda c: c in "\t\n\v\f\r \x85\xa0")
    out, inside, i = [], False, 0
    while i < len(pattern):
        part = next((p for p in (r"\p{L}", r"\p{N}", r"\s", r"\S") if pattern.startswith(p, i)), pattern[i])
        if part in (r"\p{L}", r"\p{N}", r"\s"):
            members_of = {r"\p{L}": letters, r"\p{N}": numbers, r"\s": spaces}[part]
            out.append(members_of if inside else f"[{members_of}]")
        elif part == r"\S" and not inside:
            out.append(f"[^{spaces}]")
        elif part[0] == "\\":
            return None
        else:
            inside = part == "[" or inside and part != "]"
            out.append(part)
        i += len(part)
    return re.compile("".join(out))


def _splitter(pattern: str):
    """text -> the compiled pattern that splits it fastest."""
    full, latin = regex.compile(pattern), latin_pattern(pattern)

    def of(text: str):
        if latin is None:
            return full
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return full
        return latin

    return of


def _encoder(shared: Broadcast, pattern: str):
    packed, splitter = _Packed(read_ranks(shared.value), pattern), _splitter(pattern)
    return lambda text: b"".join([packed[p] for p in splitter(text).findall(text)])


def _encode_column(shared: Broadcast, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared, pattern)
        for batch in slices(batches):
            ids = pa.array([encode(t.as_py() or "") for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [batch.schema.names[0], "ids"])

    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column("key"), batch.column("text")):
            text = text.as_py()
            starts = range(0, len(text), CHUNK)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([key.as_py()] * len(starts)),
                    "i": pa.array(range(len(starts)), pa.int32()),
                    "chunk": pa.array([text[s : s + CHUNK + OVERLAP] for s in starts]),
                    "last": pa.array([s + CHUNK >= len(text) for s in starts]),
                }
            )


def boundaries(chunk: str, last: bool, split) -> list[int]:
    """Where pre-tokens start in a chunk, as far as the text beyond its end cannot change them."""
    found = [m.start() for m in split.finditer(chunk)]
    return found if last else [b for b in found if b <= len(chunk) - MARGIN]


def _split_chunks(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _splitter(pattern)
        for batch in batches:
            heads, tails = [], []
            for chunk, last in zip(batch.column("chunk"), batch.column("last")):
                found = boundaries(chunk.as_py(), last.as_py(), splitter(chunk.as_py()))
                heads.append([b for b in found if b < OVERLAP])
                tails.append([b - CHUNK for b in found if b >= CHUNK])
            kind = pa.list_(pa.int32())
            columns = [*batch.columns, pa.array(heads, kind), pa.array(tails, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "head", "tail"])

    return run


def _join_ids(table: pa.Table) -> pa.Table:
    table = table.sort_by("i")
    return pa.table({"key": table["key"][:1], "ids": pa.array([b"".join(table["ids"].to_pylist())], pa.binary())})


def _encode_long(texts: DataFrame, shared: Broadcast, pattern: str) -> DataFrame:
    """``(key, text)`` of long texts, copies among them -> ``(key, ids)``, each key once."""
    chunks = texts.mapInArrow(tidy(_chunks), "key string, i int, chunk string, last boolean").dropDuplicates(["key", "i"])
    parts = chunks.mapInArrow(
        tidy(_split_chunks(pattern)), "key string, i int, chunk string, last boolean, head array<int>, tail array<int>"
    )
    parts = cut(parts, "chunks")
    # Only boundaries are brought together by text; the chunks stay where they are.
    order = Window.partitionBy("key").orderBy("i")
    meet = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    stitches = parts.select("key", "i", "last", "head", "tail").withColumn("meet", meet).withColumn("from", F.lag("meet").over(order))
    stitches = cut(stitches.select("key", "i", "last", "meet", "from"), "stitches")
    apart = cut(stitches.where("meet is null and not last").select("key").distinct(), "apart")
    stitches = stitches.drop("last").join(bounded_hint(apart, 128), "key", "left_anti")
    begin = F.when(F.col("i") == 0, F.lit(0)).otherwise(F.col("from"))
    stretch = F.substring("chunk", begin + 1, F.when(F.col("last"), F.length("chunk")).otherwise(CHUNK + F.col("meet")) - begin)
    encode = tidy(_encode_column(shared, pattern))
    pieces = parts.select("key", "i", "chunk", "last").join(bounded_hint(cut(stitches, "stitched"), 128), ["key", "i"])
    stitched = (
        pieces.select(F.struct("key", "i").alias("at"), stretch.alias("text"))
        .mapInArrow(encode, "at struct<key:string,i:int>, ids binary")
        .select("at.key", "at.i", "ids")
        .groupBy("key")
        .applyInArrow(_join_ids, "key string, ids binary")
    )
    unstitched = texts.join(bounded_hint(apart, 128), "key", "left_semi").dropDuplicates(["key"])
    return stitched.unionByName(unstitched.mapInArrow(encode, "key string, ids binary"))


def encode(
    docs: DataFrame, ranks: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` per row of ``docs``; null and empty texts have no ids.

    Texts of up to ``CHUNK`` bytes are encoded where they are read. Longer ones are cut up,
    each distinct text once, and their ids are joined back. Repeated rows and null ids give a row each;
    an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    is_long = F.octet_length("text") > CHUNK
    short = rows.where(~is_long).mapInArrow(tidy(_encode_column(ranks, pattern)), f"doc_id {kind}, ids binary")
    long_rows = rows.where(is_long).withColumn("key", F.sha2("text", 256))
    done = _encode_long(long_rows.select("key", "text"), ranks, pattern)
    joined = long_rows.select("doc_id", "key").join(done, "key").select("doc_id", "ids")
    return short.unionByName(joined).select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def decode(encoded: DataFrame, ranks: Broadcast, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids; null ids give null.

    A column named ``decoded`` is replaced.
    """
    encoded = encoded.drop("decoded")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = read_ranks(ranks.value)
        vocabulary = [b""] * (max(content.values(), default=-1) + 1)
        for token, rank in content.items():
            vocabulary[rank] = token
        del content
        for batch in slices(batches):
            out = [
                None if (v := x.as_py()) is None else b"".join([vocabulary[i] for i in np.frombuffer(v, "<u4").tolist()])
                for x in batch.column(ids_col)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(tidy(run), added(encoded.schema, decoded="binary"))
