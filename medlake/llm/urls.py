"""URL filters: a trie over reversed host labels and path segments, longest rule first.

The rules of bounded size are built into one trie that every task holds; each URL walks it once. Rule tables
beyond the bound are joined on the same host suffixes and path beginnings instead.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlake.llm.common import added, ascii_lower, received, replace, ship, spare
from medlake.plans.bounded import MAX_BROADCAST_BYTES

ALLOW, BLOCK = "allow", "block"
#: What a rule weighs in a trie, about, besides its text.
RULE_BYTES = 512
#: Hosts are compared with A-Z lower-cased and every other character as it is.
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

Rule = tuple[str, str, str]


@dataclass
class Node:
    """A place in the trie: after some host labels, or after some path segments of such a host."""

    labels: dict[str, Node] = field(default_factory=dict)
    segments: dict[str, Node] = field(default_factory=dict)
    #: What must follow in the path (the rest of a rule after its last "/") -> (rule, verdict).
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)


def build_trie(rules: Iterable[Rule]) -> Node:
    """``rules`` are (host, path, verdict); of equal host and path the block wins."""
    root = Node()
    for host, path, verdict in rules:
        node = root
        for label in reversed(host.translate(LOWER).split(".") if host else []):
            node = node.labels.setdefault(label, Node())
        *segments, rest = path.split("/")
        for segment in segments:
            node = node.segments.setdefault(segment, Node())
        if node.ends.get(rest, ("", ALLOW))[1] != BLOCK:
            node.ends[rest] = (f"{host}{path}", verdict)
    return root


def match(trie: Node, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits: most host labels first, then the longest path."""
    hosts, node = [trie], trie
    for label in reversed(host.split(".") if host else []):
        node = node.labels.get(label)
        if node is None:
            break
        hosts.append(node)
    segments = path.split("/")
    for node in reversed(hosts):
        best = None
        for n in range(len(segments)):
            fits = [e for e in node.ends if segments[n].startswith(e)]
            if fits:
                best = node.ends[max(fits, key=len)]
            node = node.segments.get(segments[n])
            if node is None:
                break
        if best:
            return best
    return None


def host_and_path(url_col: str) -> tuple:
    """Host in lower case (A-Z) and path of a URL; both empty without ``://`` or for null."""
    host = ascii_lower(F.regexp_extract(url_col, r"(?s)^.*?://([^/?#]*)", 1))
    path = F.regexp_extract(url_col, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules: Iterable[Rule] | DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; columns of these names are replaced.

    ``rules`` are (host, path, verdict), as a list or a table with these columns. A rule fits its host and
    all subdomains where the path begins with the rule's; the rule with most host labels, then the longest
    path, decides; between an allow and a block rule alike in both, the block. URLs that no rule fits get
    ``default`` and a null rule, also those that are null, empty or without ``://``.
    """
    host, path = host_and_path(url_col)
    held = {spare(pages, "__llm_host"): ("host", host), spare(pages, "__llm_path"): ("path", path)}
    rows = replace(pages.withColumns({k: v for k, (_, v) in held.items()}), ["host", "path", "rule", "verdict"])
    rows = rows.withColumnsRenamed({k: name for k, (name, _) in held.items()})
    if isinstance(rules, DataFrame):
        size = F.octet_length("host") + F.octet_length("path") + RULE_BYTES
        if (rules.agg(F.sum(size)).first()[0] or 0) > MAX_BROADCAST_BYTES:
            return _joined(rows, rules, default)
        rules = [(r["host"], r["path"], r["verdict"]) for r in rules.select("host", "path", "verdict").collect()]
    shared = ship(pages.sparkSession, build_trie(rules))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = received(shared)
        for batch in batches:
            found = [match(trie, h.as_py(), p.as_py()) for h, p in zip(batch.column("host"), batch.column("path"))]
            columns = [pa.array([f and f[0] for f in found], pa.string()), pa.array([f[1] if f else default for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, "rule", "verdict"])

    return rows.mapInArrow(run, added(rows.schema, rule="string", verdict="string"))


def _joined(rows: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same by joins, for rule tables of any size.

    Distinct pairs of host and path are expanded to host suffixes and whole path beginnings; a rule is
    keyed by its host and its path up to the last "/", and its remainder is compared after the join.
    """
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(0), F.size("labels")), lambda n: F.array_join(F.slice("labels", n + 1, F.size("labels")), "."))
    begins = F.transform(
        F.sequence(F.lit(0), F.size("segments") - 1),
        lambda n: F.concat(F.array_join(F.slice("segments", 1, n), "/"), F.when(n > 0, F.lit("/")).otherwise(F.lit(""))),
    )
    places = (
        rows.select("host", "path").distinct().withColumns({"labels": labels, "segments": segments})
        .withColumn("suffix", F.explode(F.array_distinct(suffixes)))
        .withColumn("begin", F.explode(begins))
    )
    keyed = rules.select(
        ascii_lower(F.col("host")).alias("suffix"),
        F.regexp_extract("path", r"(?s)^(.*/)?", 0).alias("begin"),
        F.col("path").alias("wanted"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    depth = F.when(F.col("suffix") == "", 0).otherwise(F.size(F.split("suffix", r"\.")))
    order = [F.desc(depth), F.desc(F.length("wanted")), F.desc(F.col("verdict") == BLOCK), "rule"]
    best = (
        places.join(keyed, ["suffix", "begin"])
        .where(F.col("path").startswith(F.col("wanted")))
        .withColumn("nth", F.row_number().over(Window.partitionBy("host", "path").orderBy(*order)))
        .where("nth = 1")
        .select("host", "path", "rule", "verdict")
    )
    names = [f"`{c}`" for c in rows.columns]
    return rows.join(best, ["host", "path"], "left").select(*names, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
