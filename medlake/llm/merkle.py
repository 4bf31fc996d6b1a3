"""A Merkle manifest of a dataset, with nested-interval labels.

Every row is a leaf, every source a tree over its leaves, and the trees' roots are the leaves of a last tree. A node is
labelled with the interval of leaf ranks that it covers and with that of its parent, so kinship is arithmetic:

1. Leaves are ranked by id inside their tree, in range-sorted tasks.
2. Trees grow in bands of ``STRIDE`` levels. One shuffle brings the at most ``FAN ** STRIDE`` nodes below a common
   ancestor into one bucket, in which all levels of the band are computed and labelled.
3. From the top band down, a containment join inside buckets attaches to every node the children of
   its ancestors; of a parent's interval, what differs from the ancestor's own interval are the
   siblings. Steps of higher bands come from one row per bucket.

A row's proof is the list of steps up to the root: digests left and right of its ancestor at every level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlake.llm.common import cut
from medlake.llm.ranks import ranked

FAN = 3
STRIDE = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes in front, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _parents(level: str) -> Column:
    """Digests one level up from an array of digests in order."""
    last = F.floor((F.size(level) - 1) / FAN).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(level, i * FAN + 1, F.lit(FAN)), ""), 256)
    )


def _labelled(column: str, level: int) -> Column:
    """An array of a bucket's digests at ``level`` as labelled nodes; empty where the tree ends below."""
    span, total, bucket = FAN**level, F.col("total"), F.col("bucket")

    def label(x: Column, i: Column) -> Column:
        low = bucket + i.cast("long") * span
        parent = low - F.pmod(low, F.lit(FAN * span))
        return F.struct(
            F.lit(level).alias("level"),
            low.alias("low"),
            F.least(low + span, total).alias("high"),
            parent.alias("parent_low"),
            F.least(parent + FAN * span, total).alias("parent_high"),
            x.alias("digest"),
            (F.lit(span) >= total).alias("top"),
        )

    exists = F.lit(True) if level == 0 else F.lit(span // FAN) < total
    return F.when(exists, F.transform(column, label)).otherwise(F.slice(F.transform(column, label), 1, 0))


def grow(leaves: DataFrame) -> list[DataFrame]:
    """Labelled nodes of the trees over ``leaves(tree, total, nth, digest)``, one table per band of levels."""
    tallest = leaves.agg(F.max("total")).first()[0] or 0
    nodes, level, bands = leaves.select("tree", "total", F.col("nth").alias("low"), "digest"), 0, []
    while not bands or FAN**level < tallest:
        bucket = (F.col("low") - F.pmod("low", F.lit(FAN ** (level + STRIDE)))).alias("bucket")
        run = F.sort_array(F.collect_list(F.struct("low", "digest")))
        built = nodes.groupBy("tree", "total", bucket).agg(F.transform(run, lambda x: x["digest"]).alias("up0"))
        for j in range(STRIDE):
            built = built.select("*", _parents(f"up{j}").alias(f"up{j + 1}"))
        parts = [_labelled(f"up{j}", level + j) for j in range(STRIDE + 1)]
        bands.append(cut(built.select("tree", "total", "bucket", F.inline(F.concat(*parts))), f"band{len(bands)}"))
        level += STRIDE
        nodes = bands[-1].where((F.col("level") == level) & ~F.col("top")).select("tree", "total", "low", "digest")
    return bands


def _steps(level: int) -> Column:
    """Of a band's levels from ``level`` up, the digests left and right of the row's ancestor."""

    def step(x: Column) -> Column:
        def side(beside) -> Column:
            near = F.filter("kin", lambda k: (k["level"] == x) & beside(k))
            return F.array_join(F.transform(near, lambda k: k["digest"]), "")

        return F.struct(
            side(lambda k: k["high"] <= F.col("low")).alias("left"), side(lambda k: k["low"] > F.col("low")).alias("right")
        )

    levels = F.array_sort(F.array_distinct(F.transform("kin", lambda k: k["level"])))
    return F.transform(levels, step).cast(STEPS)


def climb(bands: list[DataFrame], leaves: DataFrame, tops: DataFrame) -> DataFrame:
    """``leaves(tree, total, nth, ...)`` with ``steps`` up to the tree's top and on along ``tops(tree, steps, ...)``."""
    above = None
    more = [c for c in tops.columns if c not in ("tree", "steps")]
    for b in reversed(range(len(bands))):
        band, level = bands[b], b * STRIDE
        if b:
            members = band.where(F.col("level") == level).select("tree", "total", "bucket", "low")
        else:
            bucket = F.col("low") - F.pmod("low", F.lit(FAN**STRIDE))
            members = leaves.withColumnRenamed("nth", "low").withColumn("bucket", bucket)
        children = band.where((F.col("level") < level + STRIDE) & ~F.col("top"))
        labels = children.select("tree", "bucket", "parent_low", "parent_high", F.struct("level", F.col("low").alias("low"), "high", "digest").alias("kin"))
        inside = (F.col("low") >= F.col("parent_low")) & (F.col("low") < F.col("parent_high"))
        met = members.alias("m").join(
            labels.alias("c"),
            (F.col("m.tree") == F.col("c.tree")) & (F.col("m.bucket") == F.col("c.bucket")) & inside,
            "left",
        )
        own = [F.col(f"m.`{c}`") for c in members.columns]
        kin = met.groupBy(*own).agg(F.sort_array(F.collect_list("kin")).alias("kin"))
        kin = kin.select(*[f"`{c}`" for c in members.columns], _steps(level).alias("near"))
        finished = band.where("top").select("tree", F.lit(0).cast("long").alias("bucket")).join(tops, "tree")
        onward = finished.select("tree", "bucket", F.col("steps").alias("far"), *more)
        onward = onward if above is None else onward.unionByName(above)
        joined = kin.join(onward, ["tree", "bucket"]).withColumn("steps", F.concat("near", "far")).drop("near", "far")
        if b:
            far = joined.select("tree", F.col("low").alias("bucket"), F.col("steps").alias("far"), *more)
            above = cut(far, f"steps{b}")
    return joined.drop("bucket").withColumnRenamed("low", "nth")


@dataclass
class Manifest:
    """``rows``: one per row of the dataset, with its proof. ``nodes``: all labelled nodes of the sources' trees."""

    rows: DataFrame
    nodes: DataFrame


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    fields: list[str] | None = None,
    altered: Column | None = None,
) -> Manifest:
    """Leaves, roots and proofs of ``docs``; ``altered`` replaces the text where a proof is to be tried.

    ``rows`` has ``doc_id, source, leaf, subroot, root, steps, proof_sha256, folded_root, verified``. ``folded_root`` folds the
    leaf (of the altered text, where ``altered`` is not null) with the steps; ``verified`` tells whether that is the root. A leaf
    hashes ``fields`` in order, null as ``-``, texts whole. A null source is a source of its own, before all others; null
    ids come first in their source. Repeated rows are leaves of their own, each with its own proof. Columns not among the
    fields are ignored. An empty table gives an empty result.
    """
    names = fields or FIELDS
    told = F.lit(None).cast("string") if altered is None else altered
    tampered = [field(told if c == text_col else F.col(c)) for c in names]
    source = F.col(source_col).cast("string")
    entries = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),
        F.col(id_col).alias("doc_id"),
        digest(*[field(F.col(c)) for c in names]).alias("leaf"),
        F.when(told.isNotNull(), digest(*tampered)).alias("altered_leaf"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = ranked(cut(entries, "leaves"), "tree", ["doc_id", "leaf", "row"]).drop("row")
    bands = grow(leaves.withColumnRenamed("leaf", "digest"))
    nodes = bands[0]
    for band, level in zip(bands[1:], range(STRIDE, STRIDE * len(bands), STRIDE)):
        nodes = nodes.unionByName(band.where(F.col("level") > level))
    subroots = cut(nodes.where("top").select("tree", F.col("digest").alias("subroot")), "subroots")

    sources = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "subroot"), "tree", ["source_tree"])
    crown = grow(sources.withColumnRenamed("subroot", "digest"))
    root = crown[-1].where("top").select("tree", F.col("digest").alias("root"), F.array().cast(STEPS).alias("steps"))
    proven = climb(crown, sources, cut(root, "root"))
    tops = cut(proven.select(F.col("source_tree").alias("tree"), "steps", "subroot", "root"), "tops")

    rows = climb(bands, leaves, tops)
    fold = F.aggregate(
        "steps", F.coalesce("altered_leaf", "leaf"), lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256)
    )
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    rows = rows.select(
        "doc_id",
        F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source"),
        "leaf",
        "subroot",
        "root",
        "steps",
        F.sha2(siblings, 256).alias("proof_sha256"),
        fold.alias("folded_root"),
    )
    return Manifest(rows.withColumn("verified", F.col("folded_root") == F.col("root")), nodes)
