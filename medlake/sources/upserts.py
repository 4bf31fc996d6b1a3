"""Tables of keyed rows that are updated in place, bucket by bucket.

A table is a folder. Rows lie in ``base`` by a hash of their key, in a fixed number of buckets; changes that are
not merged yet lie in ``deltas/batch=N/bucket=B``. A manifest, one row per bucket, names the
folder that holds the bucket and the last batch merged into it. An update writes new folders for the buckets that
change and then a new manifest, whose number makes it the current one: readers see the old state or the new one, all
other buckets keep their files, and a lost executor or driver leaves nothing behind but files that no manifest names.
One writer at a time: of two, the second fails to write its manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlake.operators.vector_index import latest
from medlake.plans.bounded import broadcast_if_small
from medlake.plans.durable import cut

BUCKETS = 64
#: Manifests and bucket lists are small: buckets of a table never outgrow this.
MAX_BUCKETS = 16_384
MANIFEST = "bucket int, folder string, rows long, through long, buckets int, key string, version string"


def _children(spark: SparkSession, path: str) -> list[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _number(name: str) -> int:
    return int(name.split("=")[1])


@dataclass
class UpsertTable:
    """The table at ``path``, as of manifest ``number``."""

    spark: SparkSession
    path: str
    number: int
    #: bucket -> (folder or None, rows, last batch merged)
    buckets: dict[int, tuple[str | None, int, int]]
    key: str
    version: str

    # --- reading ---

    def _bucket(self) -> Column:
        return bucket_of(self.key, len(self.buckets))

    def _schema(self):
        return self.spark.read.parquet(f"{self.path}/schema").schema

    def base(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Merged rows of some buckets, with ``bucket``; files of no other bucket are opened."""
        wanted = range(len(self.buckets)) if buckets is None else buckets
        folders = [f"{self.path}/base/{f}/bucket={b}" for b in wanted if (f := self.buckets[b][0])]
        schema = self._schema()
        if not folders:
            return self.spark.createDataFrame([], schema).withColumn("bucket", F.lit(0))
        return self.spark.read.schema(schema).parquet(*folders).withColumn("bucket", self._bucket())

    def _batches(self) -> list[int]:
        """Batches written to their end that some bucket has not merged, in order."""
        names = (x for x in _children(self.spark, f"{self.path}/deltas") if x.startswith("batch="))
        newer = sorted(n for n in map(_number, names) if n > min(t for _, _, t in self.buckets.values()))
        return [n for n in newer if "_SUCCESS" in _children(self.spark, f"{self.path}/deltas/batch={n}")]

    def pending(self) -> dict[int, int]:
        """Buckets with changes that are not merged yet, and the last batch that has some for each."""
        newer: dict[int, int] = {}
        for batch in self._batches():
            for name in _children(self.spark, f"{self.path}/deltas/batch={batch}"):
                if name.startswith("bucket=") and batch > self.buckets[_number(name)][2]:
                    newer[_number(name)] = max(batch, newer.get(_number(name), -1))
        return newer

    def _deltas(self, buckets: Sequence[int]) -> DataFrame:
        """Changes of these buckets that came after their last merge, with ``bucket`` and ``batch``."""
        root = f"{self.path}/deltas"
        batches, wanted = self._batches(), set(buckets)
        folders = [
            f"{root}/batch={n}/{name}"
            for n in batches
            for name in _children(self.spark, f"{root}/batch={n}")
            if name.startswith("bucket=") and _number(name) in wanted and n > self.buckets[_number(name)][2]
        ]
        found = self.spark.read.schema(self._schema()).option("basePath", root).parquet(*folders)
        return found.withColumn("batch", F.col("batch").cast("long"))

    def _merged(self, buckets: Sequence[int]) -> DataFrame:
        """The highest version of each key in these buckets, of equal ones the later batch's."""
        old = self.base(buckets).withColumn("batch", F.lit(-1).cast("long"))
        rows = old.unionByName(self._deltas(buckets)).drop("bucket")
        return latest(rows, self.key, self.version, ["batch"]).drop("batch")

    def read(self) -> DataFrame:
        """Current rows. Only buckets with changes that are not merged yet are merged; the others are read as they lie."""
        busy = sorted(self.pending())
        quiet = self.base([b for b in self.buckets if b not in set(busy)]).drop("bucket")
        return quiet.unionByName(self._merged(busy)) if busy else quiet

    # --- writing ---

    def upsert(self, changes: DataFrame) -> UpsertTable:
        """The table after ``changes``: of each key the highest version (null the lowest), the change among equal ones.

        Ids and versions are compared first; only buckets with a change that wins are written anew, and of
        them the rows that stay are not shuffled. Changes not merged yet are merged before.
        """
        table = self.compact() if self.pending() else self
        new = cut(latest(changes.select(*table._schema().names), table.key, table.version).withColumn("bucket", table._bucket()), "changes")
        asked = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
        if not asked:
            return table
        held = table.base(asked).select(F.col(table.key).alias("__key"), F.col(table.version).alias("__version"), F.lit(True).alias("__held"))
        wins = F.col("__held").isNull() | F.col("__version").isNull() | F.coalesce(F.col(table.version) >= F.col("__version"), F.lit(False))
        same = F.col(table.key).eqNullSafe(F.col("__key"))
        ids = new.select(table.key, table.version, "bucket").join(held, same, "left").where(wins)
        ids = cut(ids.select(F.col(table.key).alias("__key"), F.col("bucket").alias("__bucket")), "winners")
        touched = sorted(r["__bucket"] for r in ids.select("__bucket").distinct().collect())
        if not touched:
            return table
        names = broadcast_if_small(ids.select("__key"), "__key")
        folder = uuid.uuid4().hex
        table.base(touched).join(names, same, "left_anti").write.partitionBy("bucket").parquet(f"{table.path}/base/{folder}")
        better = new.join(names, same, "left_semi").repartition("bucket")
        better.write.mode("append").partitionBy("bucket").parquet(f"{table.path}/base/{folder}")
        return table._switched(touched, folder, {})

    def append(self, batch: DataFrame, number: int) -> None:
        """Keep a batch of changes for later merges, under its own number; a repeated number replaces its batch."""
        rows = latest(batch.select(*self._schema().names), self.key, self.version).withColumn("bucket", self._bucket())
        target = f"{self.path}/deltas/batch={number}"
        writer = rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("bucket").parquet(target)

    def compact(self, buckets: Sequence[int] | None = None) -> UpsertTable:
        """Merge the changes of these buckets (all that have some) into new base files; others keep theirs."""
        batches, pending = self._batches(), self.pending()
        chosen = sorted(b for b in pending if buckets is None or b in set(buckets))
        if not chosen:
            return self
        folder = uuid.uuid4().hex
        merged = self._merged(chosen).withColumn("bucket", self._bucket())
        merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/base/{folder}")
        through = {b: pending[b] for b in chosen} if buckets is not None else dict.fromkeys(self.buckets, batches[-1])
        return self._switched(chosen, folder, through)

    def _switched(self, touched: Sequence[int], folder: str, through: dict[int, int]) -> UpsertTable:
        """A new manifest in which ``touched`` buckets lie in ``folder``."""
        written = self.spark.read.schema(T.StructType([*self._schema().fields, T.StructField("bucket", T.IntegerType())]))
        rows = written.parquet(f"{self.path}/base/{folder}").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        sizes = {r["bucket"]: r["n"] for r in rows.collect()}
        buckets = {b: (f, n, through.get(b, t)) for b, (f, n, t) in self.buckets.items()}
        for b in touched:
            buckets[b] = (folder if b in sizes else None, sizes.get(b, 0), buckets[b][2])
        return _commit(self.spark, self.path, self.number + 1, buckets, self.key, self.version)

    def vacuum(self) -> None:
        """Delete files that the current manifest does not name, and batches merged everywhere. No reader may use an older one."""
        named = {f for f, _, _ in self.buckets.values()}
        merged = min(t for _, _, t in self.buckets.values())
        for name in _children(self.spark, f"{self.path}/base"):
            if name not in named:
                _delete(self.spark, f"{self.path}/base/{name}")
        for name in _children(self.spark, f"{self.path}/deltas"):
            if name.startswith("batch=") and _number(name) <= merged:
                _delete(self.spark, f"{self.path}/deltas/{name}")
        for name in _children(self.spark, f"{self.path}/manifest"):
            if _number(name) < self.number:
                _delete(self.spark, f"{self.path}/manifest/{name}")


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a key; a null key has one as well."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _commit(spark: SparkSession, path: str, number: int, buckets: dict, key: str, version: str) -> UpsertTable:
    rows = [(b, *entry, len(buckets), key, version) for b, entry in sorted(buckets.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{path}/manifest/number={number}")
    return UpsertTable(spark, path, number, buckets, key, version)


def create_table(
    rows: DataFrame, path: str, key: str = "id", version: str = "version", buckets: int = BUCKETS
) -> UpsertTable:
    """A new table of ``rows``, of which the highest version of each key is kept. Fails if there is one at ``path``.

    A bucket is written by one task: let ``buckets`` be such that its rows fit one. Columns named ``bucket``
    or ``batch`` are refused, as folders carry these names.
    """
    clash = {c.lower() for c in rows.columns} & {"bucket", "batch"}
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MAX_BUCKETS}")
    spark = rows.sparkSession
    rows.limit(0).write.mode("error").parquet(f"{path}/schema")
    folder = uuid.uuid4().hex
    first = latest(rows, key, version).withColumn("bucket", bucket_of(key, buckets))
    first.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/base/{folder}")
    empty = UpsertTable(spark, path, -1, {b: (None, 0, -1) for b in range(buckets)}, key, version)
    return empty._switched(range(buckets), folder, {})


def open_table(spark: SparkSession, path: str) -> UpsertTable:
    """The current state of a table: the highest manifest that was written to its end."""
    for name in sorted(_children(spark, f"{path}/manifest"), key=_number, reverse=True):
        if "_SUCCESS" in _children(spark, f"{path}/manifest/{name}"):
            rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/{name}").collect()
            buckets = {r["bucket"]: (r["folder"], r["rows"], r["through"]) for r in rows}
            return UpsertTable(spark, path, _number(name), buckets, rows[0]["key"], rows[0]["version"])
    raise FileNotFoundError(f"no table at {path}")
