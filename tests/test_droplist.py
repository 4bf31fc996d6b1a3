"""Copies left out by the scan: results, plans without an exchange, groups of files, repeated rows."""

import pytest
from pyspark.sql import functions as F

from medlake.operators import registry
from medlake.plans import droplist


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """3,000 rows in several files: a text in a third of them, others twice, and every tenth row repeated whole."""
    rows = spark.range(3_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 4))).alias("text"),
        F.lit("other").alias("__row"),
    )
    path = str(tmp_path_factory.mktemp("docs") / "docs.parquet")
    rows.unionByName(rows.where("id % 10 = 0")).repartition(7).write.parquet(path)
    return spark.read.parquet(path)


def kept(df):
    return sorted((r["id"], r["text"]) for r in df.collect())


def first_of_each(df):
    found = df.groupBy("text").agg(F.min("id").alias("id")).collect()
    return sorted((r["id"], r["text"]) for r in found)


@pytest.mark.parametrize("most", [droplist.GROUP_DROPS, 150])
def test_copies_are_dropped_by_the_scan(spark, stored, most, monkeypatch):
    monkeypatch.setattr(droplist.keep_first, "__defaults__", (most,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = registry.drop_content_copies(stored, "text", "id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert kept(out) == first_of_each(stored)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Join" not in plan and "might_contain" in plan
    scans = sum("FileScan parquet" in line for line in plan.splitlines())
    assert scans == 1 if most > 3_000 else scans > 3, plan[:3000]
    assert out.columns == stored.columns


def test_other_inputs_give_the_same(stored):
    wanted = first_of_each(stored)
    for df in (stored.unionByName(stored), stored.repartition(3), stored.where("id >= 0").withColumn("more", F.lit(1))):
        assert kept(registry.drop_content_copies(df, "text", "id")) == wanted
    assert registry.drop_content_copies(stored.where("id < 0"), "text", "id").count() == 0
    single = stored.where("id % 4 = 1 and id % 3 = 1 and id % 50 <> 1").dropDuplicates(["text"])
    assert registry.drop_content_copies(single, "text", "id").count() == single.count()


def test_cascade_parts_what_one_filter_would_not(spark, monkeypatch):
    monkeypatch.setattr(droplist, "MISTAKES", 0.4)
    verdicts = spark.range(20_000).select(F.xxhash64("id").alias("h"), (F.col("id") % 3 == 0).alias("drop")).cache()
    filters = droplist._cascade(verdicts)
    assert len(filters) > 3
    out = None
    for level, bits in reversed(list(enumerate(filters))):
        reported = droplist._reported(bits, level, F.col("h"))
        out = reported if out is None else reported & ~out
    assert verdicts.where(out).count() == verdicts.where("drop").count() == verdicts.where(out & F.col("drop")).count()
