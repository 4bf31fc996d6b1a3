"""Bucketed tables: what an update rewrites, what a merged read opens, and odd keys and versions."""

import os

import pytest
from pyspark.sql import functions as F

from medlake.operators.vector_index import latest, upsert_latest
from medlake.sources.upserts import bucket_of, create_table, open_table

SCHEMA = "id long, version long, body string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.select("id", "version", "body").collect()), key=str)


def files(path):
    found = {}
    for folder, _, names in os.walk(f"{path}/base"):
        for name in names:
            if name.endswith(".parquet"):
                bucket = int(os.path.basename(folder).split("=")[1])
                found.setdefault(bucket, set()).add(f"{folder}/{name}")
    return found


def opened(df):
    return {p.split("file:")[-1].replace("//", "") for p in df.inputFiles()}


ROWS = [(i, i % 3, f"old {i}") for i in range(200)] + [(None, 1, "null id"), (500, None, "null version"), (7, 9, "newer"), (8, 2, "a"), (8, 2, "a")]


def test_an_update_rewrites_only_the_buckets_that_it_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    table = create_table(frame(spark, ROWS), path, buckets=16)
    assert rows_of(table.read()) == rows_of(latest(frame(spark, ROWS)))
    before = files(path)
    # A tie wins, an older version loses, nulls are the lowest; one new id.
    changes = frame(spark, [(5, 2, "tie"), (9, -1, "older"), (10, None, "lost"), (None, 1, "null again"), (500, None, "tie of nulls"), (900, 0, "new")])
    after = table.upsert(changes)
    assert rows_of(after.read()) == rows_of(upsert_latest(latest(frame(spark, ROWS)), changes))
    touched = {r["b"] for r in changes.where("body not in ('older', 'lost')").select(bucket_of("id", 16).alias("b")).collect()}
    named = {b: f for b, (f, _, _) in after.buckets.items()}
    for bucket, (folder, n, _) in table.buckets.items():
        assert (named[bucket] == folder) == (bucket not in touched)
    assert sum(n for _, n, _ in after.buckets.values()) == after.read().count() == open_table(spark, path).read().count()
    # The old files are still there for readers of the old state, until they are vacuumed.
    assert all(before[b] <= files(path)[b] for b in before) and rows_of(table.read()) == rows_of(latest(frame(spark, ROWS)))
    after.vacuum()
    assert {b: f for b, f in files(path).items() if b not in touched} == {b: f for b, f in before.items() if b not in touched}
    assert rows_of(open_table(spark, path).read()) == rows_of(after.read())


def test_losing_changes_write_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    table = create_table(frame(spark, ROWS), path, buckets=8)
    before = files(path)
    same = table.upsert(frame(spark, [(9, -1, "older"), (11, None, "lost")]))
    assert same.number == table.number and files(path) == before
    assert table.upsert(frame(spark, [])).number == table.number


def test_a_read_merges_only_buckets_with_newer_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    table = create_table(frame(spark, [(i, 0, "base") for i in range(300)]), path, buckets=16)
    table.append(frame(spark, [(3, 1, "first"), (4, 0, "tie")]), 0)
    table.append(frame(spark, [(3, 1, "later tie"), (301, 0, "new"), (5, -1, "older")]), 1)
    want = {3: "later tie", 4: "tie", 301: "new", 5: "base"}

    def bodies(t):
        return {r["id"]: r["body"] for r in t.read().collect() if r["id"] in want}

    assert bodies(table) == want and table.read().count() == 301
    done = table.compact()
    assert done.pending() == {} and bodies(done) == want
    plan = done.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    untouched = [b for b in table.buckets if done.buckets[b][0] == table.buckets[b][0]]
    assert len(untouched) >= 10
    done.append(frame(spark, [(3, 2, "last")]), 2)
    busy = list(done.pending())
    assert busy == [r["b"] for r in frame(spark, [(3, 0, "")]).select(bucket_of("id", 16).alias("b")).collect()]
    assert bodies(done) == want | {3: "last"}
    # Only that bucket's files and its new changes stand below the merge.
    merged = opened(done._merged(busy))
    assert all(f"bucket={busy[0]}/" in f for f in merged) and not any("batch=0" in f or "batch=1" in f for f in merged)
    done.vacuum()
    assert sorted(os.listdir(f"{path}/deltas")) == ["batch=2"] and bodies(done) == want | {3: "last"}


def test_repeated_and_broken_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    table = create_table(frame(spark, [(1, 0, "base")]), path, buckets=4)
    for _ in range(2):  # a retried batch
        table.append(frame(spark, [(1, 1, "one"), (2, 0, "two")]), 0)
    table.append(frame(spark, [(1, 5, "unfinished")]), 1)
    os.remove(f"{path}/deltas/batch=1/_SUCCESS")
    assert rows_of(table.read()) == [(1, 1, "one"), (2, 0, "two")]
    # A manifest that was not written to its end is not seen.
    os.makedirs(f"{path}/manifest/number=7")
    assert open_table(spark, path).number == table.number
    partly = table.compact(buckets=list(table.pending())[:1])
    assert rows_of(partly.read()) == rows_of(table.read()) and len(partly.pending()) == len(table.pending()) - 1
    assert rows_of(partly.upsert(frame(spark, [(3, 0, "three")])).read()) == [(1, 1, "one"), (2, 0, "two"), (3, 0, "three")]


def test_refusals(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="reserved"):
        create_table(frame(spark, []).withColumn("Bucket", F.lit(1)), path)
    with pytest.raises(FileNotFoundError):
        open_table(spark, path)
    empty = create_table(frame(spark, []), path, buckets=2)
    assert empty.read().count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        create_table(frame(spark, []), path)
    # Of two writers that start from one state, the second fails.
    empty.upsert(frame(spark, [(1, 1, "a")]))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        empty.upsert(frame(spark, [(2, 1, "b")]))
