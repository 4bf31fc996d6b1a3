import pytest
from pyspark.sql import functions as F

from medlake.operators import registry, summaries
from medlake.plans import bounded, durable, skew


def test_skew_safe_join_equals_plain_join(spark):
    left = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50).alias("k"),
    )
    right = spark.createDataFrame([(k, v) for k in range(40) for v in "ab"[: 1 + k % 2]], "k bigint, v string")
    for how in ("left", "inner"):
        want = sorted(map(tuple, left.join(right, "k", how).select("row", "k", "v").fillna("~").fillna(-1).collect()))
        joined = skew.skew_safe_join(left, right, "k", how, spread_by=["row"], rows_per_task=100)
        assert sorted(map(tuple, joined.select("row", "k", "v").fillna("~").fillna(-1).collect())) == want
    hot = {r.k: r["__salts"] for r in skew.hot_keys(left, "k", 100).collect()}
    assert set(hot) == {7} and 10 <= hot[7] <= 12
    with pytest.raises(ValueError):
        skew.skew_safe_join(left, right, "k", "full")


def test_hot_rows_are_dealt_over_salts(spark):
    left = spark.range(1000).select(F.col("id").alias("row"), F.lit(1).cast("bigint").alias("k"))
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, v string")
    joined = skew.skew_safe_join(left, right, "k", spread_by=["row"], rows_per_task=50)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and joined.where("v = 'x'").count() == 1000


def test_fetch_if_small(spark):
    assert bounded.fetch_if_small(spark.range(5), 5).num_rows == 5
    assert bounded.fetch_if_small(spark.range(6), 5) is None
    assert bounded.vector_rows_limit(768) * 768 * 8 <= bounded.MAX_BROADCAST_BYTES


def test_checkpoint_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert durable.shared_folder(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert durable.work_path(spark, "x").startswith(durable.shared_folder(spark))
    cut = durable.cut(spark.range(4).select((F.col("id") * 2).alias("x")))
    assert cut.count() == 4 and "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_patient_view(spark):
    reports = spark.createDataFrame([("p1", i) for i in range(90)] + [("p2", 99)], "patient_id string, report int")
    patients = spark.createDataFrame([("p1", "Ann")], "patient_id string, name string")
    vitals = spark.createDataFrame([("p1", 37.0), ("p2", 38.0)], "patient_id string, temp double")
    rows = registry.patient_view(patients, [reports, vitals]).collect()
    assert len(rows) == 91
    lone = [r for r in rows if r.patient_id == "p2"][0]
    assert (lone.name, lone.temp, lone.report) == (None, 38.0, 99)


def test_duplicates(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, "b", "z"), (4, None, "n"), (5, None, "m")],
                               "id int, k string, v string")
    got = {r.k: (r.id, r.v) for r in registry.drop_copies(df, ["k"], "id").collect()}
    assert got == {"a": (1, "y"), "b": (2, "z"), None: (4, "n")}
    assert sorted(r.id for r in registry.drop_content_copies(df, "k", "id").collect()) == [1, 2, 4]


def test_log(spark, tmp_path):
    answers = spark.createDataFrame(
        [(1, "q", "a", 0.5, ["d1", "d2"], "2024-01-01 10:00:00", 10, "positive"),
         (2, "r", "b", 0.7, ["d1"], "2024-01-02 10:00:00", 30, None)],
        "query_id int, query string, answer string, confidence double, ids array<string>, at string, ms int, fb string",
    ).withColumn("sources", F.transform("ids", lambda i: F.struct(i.alias("id"))))
    log = registry.query_log(answers, F.to_timestamp("at"), F.col("ms"), F.col("fb"))
    registry.write_query_log(log, str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert {str(r.log_date) for r in stored.select("log_date").collect()} == {"2024-01-01", "2024-01-02"}
    day = registry.log_daily(stored.drop("log_date")).orderBy("log_date").first()
    assert (day.queries, day.avg_latency_ms) == (1, 10.0)
    top = registry.log_top_documents(stored, 1).first()
    assert (top.doc_id, top.retrievals) == ("d1", 2)
    assert {r.feedback: r.share for r in registry.log_feedback(stored).collect()} == {"positive": 0.5, "none": 0.5}


def test_registry_and_sql(spark):
    df = spark.createDataFrame([("r1", "en", 3)], "name string, lang string, n int")
    rows = registry.registry_rows(
        df, {"document_id": F.col("name"), "document_type": F.lit("report")}, metadata=["lang", "n"]
    )
    assert rows.columns == registry.REGISTRY_COLUMNS
    registry.register_views({"reg_test": rows})
    row = spark.sql("SELECT metadata, modality FROM reg_test WHERE get_json_object(metadata, '$.lang') = 'en'").first()
    assert row.metadata == '{"lang":"en","n":3}' and row.modality is None


def test_calculators(spark):
    row = spark.range(1).select(
        registry.bmi(F.lit(80.0), F.lit(2.0)).alias("b"), registry.bmi(F.lit(80.0), F.lit(0.0)).alias("z"),
        registry.dose_mg(F.lit(2.5), F.lit(40.0)).alias("d"),
    ).first()
    assert (row.b, row.z, row.d) == (20.0, None, 100.0)


def one_row(spark, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def test_run_report_errors(spark):
    good = one_row(spark, total=2, failed=0)
    bad = one_row(spark, total=5, failed=3)
    unsaved = one_row(spark, table_rows_loaded=0, silver_csv_uploaded=False)
    saved = one_row(spark, table_rows_loaded=0, silver_csv_uploaded=True)
    row = summaries.run_report(bad, good, unsaved).first()
    assert row.errors == ["Image processing: 3 failures", "Vitals processing: Failed to save output"]
    assert not row.overall_success and row.images_summary.total == 5
    assert summaries.run_report(good, good, saved).first().overall_success
    assert summaries.run_report(None, bad, None).first().errors == ["Report processing: 3 failures"]


def test_summaries(spark):
    df = spark.createDataFrame([("a", 30, "M"), ("a", 50, "M"), ("b", 40, "X")], "d string, age int, sex string")
    counts = {r.value: (r.n, round(r.percent, 2)) for r in summaries.value_counts(df, "d").collect()}
    assert counts == {"a": (2, 66.67), "b": (1, 33.33)}
    row = summaries.demographics(df).first()
    assert (row.age_min, row.age_max, row.age_mean, row.n_M, row.n_F) == (30, 50, 40.0, 2, 0)
    stats = {r.d: (r.age_mean, r.age_min, r.age_max) for r in summaries.group_stats(df, "d", ["age"]).collect()}
    assert stats["a"] == (40.0, 30, 50)
    failed = spark.range(30).selectExpr("lpad(id, 2, '0') AS path")
    assert summaries.first_failures(failed).first()[0] == [f"{i:02d}" for i in range(10)]
    rate = spark.range(1).select(summaries.success_rate(F.lit(3), F.lit(2)), summaries.success_rate(F.lit(0), F.lit(0)))
    assert tuple(rate.first()) == (66.67, 0.0)


def test_drop_copies_keeps_rows_with_null_order(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 2, "z"), ("c", 1, "q"), ("c", 1, "p")], "k string, id int, v string")
    got = {r.k: (r.id, r.v) for r in registry.drop_copies(df, ["k"], "id").collect()}
    assert got["a"] == (None, "x") and got["b"] == (2, "z") and got["c"][0] == 1
    again = {r.k: (r.id, r.v) for r in registry.drop_copies(df.orderBy("v").repartition(3), ["k"], "id").collect()}
    assert again == got


def test_content_copies_with_repeated_ids(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (2, "y"), (None, "z"), (None, None), (3, None)], "id int, t string")
    got = sorted(map(tuple, registry.drop_content_copies(df, "t", "id").collect()), key=str)
    assert got == [(1, "x"), (2, "y"), (3, None), (None, "z")]


def test_broadcast_follows_the_bytes_not_the_rows(spark):
    from medlake.plans.bounded import broadcast_if_small

    keys = spark.createDataFrame([("x" * 100,), ("y",), (None,)], "k string")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan(broadcast_if_small(keys, "k", 400))
    assert "ResolvedHint" not in plan(broadcast_if_small(keys, "k", 150))
    assert broadcast_if_small(keys.where("k = 'none'"), "k", 0).count() == 0
