import statistics

import pytest
from pyspark.sql import functions as F

from medlake.operators import quality
from medlake.operators.quality import MedianImputer, Range, Rule
from medlake.plans.medians import exact_medians


def test_split_ratio_edges(spark):
    cases = ["129/64", "129", "a/b", "1/2/3", " 120 / 80 ", None, "120/", "1d/2", "inf/3", "nan/3"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, blood_pressure string")
    rows = quality.split_ratio(df).orderBy("i").collect()
    none = (None, None)
    want = [(129.0, 64.0), none, none, none, (120.0, 80.0), none, none, none, (float("inf"), 3.0), none]
    assert [(r.bp_systolic, r.bp_diastolic) for r in rows] == want


def test_coerce(spark):
    df = spark.createDataFrame([("1.5", "x")], "temperature string, other string")
    row = quality.coerce_numeric(df).first()
    assert (row.temperature, row.other) == (1.5, "x")
    bad = spark.createDataFrame([("warm", "x")], "temperature string, other string")
    assert quality.coerce_numeric(bad).first().temperature is None


VITALS = [
    (95.0, 40.0), (94.9, 41.0), (106.0, 200.0), (106.1, 39.0), (None, 60.0), (float("nan"), None),
]


def test_ranges_and_counts(spark):
    df = spark.createDataFrame(VITALS, "temperature double, heart_rate double")
    kept = quality.null_out_of_range(df).collect()
    assert [r.temperature for r in kept] == [95.0, None, 106.0, None, None, None]
    assert [r.heart_rate for r in kept] == [40.0, 41.0, 200.0, None, 60.0, None]
    counts = quality.quality_counts(df).first()
    assert counts.total_rows == 6
    assert counts.outliers_by_column == {"temperature": 2, "heart_rate": 1}
    assert counts.missing_by_column == {"temperature": 4, "heart_rate": 2}
    assert counts.rows_with_outliers == 2 and counts.rows_with_missing == 4


def test_outlier_examples(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 3, 4, 50)], "heart_rate double")
    rows = quality.outlier_examples(df).orderBy("example").collect()
    assert [r.value for r in rows] == [1.0, 2.0, 3.0]


def test_imputation(spark):
    df = spark.createDataFrame(
        [(1.0, None, 5.0), (3.0, None, None), (None, None, 7.0), (10.0, None, 1.0), (2.0, None, None)],
        "a double, b double, c double",
    )
    model = MedianImputer.fit(df, ["a", "b", "c"])
    assert model.medians == {"a": 2.5, "b": None, "c": 5.0}
    rows = model.transform(df).collect()
    assert [r.a for r in rows] == [1.0, 3.0, 2.5, 10.0, 2.0]
    assert [r.a_imputed for r in rows] == [0, 0, 1, 0, 0]
    assert all(r.b is None and r.b_imputed == 1 for r in rows)
    slim = quality.drop_unused_flags(model.transform(df), {"a": 1, "b": 0, "c": 2})
    assert "b_imputed" not in slim.columns and "c_imputed" in slim.columns


@pytest.mark.parametrize("buckets", [2, 7, 4096])
def test_medians_match_statistics(spark, buckets):
    import random

    rng = random.Random(buckets)
    columns = {
        "even": [rng.uniform(-1e3, 1e3) for _ in range(200)],
        "hot": [5.0] * 150 + [rng.random() for _ in range(51)],
        "wide": [rng.choice([-1.7e308, 1.7e308, 1e-300, 0.0, -3.5]) for _ in range(201)],
        "same": [4.25] * 40,
    }
    length = max(len(v) for v in columns.values())
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(length)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    got = exact_medians(df, list(columns), buckets)
    for name, values in columns.items():
        assert got[name] == pytest.approx(statistics.median(values), rel=1e-15)


def test_medians_refuse_infinity(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,)], "a double")
    with pytest.raises(ValueError):
        exact_medians(df, ["a"])


def test_flags(spark):
    schema = (
        "temperature double, heart_rate double, wbc double, oxygen_saturation double, "
        "bp_systolic double, respiratory_rate double"
    )
    rows = [
        (100.4, 100.0, 11.0, 94.0, 140.0, 20.0),
        (100.3, 100.5, 11.1, 93.9, 139.9, 20.5),
        (None, None, None, None, None, None),
    ]
    out, added = quality.add_flags(spark.createDataFrame(rows, schema), stamp=True)
    got = out.collect()
    assert [r.fever_flag for r in got] == [1, 0, 0]
    assert [r.tachycardia_flag for r in got] == [0, 1, 0]
    assert [r.elevated_wbc_flag for r in got] == [0, 1, 0]
    assert [r.hypoxia_flag for r in got] == [0, 1, 0]
    assert [r.hypertension_flag for r in got] == [1, 0, 0]
    assert [r.tachypnea_flag for r in got] == [0, 1, 0]
    assert [r.abnormal_vital_count for r in got] == [2, 4, 0]
    assert added[-2:] == ["abnormal_vital_count", "processing_timestamp"] and len(added) == 8
    rates = {r.flag: r for r in quality.flag_rates(out, added[:6]).collect()}
    assert rates["fever_flag"].positives == 1
    assert rates["fever_flag"].percent == pytest.approx(100 / 3)
    assert rates["fever_flag"].avg_abnormal == 2.0 and rates["fever_flag"].max_abnormal == 4


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(101.0,)], "temperature double")
    out, added = quality.add_flags(df)
    assert added == ["fever_flag", "abnormal_vital_count"]
    rules = [Rule("f", "none", ">", 1)]
    assert quality.add_flags(df, rules)[1] == []
    counts = quality.quality_counts(df, [Range("temperature", 95, 106), Range("none", 0, 1)]).first()
    assert counts.outliers_by_column == {"temperature": 0}


def test_range_check_is_one_narrow_pass(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    plan = quality.null_out_of_range(
        items.select("l_orderkey", "l_quantity"), [Range("l_quantity", 5, 45)]
    )._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    counted = quality.quality_counts(items, [Range("l_quantity", 5, 45)])
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange SinglePartition") == 1
    assert F is not None
