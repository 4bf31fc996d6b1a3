"""Numeric quality operators over lineitem and part."""

from __future__ import annotations

from pyspark.sql import functions as F

from medlake.operators import quality, summaries
from medlake.operators.quality import MedianImputer, Range, Rule
from medlake.queries.catalog import query, table

RANGES = [
    Range("l_quantity", 5, 45),
    Range("l_extendedprice", 2000.0, 90000.0),
    Range("l_discount", 0.01, 0.09),
]
RULES = [
    Rule("bulk_flag", "l_quantity", ">=", 40),
    Rule("costly_flag", "l_extendedprice", ">", 60000.0),
    Rule("full_price_flag", "l_discount", "<", 0.02),
    Rule("taxed_flag", "l_tax", ">=", 0.05),
]
COLUMNS = [r.column for r in RANGES]
KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]

_RATIO = """CASE p_partkey % 6 WHEN 0 THEN concat(CAST(p_size AS STRING), '/', CAST(p_partkey % 90 AS STRING))
  WHEN 1 THEN CAST(p_size AS STRING) WHEN 2 THEN 'a/b'
  WHEN 3 THEN concat('1/2/', CAST(p_size AS STRING))
  WHEN 4 THEN concat(' ', CAST(p_size AS STRING), ' / 80.5 ') ELSE concat(CAST(p_size AS STRING), '/') END"""


@query(
    "q_split_ratio",
    f"""WITH r AS (SELECT p_partkey, {_RATIO} AS ratio FROM part),
    s AS (SELECT p_partkey, ratio, string_split(ratio, '/') AS p FROM r),
    t AS (SELECT p_partkey, ratio, len(p) AS n, try_cast(trim(p[1]) AS DOUBLE) AS a, try_cast(trim(p[2]) AS DOUBLE) AS b FROM s)
    SELECT p_partkey, ratio, CASE WHEN n = 2 AND a IS NOT NULL AND b IS NOT NULL THEN a END AS upper_part,
           CASE WHEN n = 2 AND a IS NOT NULL AND b IS NOT NULL THEN b END AS lower_part FROM t""",
)
def split_ratio(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.expr(_RATIO).alias("ratio"))
    return quality.split_ratio(parts, "ratio", "upper_part", "lower_part")


_TEXT_NUMBER = """CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN 'n/a'
  WHEN 2 THEN concat('-', CAST(p_size AS STRING), '.5') WHEN 3 THEN concat(CAST(p_size AS STRING), 'mg')
  ELSE '1e2' END"""


@query(
    "q_coerce_numeric",
    f"SELECT p_partkey, try_cast({_TEXT_NUMBER} AS DOUBLE) AS reading FROM part",
)
def coerce_numeric(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.expr(_TEXT_NUMBER).alias("reading"))
    return quality.coerce_numeric(rows, ["reading"])


_RANGED = """ranged AS (SELECT l_orderkey, l_linenumber, l_partkey, l_tax,
  CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS l_quantity,
  CASE WHEN l_extendedprice BETWEEN 2000 AND 90000 THEN l_extendedprice END AS l_extendedprice,
  CASE WHEN l_discount BETWEEN CAST(0.01 AS DOUBLE) AND CAST(0.09 AS DOUBLE) THEN l_discount END AS l_discount
  FROM lineitem)"""


@query(
    "q_range_nulls",
    f"WITH {_RANGED} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount FROM ranged",
)
def range_nulls(spark, sf):
    rows = table(spark, sf, "lineitem").select(*KEYS, *COLUMNS)
    return quality.null_out_of_range(rows, RANGES)


@query(
    "q_quality_counts",
    f"""WITH {_RANGED}, n AS (SELECT count(*) - count(l_quantity) AS q,
        count(*) - count(l_extendedprice) AS p, count(*) - count(l_discount) AS d FROM ranged)
    SELECT 'l_quantity' AS "column", q AS outliers, q AS missing FROM n
    UNION ALL SELECT 'l_extendedprice', p, p FROM n UNION ALL SELECT 'l_discount', d, d FROM n""",
)
def quality_counts(spark, sf):
    return quality.quality_long(quality.quality_counts(table(spark, sf, "lineitem"), RANGES))


@query(
    "q_quality_rows",
    f"""WITH {_RANGED} SELECT count(*) AS total_rows,
      count(*) FILTER (WHERE l_quantity IS NULL OR l_extendedprice IS NULL OR l_discount IS NULL) AS rows_with_outliers,
      count(*) FILTER (WHERE l_quantity IS NULL OR l_extendedprice IS NULL OR l_discount IS NULL) AS rows_with_missing
    FROM ranged""",
)
def quality_rows(spark, sf):
    return quality.quality_counts(table(spark, sf, "lineitem"), RANGES).select(
        "total_rows", "rows_with_outliers", "rows_with_missing"
    )


@query(
    "q_outlier_examples",
    """WITH o AS (SELECT DISTINCT 'l_quantity' AS "column", l_quantity AS value FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45
      UNION ALL SELECT DISTINCT 'l_extendedprice', l_extendedprice FROM lineitem WHERE l_extendedprice NOT BETWEEN 2000 AND 90000
      UNION ALL SELECT DISTINCT 'l_discount', l_discount FROM lineitem
                WHERE l_discount NOT BETWEEN CAST(0.01 AS DOUBLE) AND CAST(0.09 AS DOUBLE))
    SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) AS INTEGER) AS example
    FROM o QUALIFY example <= 3""",
)
def outlier_examples(spark, sf):
    return quality.outlier_examples(table(spark, sf, "lineitem"), RANGES)


_IMPUTED = f"""{_RANGED},
m AS (SELECT median(l_quantity) AS mq, median(l_extendedprice) AS mp, median(l_discount) AS md FROM ranged),
imputed AS (SELECT l_orderkey, l_linenumber, l_partkey, l_tax, coalesce(l_quantity, mq) AS l_quantity,
  coalesce(l_extendedprice, mp) AS l_extendedprice, coalesce(l_discount, md) AS l_discount,
  CAST(l_quantity IS NULL AS INTEGER) AS l_quantity_imputed,
  CAST(l_extendedprice IS NULL AS INTEGER) AS l_extendedprice_imputed,
  CAST(l_discount IS NULL AS INTEGER) AS l_discount_imputed FROM ranged, m)"""


def _imputed(spark, sf):
    ranged = quality.null_out_of_range(
        table(spark, sf, "lineitem").select(*KEYS, *COLUMNS, "l_tax"), RANGES
    )
    return MedianImputer.fit(ranged, COLUMNS).transform(ranged)


@query(
    "q_median_impute",
    f"""WITH {_IMPUTED} SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity, 4) AS l_quantity,
        round(l_extendedprice, 4) AS l_extendedprice, round(l_discount, 4) AS l_discount FROM imputed""",
)
def median_impute(spark, sf):
    return _imputed(spark, sf).select(*KEYS, *[F.round(c, 4).alias(c) for c in COLUMNS])


@query(
    "q_imputed_flags",
    f"""WITH {_IMPUTED} SELECT CAST(sum(l_quantity_imputed) AS BIGINT) AS l_quantity_imputed,
        CAST(sum(l_extendedprice_imputed) AS BIGINT) AS l_extendedprice_imputed,
        CAST(sum(l_discount_imputed) AS BIGINT) AS l_discount_imputed FROM imputed""",
)
def imputed_flags(spark, sf):
    return _imputed(spark, sf).agg(
        *[F.sum(f"{c}_imputed").alias(f"{c}_imputed") for c in COLUMNS]
    )


_FLAGGED = f"""{_IMPUTED}, flagged AS (SELECT *, CAST(l_quantity >= 40 AS INTEGER) AS bulk_flag,
  CAST(l_extendedprice > 60000 AS INTEGER) AS costly_flag,
  CAST(l_discount < CAST(0.02 AS DOUBLE) AS INTEGER) AS full_price_flag,
  CAST(l_tax >= CAST(0.05 AS DOUBLE) AS INTEGER) AS taxed_flag FROM imputed),
counted AS (SELECT *, bulk_flag + costly_flag + full_price_flag + taxed_flag AS abnormal_count FROM flagged)"""
_FLAG_NAMES = [r.flag for r in RULES]


def _flagged(spark, sf):
    return quality.add_flags(_imputed(spark, sf), RULES, "abnormal_count")[0]


@query(
    "q_rule_flags",
    f"""WITH {_FLAGGED} SELECT l_orderkey, l_linenumber, l_partkey, bulk_flag, costly_flag, full_price_flag,
        taxed_flag FROM counted""",
)
def rule_flags(spark, sf):
    return _flagged(spark, sf).select(*KEYS, *_FLAG_NAMES)


@query(
    "q_abnormal_count",
    f"WITH {_FLAGGED} SELECT abnormal_count, count(*) AS n FROM counted GROUP BY abnormal_count",
)
def abnormal_count(spark, sf):
    return _flagged(spark, sf).groupBy("abnormal_count").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_flag_rates",
    f"""WITH {_FLAGGED}, t AS (SELECT count(*) AS total, avg(abnormal_count) AS av, max(abnormal_count) AS mx,
      CAST(sum(bulk_flag) AS BIGINT) AS b, CAST(sum(costly_flag) AS BIGINT) AS c,
      CAST(sum(full_price_flag) AS BIGINT) AS f, CAST(sum(taxed_flag) AS BIGINT) AS x FROM counted),
    l AS (SELECT 'bulk_flag' AS flag, b AS positives, * FROM t UNION ALL SELECT 'costly_flag', c, * FROM t
      UNION ALL SELECT 'full_price_flag', f, * FROM t UNION ALL SELECT 'taxed_flag', x, * FROM t)
    SELECT flag, positives, round(positives * 100.0 / total, 6) AS percent, round(av, 6) AS avg_abnormal,
           mx AS max_abnormal FROM l""",
)
def flag_rates(spark, sf):
    rates = quality.flag_rates(_flagged(spark, sf), _FLAG_NAMES, "abnormal_count")
    return rates.withColumns(
        {"percent": F.round("percent", 6), "avg_abnormal": F.round("avg_abnormal", 6)}
    )


@query(
    "q_value_counts",
    """SELECT event_type AS value, count(*) AS n,
              round(count(*) * 100.0 / (SELECT count(*) FROM events), 6) AS percent
       FROM events GROUP BY event_type""",
)
def value_counts(spark, sf):
    counts = summaries.value_counts(table(spark, sf, "events"), "event_type")
    return counts.withColumn("percent", F.round("percent", 6))


_PEOPLE = "25 + CAST(c_custkey % 61 AS INT) AS age, CASE WHEN c_nationkey % 3 = 0 THEN 'M' ELSE 'F' END AS sex"


@query(
    "q_demographics",
    f"""SELECT min(age) AS age_min, max(age) AS age_max, round(avg(age), 6) AS age_mean,
        count(*) FILTER (WHERE sex = 'M') AS n_M, count(*) FILTER (WHERE sex = 'F') AS n_F
        FROM (SELECT {_PEOPLE} FROM customer)""",
)
def demographics(spark, sf):
    people = table(spark, sf, "customer").selectExpr(
        "25 + CAST(c_custkey % 61 AS INT) AS age",
        "CASE WHEN c_nationkey % 3 = 0 THEN 'M' ELSE 'F' END AS sex",
    )
    return summaries.demographics(people).withColumn("age_mean", F.round("age_mean", 6))


@query(
    "q_group_stats",
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS o_totalprice_mean,
              min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max
       FROM orders GROUP BY o_orderpriority""",
)
def group_stats(spark, sf):
    stats = summaries.group_stats(table(spark, sf, "orders"), "o_orderpriority", ["o_totalprice"])
    return stats.withColumn("o_totalprice_mean", F.round("o_totalprice_mean", 4))
