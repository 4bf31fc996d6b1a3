"""Numeric table quality: ratio parsing, range nulls, median imputation, threshold flags."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from medlake.plans.medians import exact_medians


@dataclass(frozen=True)
class Range:
    """Inclusive bounds of plausible values of one column."""

    column: str
    low: float
    high: float


@dataclass(frozen=True)
class Rule:
    """``flag`` is 1 where ``column op threshold`` holds."""

    flag: str
    column: str
    op: str
    threshold: float


# Plausible ranges and clinical thresholds.
VITAL_RANGES = [
    Range("temperature", 95.0, 106.0),
    Range("heart_rate", 40, 200),
    Range("bp_systolic", 70, 200),
    Range("bp_diastolic", 40, 130),
    Range("oxygen_saturation", 70, 100),
    Range("respiratory_rate", 8, 40),
    Range("wbc", 1.0, 30.0),
]
VITAL_RULES = [
    Rule("fever_flag", "temperature", ">=", 100.4),
    Rule("tachycardia_flag", "heart_rate", ">", 100),
    Rule("elevated_wbc_flag", "wbc", ">", 11.0),
    Rule("hypoxia_flag", "oxygen_saturation", "<", 94),
    Rule("hypertension_flag", "bp_systolic", ">=", 140),
    Rule("tachypnea_flag", "respiratory_rate", ">", 20),
]
NUMERIC_VITALS = [
    "temperature",
    "heart_rate",
    "respiratory_rate",
    "oxygen_saturation",
    "wbc",
    "bp_systolic",
    "bp_diastolic",
]
EXAMPLES_PER_COLUMN = 3

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITY = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def to_number(value: Column) -> Column:
    """A double, or null for anything that is not a number (NaN included)."""
    text = value.cast("string")
    return F.when(text.rlike(_NUMBER) | text.rlike(_INFINITY), text.try_cast("double"))


def coerce_numeric(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_VITALS)) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in columns if c in df.columns})


def split_ratio(
    df: DataFrame,
    column: str = "blood_pressure",
    first: str = "bp_systolic",
    second: str = "bp_diastolic",
) -> DataFrame:
    """``"a/b"`` as two doubles; both null unless there are exactly two numeric parts."""
    parts = F.split(F.col(column), "/")
    left, right = to_number(F.get(parts, F.lit(0))), to_number(F.get(parts, F.lit(1)))
    whole = (F.size(parts) == 2) & left.isNotNull() & right.isNotNull()
    return df.withColumns({first: F.when(whole, left), second: F.when(whole, right)})


def _present(df: DataFrame, ranges: Sequence[Range]) -> list[Range]:
    return [r for r in ranges if r.column in df.columns]


def _value(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _outlier(r: Range) -> Column:
    """Out of range; null is never an outlier."""
    value = _value(r.column)
    return F.coalesce((value < r.low) | (value > r.high), F.lit(False))


def null_out_of_range(df: DataFrame, ranges: Sequence[Range] = tuple(VITAL_RANGES)) -> DataFrame:
    """Values outside their range become null; columns not in the table are skipped."""
    return df.withColumns(
        {
            r.column: F.when(_value(r.column).between(r.low, r.high), _value(r.column))
            for r in _present(df, ranges)
        }
    )


def quality_counts(df: DataFrame, ranges: Sequence[Range] = tuple(VITAL_RANGES)) -> DataFrame:
    """One row of counts over the table *before* nulling, in a single aggregate.

    Missing counts are those after nulling: null or out of range.
    """
    present = _present(df, ranges)
    outliers = {r.column: _outlier(r) for r in present}
    missing = {r.column: _value(r.column).isNull() | outliers[r.column] for r in present}
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(c).alias(f"outliers_{n}") for n, c in outliers.items()],
        *[F.count_if(c).alias(f"missing_{n}") for n, c in missing.items()],
        F.count_if(reduce(or_, outliers.values(), F.lit(False))).alias("rows_with_outliers"),
        F.count_if(reduce(or_, missing.values(), F.lit(False))).alias("rows_with_missing"),
    )
    return counts.select(
        "total_rows",
        _as_map("outliers_", outliers).alias("outliers_by_column"),
        _as_map("missing_", missing).alias("missing_by_column"),
        "rows_with_outliers",
        "rows_with_missing",
    )


def _as_map(prefix: str, names) -> Column:
    return F.create_map(*[x for n in names for x in (F.lit(n), F.col(prefix + n))])


def quality_long(counts: DataFrame) -> DataFrame:
    """(column, outliers, missing) rows of :func:`quality_counts`."""
    return counts.select(
        F.explode("outliers_by_column").alias("column", "outliers"), "missing_by_column"
    ).select("column", "outliers", F.col("missing_by_column")[F.col("column")].alias("missing"))


def outlier_examples(
    df: DataFrame,
    ranges: Sequence[Range] = tuple(VITAL_RANGES),
    per_column: int = EXAMPLES_PER_COLUMN,
) -> DataFrame:
    """The ``per_column`` smallest distinct out-of-range values of each column.

    Distinct values are merged before the shuffle and only the leading ones leave a task.
    """
    entries = [
        F.struct(
            F.lit(r.column).alias("column"), F.when(_outlier(r), _value(r.column)).alias("value")
        )
        for r in _present(df, ranges)
    ]
    distinct = (
        df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull()).distinct()
    )
    order = Window.partitionBy("column").orderBy("value")
    return distinct.withColumn("example", F.row_number().over(order)).where(
        F.col("example") <= per_column
    )


@dataclass(frozen=True)
class MedianImputer:
    """Fitted medians; ``transform`` fills nulls and flags what it filled."""

    medians: dict[str, float | None]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> MedianImputer:
        columns = [c for c in columns if c in df.columns]
        return cls(exact_medians(df.select(*[_value(c).alias(c) for c in columns]), columns))

    def transform(self, df: DataFrame) -> DataFrame:
        """A column that is null throughout stays null; its flags still read 1."""
        values, flags = {}, {}
        for column, median in self.medians.items():
            values[column] = F.coalesce(_value(column), F.lit(median).cast("double"))
            flags[f"{column}_imputed"] = _value(column).isNull().cast("int")
        return df.withColumns(flags).withColumns(values)


def drop_unused_flags(imputed: DataFrame, missing: dict[str, int]) -> DataFrame:
    """Only the ``<col>_imputed`` columns whose source had a missing value."""
    return imputed.drop(*[f"{c}_imputed" for c, n in missing.items() if not n])


_COMPARE = {
    ">=": Column.__ge__,
    ">": Column.__gt__,
    "<": Column.__lt__,
    "<=": Column.__le__,
}


def add_flags(
    df: DataFrame,
    rules: Sequence[Rule] = tuple(VITAL_RULES),
    count_col: str = "abnormal_vital_count",
    stamp: bool = False,
) -> tuple[DataFrame, list[str]]:
    """0/1 flags (null compares as 0), their sum, and the names of the columns added."""
    rules = [r for r in rules if r.column in df.columns]
    flags = {
        r.flag: F.coalesce(_COMPARE[r.op](_value(r.column), F.lit(r.threshold)), F.lit(False)).cast(
            "int"
        )
        for r in rules
    }
    out, added = df.withColumns(flags), list(flags)
    if flags:
        out = out.withColumn(count_col, reduce(add, [F.col(f) for f in flags]))
        added.append(count_col)
    if stamp:
        out = out.withColumn("processing_timestamp", F.current_timestamp())
        added.append("processing_timestamp")
    return out, added


def flag_rates(
    df: DataFrame, flags: Sequence[str], count_col: str = "abnormal_vital_count"
) -> DataFrame:
    """Per flag: positives and percent, with the average and maximum of the flag sum."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.avg(count_col).alias("avg_abnormal"),
        F.max(count_col).alias("max_abnormal"),
        *[F.sum(f).alias(f) for f in flags],
    )
    pairs = F.array(
        *[F.struct(F.lit(f).alias("flag"), F.coalesce(f, F.lit(0)).alias("n")) for f in flags]
    )
    return totals.select(
        F.explode(pairs).alias("p"), "total", "avg_abnormal", "max_abnormal"
    ).select(
        "p.flag",
        F.col("p.n").alias("positives"),
        F.try_divide(F.col("p.n") * 100.0, "total").alias("percent"),
        "avg_abnormal",
        "max_abnormal",
    )
