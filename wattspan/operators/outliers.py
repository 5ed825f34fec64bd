"""Outlier capping, nulling, reports and removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import number, numeric_columns, qcol, rows_of, set_columns
from wattspan.operators.quantiles import quantile_row
from wattspan.operators.small import checkpointed, scalar_row


def treat_outliers(df: DataFrame, columns: list[str], method: str = "cap", lower: float = 0.01, upper: float = 0.99,
                   interpolation: str = "nearest") -> DataFrame:
    """Caps values at two percentiles, or sets values beyond them to null; NaN stays."""
    if method not in ("cap", "remove"):
        raise ValueError(f"method must be 'cap' or 'remove', got {method}")
    present = [c for c in columns if c in df.columns]
    row = scalar_row(quantile_row(df, present, [lower, upper], interpolation))
    types = dict(df.dtypes)
    exprs = {}
    for c in present:
        lo, hi = (row.getField(f"{c}_q{i}").cast(types[c]) for i in (0, 1))
        if method == "cap":
            exprs[c] = F.when(number(c) < lo, lo).when(number(c) > hi, hi).otherwise(qcol(c))
        else:
            exprs[c] = F.when((number(c) < lo) | (number(c) > hi), None).otherwise(qcol(c))
    return set_columns(df, exprs)


def _with_bounds(df: DataFrame, columns: list[str], interpolation: str) -> DataFrame:
    return df.withColumn("_b", scalar_row(quantile_row(df, columns, [0.25, 0.75], interpolation)))


def _limits(c: str, factor: float = 1.5):
    q1, q3 = (F.col("_b").getField(f"{c}_q{i}") for i in (0, 1))
    return q1, q3, q1 - (q3 - q1) * factor, q3 + (q3 - q1) * factor


def iqr_report(df: DataFrame, columns: list[str] | None = None, interpolation: str = "nearest") -> DataFrame:
    """Quartiles, fences and outlier counts; one scan for all columns after the quartiles."""
    cols = numeric_columns(df) if columns is None else columns
    bounded = _with_bounds(df, cols, interpolation)
    aggs = [F.count(F.lit(1)).alias("_total"), F.first("_b").alias("_b")]
    for i, c in enumerate(cols):
        _, _, lo, hi = _limits(c)
        aggs.append(F.count_if((number(c) < lo) | (number(c) > hi)).alias(f"o{i}"))
    one = bounded.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        q1, q3, lo, hi = _limits(c)
        pct = F.when(F.col("_total") > 0, F.round(F.col(f"o{i}") / F.col("_total") * 100, 2)).otherwise(0.0)
        rows.append(
            [
                ("column", F.lit(c)), ("outlier_count", F.col(f"o{i}")), ("outlier_pct", pct),
                ("total_count", F.col("_total")), ("q1", q1), ("q3", q3), ("iqr", q3 - q1),
                ("lower_bound", lo), ("upper_bound", hi),
            ]
        )
    return rows_of(one, rows).orderBy(F.desc("outlier_count"), "column")


def iqr_outliers(df: DataFrame, column: str, interpolation: str = "nearest") -> DataFrame:
    """The rows outside the fences of one column."""
    bounded = _with_bounds(df, [column], interpolation)
    _, _, lo, hi = _limits(column)
    return bounded.filter((number(column) < lo) | (number(column) > hi)).drop("_b")


def zscore_report(df: DataFrame, columns: list[str] | None = None, threshold: float = 3.0) -> DataFrame:
    """Mean, sample deviation and the number of values more than ``threshold`` away."""
    cols = numeric_columns(df) if columns is None else columns
    stats = df.agg(
        *[F.avg(number(c)).alias(f"{c}|m") for c in cols], *[F.stddev_samp(number(c)).alias(f"{c}|s") for c in cols]
    )
    scored = df.withColumn("_st", scalar_row(stats))
    m = lambda c: F.col("_st").getField(f"{c}|m")
    s = lambda c: F.col("_st").getField(f"{c}|s")
    far = lambda c: (s(c) > 0) & (F.abs((number(c) - m(c)) / F.when(s(c) > 0, s(c))) > threshold)
    one = scored.agg(
        F.count(F.lit(1)).alias("_total"), F.first("_st").alias("_st"),
        *[F.count_if(far(c)).alias(f"o{i}") for i, c in enumerate(cols)],
    )
    return rows_of(
        one,
        [
            [
                ("column", F.lit(c)), ("outlier_count", F.col(f"o{i}")),
                ("outlier_pct", F.when(F.col("_total") > 0, F.round(F.col(f"o{i}") / F.col("_total") * 100, 2))
                 .otherwise(0.0)),
                ("total_count", F.col("_total")), ("mean", m(c)), ("std", s(c)),
            ]
            for i, c in enumerate(cols)
        ],
    ).orderBy(F.desc("outlier_count"), "column")


def zscore_outliers(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    stats = scalar_row(df.agg(F.avg(number(column)).alias("m"), F.stddev_samp(number(column)).alias("s")))
    scored = df.withColumn("_st", stats)
    m, s = F.col("_st").getField("m"), F.col("_st").getField("s")
    scored = scored.withColumn("zscore", F.when(s > 0, F.abs((number(column) - m) / s)))
    return scored.filter(F.col("zscore") > threshold).drop("_st")


def drop_iqr_rows(df: DataFrame, columns: list[str], interpolation: str = "linear") -> DataFrame:
    """Removes rows outside the fences column after column, each on the survivors.

    Nulls and NaN fail the comparison and are removed as well. The survivors are
    checkpointed per column so that the plan does not nest.
    """
    out = df
    for c in columns:
        bounded = _with_bounds(out, [c], interpolation)
        _, _, lo, hi = _limits(c)
        out = checkpointed(bounded.filter((number(c) >= lo) & (number(c) <= hi)).drop("_b"))
    return out
