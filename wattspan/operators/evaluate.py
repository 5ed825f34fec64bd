"""Scores of predictions, by split, segment and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wattspan.functions.columns import qcol, qcols
from wattspan.functions.metrics import cv_percent, metric_columns, rmse_ratio
from wattspan.operators.corr import correlation_matrix


def metrics(df: DataFrame, y: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """RMSE, MAE, R2, MAPE over non-zero targets, and the largest error, per group."""
    aggs = metric_columns(qcol(y), qcol(prediction))
    return df.groupBy(*qcols(by)).agg(*aggs) if by else df.agg(*aggs)


def relative_errors(df: DataFrame, y: str, prediction: str, benchmark_rmse: float) -> DataFrame:
    """CV percent, RMSE ratio, RMSE in target deviations, and improvement over a benchmark in percent."""
    a, p = qcol(y), qcol(prediction)
    rmse = F.sqrt(F.avg((a - p) * (a - p)))
    return df.agg(
        cv_percent(a, p).alias("cv_pct"), rmse_ratio(a, p).alias("rmse_ratio"),
        F.try_divide(rmse, F.stddev_samp(a)).alias("rmse_normalised"),
        ((F.lit(benchmark_rmse) - rmse) / F.lit(benchmark_rmse) * 100).alias("improvement_pct"),
    )


def metrics_by_segment(long: DataFrame, model: str, segment: str, y: str, prediction: str) -> DataFrame:
    return metrics(long, y, prediction, [model, segment])


def rmse_by_hour(long: DataFrame, model: str, hour: str, y: str, prediction: str, more_than: int = 10) -> DataFrame:
    """RMSE per model and hour, for hours with more than ``more_than`` rows."""
    e = qcol(y) - qcol(prediction)
    per = long.groupBy(qcol(model), qcol(hour)).agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"))
    return per.filter(F.col("n") > more_than)


def residual_summary(long: DataFrame, model: str, y: str, prediction: str) -> DataFrame:
    """Mean, population deviation and the two-deviation band of the residuals."""
    e = qcol(y) - qcol(prediction)
    per = long.groupBy(qcol(model)).agg(F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"))
    m, s = F.col("mean"), F.col("std")
    return per.select(qcol(model), "mean", "std", (m - 2 * s).alias("lower"), (m + 2 * s).alias("upper"))


def residual_correlation(long: DataFrame, row_id: str, model: str, models: list[str], y: str,
                         prediction: str) -> DataFrame:
    """Correlation of the residuals of each pair of models."""
    e = qcol(y) - qcol(prediction)
    wide = long.groupBy(qcol(row_id)).agg(*[F.max(F.when(qcol(model) == m, e)).alias(m) for m in models])
    return correlation_matrix(wide, models)


def compare_models(long: DataFrame, model: str, y: str, prediction: str, split: str | None = None) -> DataFrame:
    """Metric table per model (and split) with the smallest RMSE flagged."""
    by = [split, model] if split else [model]
    table = metrics(long, y, prediction, by)
    # One row per model and split goes through this window.
    place = F.row_number().over((W.partitionBy(qcol(split)) if split else W.partitionBy()).orderBy("rmse", qcol(model)))
    return table.withColumn("is_best", place == 1)


def summary_by_type(table: DataFrame, kind: str, names: list[str]) -> DataFrame:
    """Mean, min and max of each metric per model type."""
    return table.groupBy(qcol(kind)).agg(
        *[f(qcol(c)).alias(f"{c}_{n}") for c in names for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    )


def improvement_over(table: DataFrame, model: str, metric: str, baseline: str) -> DataFrame:
    """How much lower, in percent, the metric is than the baseline model's."""
    base = table.filter(qcol(model) == baseline).agg(F.max(qcol(metric))).scalar()
    out = table.select(qcol(model), qcol(metric)).withColumn("_b", base)
    return out.withColumn("improvement_pct", F.try_divide(F.col("_b") - qcol(metric), F.col("_b")) * 100).drop("_b")


def worst_predictions(df: DataFrame, y: str, prediction: str, row_id: list[str], n: int = 10) -> DataFrame:
    err = F.abs(qcol(y) - qcol(prediction))
    return df.withColumn("abs_error", err).orderBy(F.desc("abs_error"), *qcols(row_id)).limit(n)


def gate(scores: DataFrame, max_rmse: float, min_r2: float) -> DataFrame:
    """Adds the two threshold checks and whether both hold."""
    ok_rmse: Column = F.coalesce(F.col("rmse") < max_rmse, F.lit(False))
    ok_r2: Column = F.coalesce(F.col("r2") > min_r2, F.lit(False))
    return scores.select("*", ok_rmse.alias("rmse_ok"), ok_r2.alias("r2_ok"), (ok_rmse & ok_r2).alias("passed"))
