"""Regression metric expressions: every metric is one aggregate over (y, prediction)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def regression_metrics(y: Column, p: Column) -> dict[str, Column]:
    err = y - p
    sse = F.sum(err * err)
    sst = F.var_pop(F.when(p.isNotNull(), y)) * F.count(err)
    return {
        "n": F.count(err),
        "rmse": F.sqrt(F.avg(err * err)),
        "mae": F.avg(F.abs(err)),
        "r2": F.when(sst > 0, F.lit(1.0) - sse / sst),
        "mape": F.avg(F.when(y != 0, F.abs(err / y))) * 100,
        "max_error": F.max(F.abs(err)),
    }


def metric_columns(y: Column, p: Column) -> list[Column]:
    return [c.alias(n) for n, c in regression_metrics(y, p).items()]


def cv_percent(y: Column, p: Column) -> Column:
    """RMSE as a percentage of the mean target."""
    return F.try_divide(F.sqrt(F.avg((y - p) * (y - p))), F.avg(y)) * 100


def rmse_ratio(y: Column, p: Column) -> Column:
    """RMSE over the absolute mean target."""
    return F.try_divide(F.sqrt(F.avg((y - p) * (y - p))), F.abs(F.avg(y)))
