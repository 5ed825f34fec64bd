"""Trends, summaries and anomalies over the newest monitoring runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from wattspan.functions.columns import numeric_columns, qcol, unpivot

# Metrics of the trend report, and the slope below which a metric is stable.
TRACKED = ["drift_score", "share_of_drifted_features", "number_of_drifted_features", "rmse", "mae", "r2_score"]
STABLE_SLOPE = 0.001


def newest(history: DataFrame, window: int, timestamp: str = "timestamp") -> DataFrame:
    return history.orderBy(qcol(timestamp).desc()).limit(window)


def _long(history: DataFrame, metrics: list[str], window: int, timestamp: str) -> DataFrame:
    """(timestamp, metric, value) of the newest runs without nulls: at most window * metrics rows."""
    return unpivot(newest(history, window, timestamp), [timestamp], metrics, "metric", "value").filter(
        "value IS NOT NULL")


def trends(history: DataFrame, metrics: list[str], window: int = 5, timestamp: str = "timestamp") -> DataFrame:
    """Least-squares slope over run number: increasing, decreasing, stable, or null below two runs."""
    long = _long(history, metrics, window, timestamp)
    at = F.row_number().over(W.partitionBy("metric").orderBy(qcol(timestamp))) - 1
    per = long.withColumn("_at", at).groupBy("metric").agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("value", "_at").alias("slope"))
    verdict = F.when(F.col("slope") > STABLE_SLOPE, "increasing").when(
        F.col("slope") < -STABLE_SLOPE, "decreasing").otherwise("stable")
    return per.select("metric", "slope", F.when(F.col("n") >= 2, verdict).alias("trend"))


def summaries(history: DataFrame, metrics: list[str], window: int = 30, timestamp: str = "timestamp") -> DataFrame:
    long = _long(history, metrics, window, timestamp)
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.max_by("value", qcol(timestamp)).alias("latest"),
        F.count(F.lit(1)).alias("count"),
    )


def anomalies(history: DataFrame, metrics: list[str], window: int = 30, threshold: float = 2.0,
              timestamp: str = "timestamp") -> DataFrame:
    """Whether the latest value is far from the window mean; needs three runs."""
    s = summaries(history, metrics, window, timestamp)
    z = F.when(F.col("count") < 3, None).when(F.col("std") == 0, 0.0).otherwise(
        F.abs((F.col("latest") - F.col("mean")) / F.col("std")))
    out = s.select("metric", "latest", z.alias("z_score"))
    return out.withColumn("is_anomalous", F.coalesce(F.col("z_score") > threshold, F.lit(False)))


def trend_report(history: DataFrame, window: int = 10, metrics: list[str] | None = None,
                 timestamp: str = "timestamp") -> DataFrame:
    """Trend, summary and anomaly of every tracked metric."""
    names = TRACKED if metrics is None else metrics
    s = summaries(history, names, window, timestamp)
    t = trends(history, names, window, timestamp)
    a = anomalies(history, names, window, timestamp=timestamp).select("metric", "z_score", "is_anomalous")
    # One row per metric on every side.
    return s.join(F.broadcast(t), "metric").join(F.broadcast(a), "metric")


def history_summary(history: DataFrame, window: int = 100, timestamp: str = "timestamp") -> DataFrame:
    """Record count and date range next to the statistics of every numeric column."""
    kept = newest(history, window, timestamp)
    facts = kept.agg(
        F.count(F.lit(1)).alias("total_records"), F.min(qcol(timestamp)).alias("first_run"),
        F.max(qcol(timestamp)).alias("last_run"),
    )
    s = summaries(history, numeric_columns(history), window, timestamp)
    row = facts.select(F.struct("*")).scalar()
    out = s.withColumn("_f", row)
    return out.select(
        "metric", "mean", "std", "min", "max", "latest",
        *[F.col("_f").getField(c).alias(c) for c in ("total_records", "first_run", "last_run")],
    )
