"""One monitoring run: align, drift, performance, history, trend, alert."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import numeric_columns, qcol
from wattspan.operators import clean, drift, evaluate, history, quality
from wattspan.operators.small import checkpointed, scalar_row
from wattspan.sources import io

# Columns of the metric history, in order.
HISTORY_COLUMNS = [
    "timestamp", "drift_score", "share_of_drifted_features", "number_of_drifted_features", "dataset_drift",
    "rmse", "mae", "r2_score", "mape", "rmse_degradation",
]


@dataclass
class MonitoringSpec:
    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    target: str | None = None
    prediction: str | None = None
    reference_rmse: float | None = None
    window: int = 10


def run_metrics(columns: DataFrame, current: DataFrame, spec: MonitoringSpec, at: str) -> DataFrame:
    """One row of drift and regression metrics."""
    run = drift.dataset_drift(columns).withColumn("timestamp", F.lit(at).cast("timestamp_ntz"))
    none = F.lit(None).cast("double")
    if spec.target and spec.prediction:
        m = scalar_row(evaluate.metrics(current, spec.target, spec.prediction))
        run = run.withColumn("_m", m)
        get = lambda n: F.col("_m").getField(n)
    else:
        get = lambda n: none
    degradation = none
    if spec.reference_rmse:
        degradation = (get("rmse") - spec.reference_rmse) / F.lit(spec.reference_rmse)
    return run.select(
        "timestamp", "drift_score", "share_of_drifted_features", "number_of_drifted_features", "dataset_drift",
        get("rmse").alias("rmse"), get("mae").alias("mae"), get("r2").alias("r2_score"), get("mape").alias("mape"),
        degradation.alias("rmse_degradation"), "drifted_features",
    )


def monitoring_job(reference: DataFrame, production: DataFrame, spec: MonitoringSpec, at: str,
                   history_path: str) -> dict[str, DataFrame]:
    """Schema errors stop the run unless alignment cures them; the run is appended to the history."""
    checked = quality.schema_check(reference, production)
    if checked.filter("level = 'error' AND (issue = 'missing in production' OR cast_failures > 0)").limit(1).count():
        bad = [r["column"] for r in checked.filter("level = 'error'").select("column").collect()]
        raise ValueError(f"Schema validation failed after alignment: {bad}")
    current = clean.align_schema(reference, production)
    if current.limit(1).count() == 0:
        raise ValueError("Production data is empty")
    columns = checkpointed(drift.column_drift(reference, current, spec.numeric, spec.categorical))
    run = checkpointed(run_metrics(columns, current, spec, at))
    io.append_history(run.select(*[qcol(c) for c in HISTORY_COLUMNS]), history_path)
    past = reference.sparkSession.read.parquet(history_path)
    return {
        "schema": checked,
        "columns": columns,
        "run": run,
        "trends": history.trend_report(past, spec.window),
        "alert": drift.alert(run, spec.reference_rmse),
    }


def log_drift(reference: DataFrame, log: DataFrame, at: str) -> DataFrame:
    """Drift of the prediction log: time stamp and prediction are left out, the columns must be the same."""
    current = log.drop("timestamp", "prediction")
    if set(current.columns) != set(reference.columns):
        raise ValueError(f"columns differ: {sorted(set(current.columns) ^ set(reference.columns))}")
    numeric = numeric_columns(reference)
    categorical = [n for n, k in reference.dtypes if k == "string"]
    columns = drift.column_drift(reference, current, numeric, categorical)
    return drift.dataset_drift(columns).withColumn("timestamp", F.lit(at).cast("timestamp_ntz"))
