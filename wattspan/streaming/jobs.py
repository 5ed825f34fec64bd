"""Streams over the append logs: window statistics, row validation, drift per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wattspan.functions.columns import qcol, qcols
from wattspan.operators.drift import column_drift, dataset_drift, settle_reference
from wattspan.operators.quality import row_errors, split_valid
from wattspan.operators.small import checkpointed, null_safe_join


def log_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def window_statistics(stream: DataFrame, ts: str, by: list[str], value: str, length: str = "1 hour",
                      late: str = "10 minutes") -> DataFrame:
    """Tumbling-window statistics; rows later than the watermark are dropped.

    The time column is cast to a timestamp, which watermarks need. On a batch frame the same statistics come
    without a watermark.
    """
    v = qcol(value)
    timed = stream.withColumn("_ts", qcol(ts).cast("timestamp"))
    if stream.isStreaming:
        timed = timed.withWatermark("_ts", late)
    out = timed.groupBy(F.window("_ts", length), *qcols(by)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *qcols(by),
                      "n", "mean", "std", "min", "max")


def run_window_statistics(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends closed windows to Parquet; stops when the available input is done."""
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def open_windows(log: DataFrame, closed: DataFrame, ts: str, by: list[str], value: str, length: str = "1 hour") -> DataFrame:
    """Windows that the stream has not written yet, from the log itself.

    The stream writes a window when the watermark passes its end; those still open at the end of the input are
    here. Windows before the last closed one are all written, so older rows are filtered out in the scan.
    """
    written = closed.select("start", *qcols(by)).distinct()
    first = closed.groupBy().agg(F.max("end").alias("e")).select(F.col("e")).scalar()
    recent = log.filter(first.isNull() | (qcol(ts).cast("timestamp") >= first - F.expr(f"INTERVAL {length}")))
    return null_safe_join(window_statistics(recent, ts, by, value, length), written, ["start", *by], "left_anti")


def run_validation(stream: DataFrame, features: list[str], ranges: dict, accepted: str, rejected: str,
                   checkpoint: str) -> StreamingQuery:
    """Valid rows to one table, rejects with their error to another.

    Each batch overwrites its own folder, so a repeated batch leaves no duplicates.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        checked = row_errors(batch, features, ranges).persist()
        good, bad = split_valid(checked)
        good.write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        checked.unpersist()

    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def run_drift(stream: DataFrame, reference: DataFrame, numeric: list[str], categorical: list[str], history: str,
              checkpoint: str, ts: str, min_samples: int = 100) -> StreamingQuery:
    """Drift of every batch against the reference, one history row per batch.

    The reference is counted once, before the stream starts. A row is stamped with the batch's latest ``ts`` and holds
    the verdict, the report per column and the number of rows; batches below ``min_samples`` rows are judged too, and
    marked. A repeated batch overwrites its own folder.
    """
    settled = settle_reference(reference, numeric, categorical)

    def each(batch: DataFrame, batch_id: int) -> None:
        kept = batch.select(*qcols([*numeric, *categorical]), qcol(ts).alias("_ts")).persist()
        rows, latest = kept.agg(F.count(F.lit(1)), F.max("_ts")).first()
        if rows:
            report = checkpointed(column_drift(settled, kept, numeric, categorical))
            # One entry per column of the data set.
            columns = report.agg(F.array_sort(F.collect_list(F.struct("column", "kind", "drift_score", "drifted"))))
            run = dataset_drift(report).withColumn("columns", columns.scalar())
            run = run.withColumn("timestamp", F.lit(latest)).withColumn("rows", F.lit(rows).cast("bigint"))
            run.withColumn("below_min", F.lit(rows < min_samples)).write.mode("overwrite").parquet(f"{history}/batch={batch_id}")
        kept.unpersist()

    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
