"""Reading and writing tables, logs and history."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from wattspan.functions.columns import qcol, quoted, rows_of


def _existing(read, path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV as text columns; types are applied later by a lenient cast.

    Naming the columns avoids the extra pass that reads the header.
    """
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(", ".join(f"{quoted(c)} string" for c in columns))
    return _existing(lambda: reader.csv(path), path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _existing(lambda: spark.read.parquet(path), path)


def load_table(spark: SparkSession, path: str, name: str, mode: str = "replace", location: str | None = None) -> None:
    """Parquet files into a named table; ``mode`` is replace, append or error."""
    modes = {"replace": "overwrite", "append": "append", "error": "errorifexists"}
    if mode not in modes:
        raise ValueError(f"mode must be one of {sorted(modes)}, got {mode}")
    writer = read_parquet(spark, path).write.format("parquet").mode(modes[mode])
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def ensure_table(spark: SparkSession, path: str, name: str, force: bool = False, location: str | None = None) -> None:
    """Loads the table only when it is absent or ``force`` is set."""
    if force or not spark.catalog.tableExists(name):
        load_table(spark, path, name, "replace", location)


def table_info(df: DataFrame) -> DataFrame:
    """Column names and types with the row count."""
    count = df.agg(F.count(F.lit(1)).alias("row_count"))
    return rows_of(
        count,
        [
            [("column_name", F.lit(n)), ("data_type", F.lit(k)), ("row_count", F.col("row_count"))]
            for n, k in df.dtypes
        ],
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(split).option("compression", "snappy").parquet(path)


def limited(df: DataFrame, limit: int | None = None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def append_predictions(scored: DataFrame, path: str, at: Column) -> None:
    """Adds scored rows to the prediction log, stamped with ``at``."""
    scored.select(at.cast("timestamp_ntz").alias("timestamp"), "*").write.mode("append").parquet(path)


# Names that readers pass over: what a day keeps, and a day that is being replaced.
_KEPT, _ASIDE = "_kept-", "_aside-"


def append_history(metrics: DataFrame, path: str, timestamp: str = "timestamp") -> None:
    """Adds run metrics to the history, one partition per run day."""
    metrics.withColumn("run_date", qcol(timestamp).cast("date")).write.mode("append").partitionBy(
        "run_date"
    ).parquet(path)


def read_history(spark: SparkSession, path: str, limit: int | None = None, timestamp: str = "timestamp") -> DataFrame:
    """Newest runs first. With a limit, only the newest partitions that hold so many runs are read."""
    df = read_parquet(spark, path)
    if limit is not None:
        # One row per day of history.
        newer = W.orderBy(F.desc("run_date")).rowsBetween(W.unboundedPreceding, -1)
        days = df.groupBy("run_date").agg(F.count(F.lit(1)).alias("n"))
        needed = days.filter("run_date IS NOT NULL").withColumn("_before", F.coalesce(F.sum("n").over(newer), F.lit(0)))
        last = needed.filter(F.col("_before") < limit).agg(F.min("run_date").alias("d"), F.sum("n").alias("n")).first()
        # Runs without a date come last, where the dated ones do not fill the limit.
        if last["d"] is not None and last["n"] >= limit:
            df = df.filter(F.col("run_date") >= F.lit(last["d"]))
    return limited(df.drop("run_date").orderBy(qcol(timestamp).desc()), limit)


def retained(history: DataFrame, days: int = 90, timestamp: str = "timestamp") -> DataFrame:
    """Entries of the last ``days`` days, counted back from the newest entry.

    Where the history has its ``run_date`` partitions, only those in reach are read.
    """
    since = lambda newest: newest - F.make_interval(days=F.lit(days))
    if "run_date" in history.columns:
        last = history.agg(F.max("run_date").alias("d")).first()["d"]
        if last is not None:
            # A day earlier than the exact bound, which the filter below applies.
            history = history.filter(F.col("run_date") >= F.date_sub(F.lit(last), days + 1))
    newest = history.agg(F.max(qcol(timestamp))).scalar()
    return history.filter(qcol(timestamp) >= since(newest))


def rewrite_retained(spark: SparkSession, path: str, target: str, days: int = 90, timestamp: str = "timestamp") -> None:
    """Writes the retained history to a new folder; the old one stays until it is swapped out."""
    kept = retained(read_parquet(spark, path), days, timestamp)
    kept.write.mode("overwrite").partitionBy("run_date").parquet(target)


def _files(spark: SparkSession, path: str):
    """The file system of a path, a maker of paths below it, and the names there."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    root = make(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, lambda name: make(root, name), [x.getPath().getName() for x in fs.listStatus(root)]


def recover_history(spark: SparkSession, path: str) -> None:
    """Finishes or takes back a removal that was interrupted. Nothing is lost: a day that is away has a whole copy aside."""
    fs, at, names = _files(spark, path)
    for name in names:
        if not name.startswith(_ASIDE):
            continue
        day = name.removeprefix(_ASIDE)
        if not fs.exists(at(day)):
            fs.rename(at(_KEPT + day if fs.exists(at(f"{_KEPT}{day}/_SUCCESS")) else name), at(day))
        fs.delete(at(name), True)
    for name in names:
        if name.startswith(_KEPT) and fs.exists(at(name)):
            fs.delete(at(name), True)


def remove_expired(spark: SparkSession, path: str, days: int = 90, timestamp: str = "timestamp") -> int:
    """Removes the entries of a history that are over ``days`` days older than its newest one; gives their number.

    Days that expire whole are deleted as folders. Of the day in which the limit falls, the entries to keep are first
    written beside it under a name that readers pass over, then both change places. Each step can be repeated, and
    ``recover_history`` (called first) settles one that was interrupted. Entries without a date stay.
    """
    recover_history(spark, path)
    history = read_parquet(spark, path)
    newest = F.max(qcol(timestamp))
    cut = (newest - F.make_interval(days=F.lit(days))).alias("cut")
    limit = history.agg(cut, cut.cast("date").alias("day")).first()
    if limit["cut"] is None:
        return 0
    before = history.filter(F.col("run_date") < F.lit(limit["day"]))
    edge = history.filter(F.col("run_date") == F.lit(limit["day"]))
    expired = qcol(timestamp) < F.lit(limit["cut"])
    removed = before.count()
    gone, there = edge.agg(F.count_if(expired), F.count(F.lit(1))).first()
    fs, at, names = _files(spark, path)
    day = f"run_date={limit['day']}"
    if gone and gone < there:
        edge.filter(~expired).drop("run_date").write.mode("overwrite").parquet(at(_KEPT + day).toString())
        fs.rename(at(day), at(_ASIDE + day))
        fs.rename(at(_KEPT + day), at(day))
        fs.delete(at(_ASIDE + day), True)
    elif gone:
        fs.delete(at(day), True)
    # One folder per day of history.
    for name in names:
        if name.startswith("run_date=") and name[9:10].isdigit() and name < day:
            fs.delete(at(name), True)
    spark.catalog.refreshByPath(path)
    return removed + gone


def sample_check(reference: DataFrame, production: DataFrame, min_samples: int = 100) -> DataFrame:
    """One row: sizes of both sets, emptiness, and whether production has too few rows."""
    ref = reference.agg(F.count(F.lit(1)).alias("reference_rows"))
    both = ref.withColumn("production_rows", production.agg(F.count(F.lit(1))).scalar())
    return both.select(
        "*",
        (F.col("reference_rows") == 0).alias("reference_empty"),
        (F.col("production_rows") == 0).alias("production_empty"),
        (F.col("production_rows") < min_samples).alias("below_min"),
    )
