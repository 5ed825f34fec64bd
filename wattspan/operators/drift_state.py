"""Drift over any range of runs from stored counts, without their raw rows.

A run's state is its rows per distinct value of every column. States of runs add
up, so those of a range of runs are the state of the union of their rows, and
every drift measure on them equals the measure on that union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.functions.columns import qcol, qcols, require, unpivot
from wattspan.operators.drift import Reference
from wattspan.operators.small import checkpointed

SCHEMA = "kind string, column string, value double, category string, n bigint, run string"


def summarise(df: DataFrame, numeric: list[str], categorical: list[str], run: Column) -> DataFrame:
    """The state of each run in ``df``; ``run`` gives its name, which sorts in the order of runs.

    Nulls and NaN are left out, as in the drift measures. A run without any value has no rows.
    """
    require(df, [*numeric, *categorical])
    if not (numeric or categorical):
        raise ValueError("no columns to summarise")
    named = df.select(*qcols(dict.fromkeys([*numeric, *categorical])), run.cast("string").alias("_run"))
    parts = []
    if numeric:
        long = unpivot(named, ["_run"], numeric, "column", "value").filter("value IS NOT NULL AND NOT isnan(value)")
        parts.append(long.groupBy("_run", "column", "value").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("numeric").alias("kind"), "column", "value", F.lit(None).cast("string").alias("category"), "n", "_run"))
    if categorical:
        text = named.select("_run", *[qcol(c).cast("string").alias(c) for c in categorical])
        long = text.unpivot(["_run"], qcols(categorical), "column", "category").filter("category IS NOT NULL")
        parts.append(long.groupBy("_run", "column", "category").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("categorical").alias("kind"), "column", F.lit(None).cast("double").alias("value"), "category", "n", "_run"))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.filter("_run IS NOT NULL").withColumnRenamed("_run", "run")


def store(states: DataFrame, path: str) -> None:
    """Adds the runs to the stored ones; a run that is stored again takes the place of the first."""
    states.write.partitionBy("run").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def newest_runs(states: DataFrame, n: int) -> tuple[str, str] | None:
    """First and last name of the newest ``n`` runs; at most ``n`` names reach the driver."""
    if n <= 0:
        raise ValueError("n must be positive")
    names = [row["run"] for row in states.select("run").distinct().orderBy(F.desc("run")).limit(n).collect()]
    return (names[-1], names[0]) if names else None


def merged(states: DataFrame, first: str | None = None, last: str | None = None) -> Reference:
    """The runs from ``first`` to ``last``, both included, as one side of a drift comparison; an open end is None."""
    kept = states
    if first is not None:
        kept = kept.filter(F.col("run") >= first)
    if last is not None:
        kept = kept.filter(F.col("run") <= last)
    summed = lambda kind, value: kept.filter(F.col("kind") == kind).groupBy("column", value).agg(F.sum("n").alias("n"))
    return Reference(checkpointed(summed("numeric", "value")), checkpointed(summed("categorical", "category")))
