"""Categories as target statistics, without leakage from a row's own target.

In training, a row's category is encoded by the mean target of the rows of that
category that come before it in a seeded hash order, drawn towards the mean of
all rows by ``weight``. In scoring, all training rows of the category count. The
running sums are cut into slices (:mod:`wattspan.operators.order`), so one
category may hold most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import number, qcol, qcols, require, set_columns
from wattspan.functions.hashing import seeded_md5
from wattspan.operators.order import running
from wattspan.operators.small import join_small, scalar_row

WEIGHT = 1.0


def _known(df: DataFrame, target: str) -> Column:
    """The target as a number; NaN is missing."""
    return number(target) if dict(df.dtypes)[target] in ("double", "float") else qcol(target)


def _shrunk(total: Column, n: Column, prior: Column, weight: float) -> Column:
    return F.try_divide(total + F.lit(weight) * prior, n + F.lit(weight))


def encode_training(df: DataFrame, column: str, target: str, id_col: str, seed: int = 42, weight: float = WEIGHT,
                    name: str | None = None) -> DataFrame:
    """Adds ``<column>_target`` (or ``name``) for training rows.

    ``id_col`` is unique and decides the order. Null is a category of its own. Rows without a target are encoded, but add
    nothing to others. With no target in the whole table every row is null; with weight 0 the first row of a category is.
    """
    require(df, [column, target, id_col])
    if weight < 0:
        raise ValueError("weight must not be negative")
    y = _known(df, target).cast("double")
    prior = scalar_row(df.agg(F.avg(y).alias("p"))).getField("p")
    # Only what the sums need is put in order.
    slim = df.select(qcol(id_col).alias("_id"), qcol(column).cast("string").alias("_c"), F.coalesce(y, F.lit(0.0)).alias("_y"),
                     y.isNotNull().cast("bigint").alias("_n"), seeded_md5(qcol(id_col), seed).alias("_digest"))
    summed = running(slim, ["_y", "_n"], ["_digest", "_id"], ["_c"])
    before = summed.select("_id", (F.col("_y_cum") - F.col("_y")).alias("_ys"), (F.col("_n_cum") - F.col("_n")).alias("_ns"))
    out = df.join(before, qcol(id_col) == F.col("_id"), "left").withColumn("_p", prior)
    # Differences of running sums leave rounding where nothing came before.
    total = F.when(F.col("_ns") > 0, F.col("_ys")).otherwise(0.0)
    return set_columns(out, {name or f"{column}_target": _shrunk(total, F.col("_ns"), F.col("_p"), weight)}).drop("_id", "_ys", "_ns", "_p")


def target_table(df: DataFrame, column: str, target: str) -> DataFrame:
    """``category``, ``total`` and ``n`` of the training rows with a target, and ``prior``, the mean of all of them."""
    require(df, [column, target])
    y = _known(df, target).cast("double")
    per = df.groupBy(qcol(column).cast("string").alias("category")).agg(
        F.coalesce(F.sum(y), F.lit(0.0)).alias("total"), F.count(y).alias("n"))
    prior = scalar_row(df.agg(F.avg(y).alias("p"))).getField("p")
    return per.withColumn("prior", prior)


def encode_scoring(df: DataFrame, table: DataFrame, column: str, weight: float = WEIGHT, name: str | None = None) -> DataFrame:
    """Adds ``<column>_target`` (or ``name``) by the table of the training rows; an unknown category gets the prior."""
    require(df, [column])
    prior = scalar_row(table.agg(F.max("prior").alias("p"))).getField("p")
    side = table.select(F.col("category").alias("_c"), F.col("total").alias("_ys"), F.col("n").alias("_ns"))
    out = join_small(df.withColumn("_c", qcol(column).cast("string")), side, ["_c"], "left").withColumn("_p", prior)
    value = _shrunk(F.coalesce("_ys", F.lit(0.0)), F.coalesce("_ns", F.lit(0)), F.col("_p"), weight)
    # With weight 0 an unknown category has no statistics of its own.
    value = F.coalesce(value, F.col("_p"))
    return set_columns(out, {name or f"{column}_target": value}).select(*qcols(df.columns), qcol(name or f"{column}_target"))
