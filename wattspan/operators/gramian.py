"""Correlations of many columns at once, by blocked matrix products over present values.

With a matrix X of centred values (0 where a value is missing) and a mask M of
present ones, X'X, X'M, (X*X)'M and M'M hold all sums that the correlations of
rows with both values need. A task adds up these products for one block of
columns against another, so its memory depends on the block alone; the partial
sums of all tasks are added per row of the matrix. Code and plan have the same
size for any number of columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import qcol, require

BLOCK = 512
# A pair's values of a column are constant if their spread is this small a part of their squares: what rounding leaves.
CONSTANT = 1e-12
SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy", "n_infinite"]


def _products(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...]) -> np.ndarray:
    """The sums of all pairs of two blocks, one matrix per name in ``SUMS``."""
    (x, mx, ix), (y, my, iy) = left, right
    return np.stack([mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y, ix.T @ (my + iy) + mx.T @ iy])


def _parts(batch: pa.RecordBatch, at: list[int]) -> tuple[np.ndarray, ...]:
    """Values, mask of finite ones, and mask of infinite ones."""
    raw = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in at], axis=1)
    finite = np.isfinite(raw)
    return np.where(finite, raw, 0.0), finite.astype(np.float64), np.isinf(raw).astype(np.float64)


def _block_sums(centred: DataFrame, rows: list[int], cols: list[int]) -> DataFrame:
    """``i``, ``j`` and the sums of each pair of two blocks of columns."""
    used = list(dict.fromkeys([*rows, *cols]))
    place = {c: k for k, c in enumerate(used)}
    at_rows, at_cols = [place[c] for c in rows], [place[c] for c in cols]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                left = _parts(batch, at_rows)
                here = _products(left, left if at_rows == at_cols else _parts(batch, at_cols))
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(rows, pa.int64()), "sums": [np.ascontiguousarray(total[:, k]).tobytes() for k in range(len(rows))]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column("i").to_pylist(), batch.column("sums")):
                part = np.frombuffer(part.as_py()).reshape(len(SUMS), len(cols))
                held[i] = held[i] + part if i in held else part
        for i, total in held.items():
            yield pa.RecordBatch.from_pydict({
                "i": np.full(len(cols), i), "j": np.array(cols), **{name: total[k] for k, name in enumerate(SUMS)}})

    partial = centred.select(*[f"c{i}" for i in used]).mapInArrow(add, "i bigint, sums binary")
    return partial.repartition("i").mapInArrow(merge, "i bigint, j bigint, " + ", ".join(f"{name} double" for name in SUMS))


def _correlation() -> Column:
    """Pearson r from the sums; null when either side is constant, NaN when an infinite value takes part."""
    n = F.col("n")
    spread = lambda s, ss: F.col(ss) - F.col(s) * F.col(s) / n
    vx, vy = spread("sx", "sxx"), spread("sy", "syy")
    varies = (vx > F.col("sxx") * CONSTANT) & (vy > F.col("syy") * CONSTANT)
    r = (F.col("sxy") - F.col("sx") * F.col("sy") / n) / (F.sqrt(vx) * F.sqrt(vy))
    return F.when(F.col("n_infinite") > 0, F.lit(float("nan"))).when(
        (n > 0) & varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pairwise_correlations(df: DataFrame, cols: list[str], block: int = BLOCK) -> DataFrame:
    """(a, b, n, correlation) of each two columns in the order of ``cols``, over the rows that have both values.

    Nulls and NaN are missing. A pair without rows, or with a constant side, has a null correlation; an infinite value
    beside a present one makes it NaN. The input is read once for the means and once per pair of column blocks.
    """
    require(df, cols)
    if len(set(cols)) != len(cols):
        raise ValueError("columns must differ")
    wide = df.select(*[qcol(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    finite = lambda c: F.when(F.abs(F.col(c)) < float("inf"), F.col(c))
    # One number per column reaches the driver; centred values keep the sums exact enough.
    means = wide.agg(*[F.avg(finite(c)).alias(c) for c in wide.columns]).first() if cols else {}
    centred = wide.select(*[(F.col(c) - F.lit(means[c] or 0.0)).alias(c) for c in wide.columns])
    starts = range(0, len(cols), block)
    sums = None
    for a in starts:
        for b in starts:
            if a <= b:
                own = lambda s: list(range(s, min(s + block, len(cols))))
                part = _block_sums(centred, own(a), own(b))
                sums = part if sums is None else sums.union(part)
    spark, k = df.sparkSession, len(cols)
    # Every pair has a row, also over an empty table.
    pairs = spark.range(k * k).select(F.floor(F.col("id") / max(k, 1)).alias("i"), F.pmod("id", F.lit(max(k, 1))).alias("j")).filter("i < j")
    name = lambda c: F.get(F.array(*[F.lit(x) for x in cols]).cast("array<string>"), F.col(c).cast("int"))
    if sums is None:
        return pairs.select(name("i").alias("a"), name("j").alias("b"), F.lit(0).cast("bigint").alias("n"),
                            F.lit(None).cast("double").alias("correlation"))
    found = pairs.join(sums, ["i", "j"], "left")
    return found.select(name("i").alias("a"), name("j").alias("b"), F.coalesce("n", F.lit(0.0)).cast("bigint").alias("n"),
                        _correlation().alias("correlation"))
