"""Exact quantiles of many columns and groups without buffering a group in one task.

A bounded sketch brackets each wanted rank. A second pass counts rows: values
inside a bracket keep their identity, everything between brackets collapses to
one count. Running counts over that small histogram give the exact order
statistics. If a bracket misses its rank the pass repeats with a wider one, up
to the full range, so the result is exact in every case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from wattspan.functions.columns import qcol, qcols, require, rows_of, unpivot
from wattspan.operators.order import running
from wattspan.operators.small import checkpointed, join_settled, settled

ACCURACY = 10_000
# Half widths of the brackets, as shares of the rows, from narrow to everything.
MARGINS = (2.0 / ACCURACY, 0.01, 1.0)
# A bracket is used when its half width covers at least this many rows.
MIN_ROWS = 4
WINDOW_ROWS = 500_000


def _spec(probs, method: str) -> list[tuple[float, str]]:
    return [(float(p[0]), p[1]) if isinstance(p, tuple) else (float(p), method) for p in probs]


def exact_quantiles(df: DataFrame, cols: list[str], probs: list, by: list[str] = (), method: str = "linear",
                    window_rows: int | None = None) -> DataFrame:
    """One row per (by, column) with ``q0, q1, ...`` in the order of ``probs``, and ``n``.

    A prob is a number or (number, method). ``linear`` interpolates between the
    two ranks around ``q*(n-1)``; ``nearest`` takes rank ``round(q*(n-1))``, with
    halves rounded up. Nulls and NaN are left out.
    """
    by = list(by)
    require(df, [*cols, *by])
    spec = _spec(probs, method)
    numbers = df.select(*qcols(by), *[F.nullif(qcol(c).cast("double"), F.lit(float("nan"))).alias(c) for c in cols])
    limit = WINDOW_ROWS if window_rows is None else window_rows
    for level in range(len(MARGINS)):
        result = _attempt(numbers, by, cols, spec, level, limit)
        if result.filter("_missed").limit(1).count() == 0:
            break
    return result.drop("_missed")


def _attempt(numbers: DataFrame, by: list[str], cols: list[str], spec, level: int, window_rows: int) -> DataFrame:
    """One pass with brackets no narrower than ``level``; small groups take a wider one at once."""
    k, margins = len(spec), MARGINS[level:]
    ends = [max(0.0, min(1.0, q + side * m)) for m in margins for side in (-1, 1) for q, _ in spec]
    keys = [*by, "column"]
    # All columns are sketched in one scan of the wide rows.
    wide = numbers.groupBy(*qcols(by)).agg(
        *[F.count(qcol(c)).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.percentile_approx(qcol(c), ends, ACCURACY).alias(f"e{i}") for i, c in enumerate(cols)],
    )
    entries = [
        [("column", F.lit(c)), ("n", F.col(f"n{i}")), ("_ends", F.col(f"e{i}"))] for i, c in enumerate(cols)
    ]
    sketch, n_sketch = settled(rows_of(wide, entries, by).filter("n > 0"))
    long = unpivot(numbers, by, cols, "column", "value").filter("value IS NOT NULL")
    joined = join_settled(long, sketch, n_sketch, keys)
    pick = F.lit(len(margins) - 1)
    for j in reversed(range(len(margins) - 1)):
        pick = F.when(F.col("n") * margins[j] >= MIN_ROWS, j).otherwise(pick)
    joined = joined.withColumn("_at", pick * (2 * k))
    lo = [F.get("_ends", F.col("_at") + i) for i in range(k)]
    hi = [F.get("_ends", F.col("_at") + k + i) for i in range(k)]
    inside = F.lit(False)
    below = F.lit(float("-inf"))
    for i in range(k):
        inside = inside | F.col("value").between(lo[i], hi[i])
        below = F.greatest(below, F.when(hi[i] < F.col("value"), hi[i]))
    hist = (
        joined.select(
            *qcols(keys),
            F.when(inside, F.col("value")).otherwise(below).alias("rep"),
            F.when(inside, F.lit(0)).otherwise(F.lit(1)).alias("open"),
        )
        .groupBy(*qcols(keys), "rep", "open")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    hist, n_hist = settled(hist)
    if n_hist.rows <= window_rows:
        upto = W.partitionBy(*qcols(keys)).orderBy("rep", "open").rowsBetween(W.unboundedPreceding, 0)
        cum = hist.withColumn("c_cum", F.sum("c").over(upto))
    else:
        cum = running(hist, ["c"], ["rep", "open"], keys)
    cum = join_settled(cum, sketch.drop("_ends"), n_sketch, keys)
    start, end = F.col("c_cum") - F.col("c"), F.col("c_cum")
    aggs, missed = [], F.lit(False)
    for i, (q, how) in enumerate(spec):
        at = F.lit(q) * (F.col("n") - 1)
        at_lo = F.round(at) if how == "nearest" else F.floor(at)
        at_hi = at_lo if how == "nearest" else F.ceil(at)
        in_lo, in_hi = (start <= at_lo) & (at_lo < end), (start <= at_hi) & (at_hi < end)
        aggs += [
            F.max(F.when(in_lo, F.col("rep"))).alias(f"_lo{i}"),
            F.max(F.when(in_hi, F.col("rep"))).alias(f"_hi{i}"),
        ]
        missed = missed | ((F.col("open") == 1) & (in_lo | in_hi))
    picked = cum.groupBy(*qcols(keys)).agg(F.max("n").alias("n"), F.max(missed).alias("_missed"), *aggs)
    outs = []
    for i, (q, how) in enumerate(spec):
        part = F.lit(q) * (F.col("n") - 1)
        frac = part - F.floor(part)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        # Equal ranks may be infinite, where a difference is no number.
        between = F.when((frac == 0) | (low == high), low).otherwise(low + (high - low) * frac)
        outs.append((low if how == "nearest" else between).alias(f"q{i}"))
    return checkpointed(picked.select(*qcols(keys), "n", *outs, "_missed"))


def quantile_row(df: DataFrame, cols: list[str], probs: list, method: str = "linear") -> DataFrame:
    """The quantiles of ungrouped columns as one row: ``<column>_q<i>``."""
    long = exact_quantiles(df, cols, probs, (), method)
    return long.agg(
        *[
            F.max(F.when(F.col("column") == c, F.col(f"q{i}"))).alias(f"{c}_q{i}")
            for c in cols
            for i in range(len(probs))
        ]
    )



