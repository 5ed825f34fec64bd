"""Seasonal-trend decomposition by local regression (STL) of many series, of any length.

Each pass smooths the cycle-subseries, takes a low-pass of them away and smooths
the rest to a trend; robust passes weight each value by the bisquare of its
residual over six times the series' median residual. Local fits are weighted sums
over the nearest values, so a result depends on values within a fixed reach only.
A series is therefore worked on in blocks with a halo of that reach: blocks run by
themselves and give what one run over the whole series would. Only the medians are
taken over whole series, between passes, by exact distributed quantiles.

Python is used inside blocks (numpy on Arrow columns, blocks of equal length side by side): each fit needs dozens of
neighbours of every row, which expressions would hold as one array per row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import qcols
from wattspan.operators.order import in_blocks
from wattspan.operators.quantiles import exact_quantiles
from wattspan.operators.small import checkpointed, join_small, null_safe_join
from wattspan.operators.tseries import _series

POINTS = 8192
# Rows of all the blocks that one call takes, and series of equal length that are fitted side by side.
CALL_ROWS, SIDE_BY_SIDE = 65_536, 256


def _odd(n: int) -> int:
    return n + 1 - n % 2


def local_fits(y: np.ndarray, weights: np.ndarray, q: int, at: np.ndarray, whole) -> np.ndarray:
    """Local lines through the columns of ``y`` (n rows), by tricube weights of the ``q`` nearest rows, at places ``at``.

    Places may lie one beyond either end. A fit whose weights are all zero gives NaN. Where the weighted rows spread over
    less than a thousandth of the ``whole`` series, the line is level.
    """
    n = len(y)
    out = np.empty((len(at), y.shape[1]))
    width = min(q, n)
    step = max(1, POINTS // max(1, y.shape[1]))
    for lo in range(0, len(at), step):
        x = at[lo:lo + step]
        left = np.clip(x - (q - 1) // 2, 0, n - width)
        near = left[:, None] + np.arange(width)
        h = np.maximum(x - left, left + width - 1 - x) + max(q - n, 0) // 2
        far = np.abs(near - x[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            tricube = np.where(far <= 0.001 * h[:, None], 1.0, (1 - (far / h[:, None]) ** 3) ** 3)
            w = np.where(far <= 0.999 * h[:, None], tricube, 0.0)[:, :, None] * weights[near]
            w /= w.sum(axis=1, keepdims=True)
            centre = (w * near[:, :, None]).sum(axis=1)
            off = near[:, :, None] - centre[:, None, :]
            spread = (w * off * off).sum(axis=1)
            slope = np.where(np.sqrt(spread) > 0.001 * (np.asarray(whole) - 1), (x[:, None] - centre) / spread, 0.0)
        out[lo:lo + step] = (w * (1 + slope[:, None, :] * off) * y[near]).sum(axis=1)
    return out


def _smooth(y: np.ndarray, weights: np.ndarray, q: int, whole: np.ndarray) -> np.ndarray:
    """Fits at every row; where none is possible the value itself."""
    if len(y) < 2:
        return y.copy()
    fit = local_fits(y, weights, q, np.arange(len(y)), whole)
    return np.where(np.isnan(fit), y, fit)


def _cycles(y: np.ndarray, weights: np.ndarray, period: int, q: int, first: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Smoothed cycle-subseries, with one period more at both ends."""
    n, series = y.shape
    out = np.empty((n + 2 * period, series))
    for rows in {(n - 1 - j) // period + 1 for j in (0, min(period, n) - 1)}:
        phases = np.array([j for j in range(period) if (n - 1 - j) // period + 1 == rows])
        pick = np.arange(rows)[:, None] * period + phases
        # A column per phase and series.
        own = y[pick].reshape(rows, -1)
        all_rows = ((whole - 1 - (first + phases[:, None]) % period) // period + 1).ravel()
        fit = local_fits(own, weights[pick].reshape(rows, -1), q, np.arange(-1, rows + 1), all_rows)
        inside = np.where(np.isnan(fit[1:-1]), own, fit[1:-1])
        fit = np.concatenate([np.where(np.isnan(fit[:1]), inside[:1], fit[:1]), inside, np.where(np.isnan(fit[-1:]), inside[-1:], fit[-1:])])
        out[np.arange(rows + 2)[:, None] * period + phases] = fit.reshape(rows + 2, len(phases), series)
    return out


def _mean(y: np.ndarray, length: int) -> np.ndarray:
    """Moving means; each window is summed by itself, so that a spike stays in its windows."""
    return np.lib.stride_tricks.sliding_window_view(y, length, axis=0).mean(axis=-1)


def passes(y: np.ndarray, trend: np.ndarray, weights: np.ndarray, period: int, seasonal: int, trend_q: int, low_q: int,
           inner: int, first: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seasonal and trend after ``inner`` passes that start from ``trend``, a column per series.

    The rows of a column begin at its place ``first`` of ``whole``.
    """
    even = np.ones(y.shape)
    for _ in range(inner):
        cycles = _cycles(y - trend, weights, period, seasonal, first, whole)
        low = _smooth(_mean(_mean(_mean(cycles, period), period), 3), even, low_q, whole)
        season = cycles[period:-period] - low
        trend = _smooth(y - season, weights, trend_q, whole)
    return season, trend


def decompose_loess(df: DataFrame, keys: list[str], order_by: list[str], value: str, period: int, seasonal: int = 7,
                    trend: int | None = None, low_pass: int | None = None, robust: bool = True, inner: int | None = None,
                    outer: int | None = None, block: int | None = None) -> DataFrame:
    """Adds ``observed``, ``pos``, ``phase``, ``trend``, ``seasonal``, ``resid`` and the robustness ``weight`` per row.

    ``seasonal``, ``trend`` and ``low_pass`` are the odd lengths of the local fits; left out, the trend's is the next
    odd number over 1.5 period / (1 - 1.5 / seasonal) and the low-pass' the next one over the period. Robust: two inner
    passes and fifteen weighted rounds; otherwise five and none. Missing values and NaN are left out before the rest is
    numbered. A series shorter than two periods keeps its rows with null parts.
    """
    if period < 2 or seasonal < 3 or any(q is not None and q % 2 == 0 for q in (seasonal, trend, low_pass)):
        raise ValueError("period must be at least 2, and lengths odd")
    inner = inner if inner is not None else 2 if robust else 5
    outer = outer if outer is not None else 15 if robust else 0
    trend_q = trend or _odd(math.ceil(1.5 * period / (1 - 1.5 / seasonal)))
    low_q = low_pass or _odd(period + 1)
    # Subseries, moving means, low-pass and trend each look this far, pass by pass.
    reach = inner * ((seasonal // 2 + 1) * period + 2 + low_q // 2 + trend_q // 2)
    rows = _series(df, keys, order_by, value)
    sizes = rows.groupBy(*qcols(keys)).agg(F.count(F.lit(1)).alias("_n")).withColumn("_sid", F.monotonically_increasing_id())
    long_ = join_small(rows, sizes, keys).filter(F.col("_n") >= 2 * period)
    state = long_.select(*qcols(keys), "_sid", "pos", "_n", "observed", F.lit(0.0).alias("trend"), F.lit(1.0).alias("weight"))

    def run(table: pa.Table) -> pa.Table:
        """Many blocks, each sorted by place; those of equal length run side by side."""
        sid, block_, pos = (table.column(c).to_numpy() for c in ("_sid", "_block", "pos"))
        order = np.lexsort((pos, block_, sid))
        table, sid, block_, pos = table.take(pa.array(order)), sid[order], block_[order], pos[order]
        y, t, w, n = (table.column(c).to_numpy() for c in ("observed", "trend", "weight", "_n"))
        starts = np.flatnonzero(np.r_[True, (sid[1:] != sid[:-1]) | (block_[1:] != block_[:-1])])
        lengths = np.diff(np.r_[starts, len(sid)])
        season, smooth = np.empty(len(sid)), np.empty(len(sid))
        for length in np.unique(lengths):
            same = starts[lengths == length]
            for lo in range(0, len(same), SIDE_BY_SIDE):
                begin = same[lo:lo + SIDE_BY_SIDE]
                at = np.arange(length)[:, None] + begin
                season[at], smooth[at] = passes(y[at], t[at], w[at], period, seasonal, trend_q, low_q, inner, pos[begin], n[begin])
        cols = {c: table.column(c) for c in [*keys, "_sid", "pos", "_n", "observed"]}
        cols |= {"trend": pa.array(smooth), "seasonal": pa.array(season), "weight": table.column("weight")}
        return pa.table(cols).filter(table.column("_home"))

    # Blocks are dealt to calls, so that a call has many short series or few long blocks.
    total = state.count()
    calls = max(1, math.ceil(total / CALL_ROWS))
    fields = [state.schema[c] for c in [*keys, "_sid", "pos", "_n", "observed", "trend"]]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["seasonal double", "weight double"])
    for i in range(outer + 1):
        blocked = in_blocks(state, "pos", reach, reach, block).withColumn("_call", F.pmod(F.xxhash64("_sid", "_block"), F.lit(calls)))
        fitted = checkpointed(blocked.groupBy("_call").applyInArrow(run, schema))
        if i == outer:
            break
        off = F.abs(F.col("observed") - F.col("trend") - F.col("seasonal"))
        medians = exact_quantiles(fitted.withColumn("_r", off), ["_r"], [0.5], keys).select(*qcols(keys), (6 * F.col("q0")).alias("_h"))
        far = F.col("_r") / F.col("_h")
        weight = F.when(F.col("_r") <= 0.001 * F.col("_h"), 1.0).when(
            F.col("_r") <= 0.999 * F.col("_h"), (1 - far * far) * (1 - far * far)).otherwise(0.0)
        state = join_small(fitted.withColumn("_r", off), medians, keys).select(
            *qcols(keys), "_sid", "pos", "_n", "observed", "trend", weight.alias("weight"))
    parts = fitted.select(*qcols(keys), "pos", "trend", "seasonal", "weight")
    out = null_safe_join(rows, parts, [*keys, "pos"], "left").withColumn("phase", (F.col("pos") % period).cast("int"))
    return out.withColumn("resid", F.col("observed") - F.col("trend") - F.col("seasonal"))
