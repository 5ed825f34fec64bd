"""Decomposition, autocorrelation, packaging and rolling backtests of many series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wattspan.functions.columns import qcol, qcols, require
from wattspan.functions.metrics import metric_columns
from wattspan.operators.order import in_blocks, with_position
from wattspan.operators.small import checkpointed, join_small


def _series(df: DataFrame, keys: list[str], order_by: list[str], value: str, extra: list[str] = ()) -> DataFrame:
    """Values that are numbers with their 0-based position, which come from a checkpoint."""
    require(df, [*keys, *order_by, value, *extra])
    names = list(dict.fromkeys([*keys, *order_by, *extra]))
    known = df.select(*qcols(names), qcol(value).cast("double").alias("observed"))
    kept = known.filter("observed IS NOT NULL AND NOT isnan(observed)")
    return with_position(kept, order_by, keys, "pos")


def decompose(df: DataFrame, keys: list[str], order_by: list[str], value: str, period: int,
              block: int | None = None) -> DataFrame:
    """Classical additive decomposition per series.

    Trend is a centred moving average (two-step for even periods), null where
    the window is not full. Seasonal is the mean detrended value per phase,
    shifted to sum to zero. The reference method is a local regression; values
    differ, strengths are comparable.
    """
    if period < 2:
        raise ValueError("period must be at least 2")
    half = period // 2
    pos = _series(df, keys, order_by, value)
    blocked = in_blocks(pos, "pos", half, half, block)
    w = W.partitionBy(*qcols(keys), "_block").orderBy("pos")
    # Each frame is summed by itself: a difference of running sums would carry a spike through the whole block.
    lag, lead = F.lag("observed", half).over(w), F.lead("observed", half).over(w)
    if period % 2:
        total = F.sum("observed").over(w.rowsBetween(-half, half))
    else:
        inner = F.sum("observed").over(w.rowsBetween(1 - half, half - 1))
        total = inner + lag / 2 + lead / 2
    trend = F.when((F.col("pos") >= half) & lead.isNotNull(), total / period)
    trended = blocked.withColumn("trend", trend).filter("_home").drop("_home", "_block")
    trended = checkpointed(trended.withColumn("phase", (F.col("pos") % period).cast("int")))
    phases = trended.filter("trend IS NOT NULL").groupBy(*qcols(keys), "phase").agg(
        F.avg(F.col("observed") - F.col("trend")).alias("_raw")
    )
    # ``period`` rows per series.
    over_series = W.partitionBy(*qcols(keys))
    seasonal = phases.select(*qcols(keys), "phase", (F.col("_raw") - F.avg("_raw").over(over_series)).alias("seasonal"))
    out = join_small(trended, seasonal, [*keys, "phase"], "left")
    return out.withColumn("resid", F.col("observed") - F.col("trend") - F.col("seasonal"))


def _strength(resid: Column, other: Column) -> Column:
    total = F.var_pop(resid + other)
    return F.when(total == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.var_pop(resid) / total))


def strengths(decomposed: DataFrame, keys: list[str]) -> DataFrame:
    """Seasonal and trend strength, seasonal peak to trough, residual mean and sample deviation."""
    full = F.col("resid").isNotNull()
    s, t = (F.when(full, F.col(c)) for c in ("seasonal", "trend"))
    return decomposed.groupBy(*qcols(keys)).agg(
        F.count(F.lit(1)).alias("n"),
        _strength(F.col("resid"), s).alias("seasonal_strength"),
        _strength(F.col("resid"), t).alias("trend_strength"),
        (F.max("seasonal") - F.min("seasonal")).alias("seasonal_peak_to_trough"),
        F.avg("resid").alias("residual_mean"),
        F.stddev_samp("resid").alias("residual_std"),
    )


def seasonality_by_group(df: DataFrame, group: str, order_by: list[str], value: str, period: int,
                         decomposer: Callable[..., DataFrame] = decompose) -> DataFrame:
    """Strengths per group by any decomposer; a group shorter than two periods gets an error text instead."""
    kept = df.filter(qcol(group).isNotNull())
    out = strengths(decomposer(kept, [group], order_by, value, period), [group])
    short = F.col("n") < 2 * period
    measures = [c for c in out.columns if c not in (group, "n")]
    return out.select(
        qcol(group), "n", *[F.when(~short, F.col(c)).alias(c) for c in measures],
        F.when(short, F.lit(f"series is shorter than two periods of {period}")).alias("error"),
    )


def seasonal_pattern(decomposed: DataFrame, keys: list[str], period: int) -> DataFrame:
    """Mean seasonal value per phase over whole periods only."""
    sizes = decomposed.groupBy(*qcols(keys)).agg(F.count(F.lit(1)).alias("_n"))
    whole = join_small(decomposed, sizes, keys).filter(F.col("pos") < F.floor(F.col("_n") / period) * period)
    return whole.groupBy(*qcols(keys), F.col("phase").alias("period_index")).agg(
        F.avg("seasonal").alias("seasonal_value")
    )


def autocorrelation(df: DataFrame, keys: list[str], order_by: list[str], value: str, lags: int = 48,
                    block: int | None = None) -> DataFrame:
    """ACF to ``lags`` per series as long rows, with a 95 % band.

    The lagged values come from one sorted block with a halo of ``lags`` rows,
    so rows are neither joined to each other nor multiplied by the lags. The
    band uses the sum of squared earlier correlations.
    """
    pos = _series(df, keys, order_by, value)
    means = pos.groupBy(*qcols(keys)).agg(F.avg("observed").alias("_m"), F.count(F.lit(1)).alias("n"))
    centred = join_small(pos, means, keys).select(
        *qcols(keys), "pos", "n", (F.col("observed") - F.col("_m")).alias("x")
    )
    blocked = in_blocks(centred, "pos", lags, 0, block)
    w = W.partitionBy(*qcols(keys), "_block").orderBy("pos")
    lagged = blocked.select("*", *[F.lag("x", k).over(w).alias(f"_x{k}") for k in range(1, lags + 1)]).filter("_home")
    sums = lagged.groupBy(*qcols(keys)).agg(
        F.max("n").alias("n"), F.sum(F.col("x") * F.col("x")).alias("_s0"),
        *[F.sum(F.col("x") * F.col(f"_x{k}")).alias(f"_s{k}") for k in range(1, lags + 1)],
    )
    ratio = lambda k: F.when(F.col("_s0") > 0, F.coalesce(F.col(f"_s{k}"), F.lit(0.0)) / F.col("_s0"))
    structs = [F.struct(F.lit(k).alias("lag"), ratio(k).alias("acf")) for k in range(lags + 1)]
    long = sums.select(*qcols(keys), "n", F.inline(F.array(*structs))).filter(F.col("lag") < F.col("n"))
    # ``lags`` + 1 rows per series.
    earlier = W.partitionBy(*qcols(keys)).orderBy("lag").rowsBetween(W.unboundedPreceding, -1)
    squares = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(earlier)
    spread = F.sqrt((1 + 2 * F.coalesce(squares, F.lit(0.0))) / F.col("n"))
    return long.withColumn("band", F.when(F.col("lag") > 0, F.lit(1.959963984540054) * spread).otherwise(0.0))


def partial_autocorrelation(acf: DataFrame, keys: list[str]) -> DataFrame:
    """PACF by the Durbin-Levinson recursion on the ACF rows of each series, with a 95 % band.

    The autocorrelations have divisor n, so the recursion gives the Yule-Walker estimate without adjustment.
    """
    # ``lags`` + 1 values per series.
    ordered = F.array_sort(F.collect_list(F.struct("lag", "acf")))
    rows = acf.groupBy(*qcols(keys)).agg(F.max("n").alias("n"), F.transform(ordered, lambda x: x["acf"]).alias("_r"))
    add = lambda x, y: x + y
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), add)

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        # Autocorrelations of lags 1 to k - 1.
        earlier = F.slice("_r", F.lit(2), k - 1)
        below = 1.0 - dot(phi, earlier)
        last = F.when(below != 0, (F.get("_r", k) - dot(phi, F.reverse(earlier))) / below).otherwise(0.0)
        moved = F.zip_with(phi, F.reverse(phi), lambda p, q: p - last * q)
        return F.struct(F.concat(moved, F.array(last)).alias("phi"), F.concat(state["out"], F.array(last)).alias("out"))

    none = F.array().cast("array<double>")
    start = F.struct(none.alias("phi"), F.array(F.lit(1.0)).alias("out"))
    lags = F.filter(F.sequence(F.lit(0), F.size("_r") - 1), lambda k: k > 0)
    out = rows.select(*qcols(keys), "n", F.posexplode(F.aggregate(lags, start, step, lambda s: s["out"])).alias("lag", "pacf"))
    band = F.when(F.col("lag") > 0, F.lit(1.959963984540054) / F.sqrt("n")).otherwise(0.0)
    return out.select(*qcols(keys), "lag", "pacf", band.alias("band"))


def pack_series(df: DataFrame, keys: list[str], order_by: list[str], target: str, past: list[str] = (),
                future: list[str] = (), *, chunk: int, require_subset: bool = False) -> DataFrame:
    """Arrays of target and covariates per series, in order, as float.

    A record has at most ``chunk`` rows; a series is its records in the order of
    ``part``, which belongs to the key. The caller chooses the chunk.
    """
    require(df, [*keys, *order_by, target, *past, *future])
    if require_subset and not set(future) <= set(past):
        raise ValueError(f"future covariates must also be past covariates: {sorted(set(future) - set(past))}")
    names = list(dict.fromkeys([target, *past, *future]))
    cols = list(dict.fromkeys([*keys, *order_by, *names]))
    placed = with_position(df.select(*qcols(cols)), order_by, keys, "pos")
    point = F.struct("pos", *[qcol(c).cast("float").alias(c) for c in names])
    part = F.floor(F.col("pos") / chunk).cast("int").alias("part")
    rows = placed.groupBy(*qcols(keys), part).agg(F.array_sort(F.collect_list(point)).alias("_p"))
    pick = lambda c: F.transform("_p", lambda p: p.getField(c))
    as_map = lambda cs: F.create_map(*[x for c in cs for x in (F.lit(c), pick(c))]) if cs else \
        F.lit(None).cast("map<string,array<float>>")
    return rows.select(
        *qcols(keys), "part", pick(target).alias("target"),
        as_map(list(past)).alias("past_covariates"), as_map(list(future)).alias("future_covariates"),
    )


def packaging_stats(packed: DataFrame, keys: list[str]) -> DataFrame:
    """Series count, shortest, longest and mean length, and which covariates are there."""
    per = packed.groupBy(*qcols(keys)).agg(
        F.sum(F.size("target")).alias("_len"),
        F.max(F.col("past_covariates").isNotNull()).alias("_p"), F.max(F.col("future_covariates").isNotNull()).alias("_f"),
    )
    return per.agg(
        F.count(F.lit(1)).alias("n_series"), F.min("_len").alias("min_length"), F.max("_len").alias("max_length"),
        F.avg("_len").alias("avg_length"), F.max("_p").alias("has_past_covariates"),
        F.max("_f").alias("has_future_covariates"),
    )


def context_windows(df: DataFrame, keys: list[str], order_by: list[str], value: str, length: int = 512,
                    max_predictions: int | None = None, block: int | None = None) -> DataFrame:
    """For each row with a full past: the ``length`` values before it, oldest first."""
    pos = _series(df, keys, order_by, value)
    if max_predictions is not None:
        pos = pos.filter(F.col("pos") < length + max_predictions)
    blocked = in_blocks(pos, "pos", length, 0, block)
    w = W.partitionBy(*qcols(keys), "_block").orderBy("pos")
    ctx = F.collect_list("observed").over(w.rowsBetween(-length, -1))
    out = blocked.withColumn("context", ctx).filter("_home").filter(F.col("pos") >= length)
    return out.drop("_home", "_block")


def backtest(df: DataFrame, keys: list[str], order_by: list[str], value: str, length: int = 512, period: int = 24,
             max_predictions: int | None = None, block: int | None = None) -> DataFrame:
    """One-step forecasts of every row with a full past, as long rows (model, y, prediction).

    Forecasters: last value, value one period back, mean and median of the window.
    """
    if period > length:
        raise ValueError("period must not exceed the window length")
    ctx = context_windows(df, keys, order_by, value, length, max_predictions, block)
    c = F.col("context")
    ordered = F.array_sort(c)
    mid = lambda i: F.element_at(ordered, i)
    median = (mid((length + 1) // 2) + mid(length // 2 + 1)) / 2
    mean = F.aggregate(c, F.lit(0.0), lambda a, x: a + x) / length
    forms = {
        "last_value": F.element_at(c, -1), "seasonal_naive": F.element_at(c, -period),
        "window_mean": mean, "window_median": median,
    }
    structs = [F.struct(F.lit(n).alias("model"), e.alias("prediction")) for n, e in forms.items()]
    return ctx.select(*qcols(keys), "pos", F.col("observed").alias("y"), F.inline(F.array(*structs)))


def backtest_scores(backtested: DataFrame) -> DataFrame:
    return backtested.groupBy("model").agg(*metric_columns(F.col("y"), F.col("prediction")))
