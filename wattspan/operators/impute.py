"""Filling missing values. Order-based fills need ``order_by`` ending in a unique column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import qcol, set_columns
from wattspan.operators.clean import drop_blank, drop_sparse, modes
from wattspan.operators.order import neighbours
from wattspan.operators.quantiles import quantile_row
from wattspan.operators.small import scalar_row


def _prev(c: str) -> Column:
    return qcol(f"{c}_prev").getField("val")


def _next(c: str) -> Column:
    return qcol(f"{c}_next").getField("val")


def _between(c: str) -> Column:
    """Straight line between the nearest values on both sides, by row distance."""
    p, n = qcol(f"{c}_prev"), qcol(f"{c}_next")
    share = F.try_divide(F.col("_g") - p.getField("at"), n.getField("at") - p.getField("at"))
    line = p.getField("val") + (n.getField("val") - p.getField("val")) * share
    return F.coalesce(qcol(c), line)


def _filled(df: DataFrame, exprs: dict[str, Column], helped: list[str]) -> DataFrame:
    helpers = [f"{c}_{side}" for c in helped for side in ("prev", "next")]
    return set_columns(df, exprs).drop("_g", *helpers)


def interpolate(df: DataFrame, cols: list[str], order_by: list[str], keys: list[str] = ()) -> DataFrame:
    """Interior gaps only; leading and trailing nulls stay."""
    near = neighbours(df, cols, order_by, keys)
    return _filled(near, {c: _between(c) for c in cols}, cols)


def forward_fill(df: DataFrame, cols: list[str], order_by: list[str], keys: list[str] = ()) -> DataFrame:
    near = neighbours(df, cols, order_by, keys)
    return _filled(near, {c: _prev(c) for c in cols}, cols)


def backward_fill(df: DataFrame, cols: list[str], order_by: list[str], keys: list[str] = ()) -> DataFrame:
    near = neighbours(df, cols, order_by, keys)
    return _filled(near, {c: _next(c) for c in cols}, cols)


def constant_fill(df: DataFrame, cols: list[str], value: float = 0) -> DataFrame:
    return set_columns(df, {c: F.coalesce(qcol(c), F.lit(value)) for c in cols})


def staged_fill(df: DataFrame, critical: str, interpolated: list[str], carried: list[str], order_by: list[str],
                keys: list[str] = (), max_nulls: int = 3) -> DataFrame:
    """Row filters, then interpolation, forward, backward and zero fill in one pass.

    After interpolation only the ends of a series are empty, so the fills that
    follow take the nearest value on the side that has one.
    """
    kept = drop_sparse(drop_blank(df, critical), max_nulls=max_nulls)
    near = neighbours(kept, [*interpolated, *carried], order_by, keys)
    exprs = {c: F.coalesce(_between(c), _prev(c), _next(c), F.lit(0.0)) for c in interpolated}
    exprs |= {c: F.coalesce(_prev(c), _next(c)) for c in carried}
    return _filled(near, exprs, [*interpolated, *carried])


def centre_fill(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Median for numbers, mode for text."""
    exprs = {}
    if numeric:
        medians = scalar_row(quantile_row(df, numeric, [0.5]))
        exprs |= {c: F.coalesce(qcol(c), medians.getField(f"{c}_q0")) for c in numeric}
    if categorical:
        mode_row = scalar_row(modes(df, categorical))
        exprs |= {c: F.coalesce(qcol(c), mode_row.getField(c)) for c in categorical}
    return set_columns(df, exprs)
