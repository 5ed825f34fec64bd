"""Correlation and feature ranking."""

from __future__ import annotations

from functools import reduce
from operator import and_


from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import numeric_columns, qcol, qcols, require, rows_of
from wattspan.operators.gramian import pairwise_correlations
from wattspan.operators.quantiles import quantile_row
from wattspan.operators.small import scalar_row


def correlation(a: str, b: str) -> Column:
    """Pearson r over rows with both values; null when a column is constant.

    ``corr`` itself fails on a constant column in ANSI mode.
    """
    x, y = qcol(a).cast("double"), qcol(b).cast("double")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(correlation(a, b).alias("correlation"))


def correlations(df: DataFrame, target: str, features: list[str] | None = None) -> DataFrame:
    """Pearson r of every feature with the target in one scan, strongest first, nulls last."""
    require(df, [target])
    names = [c for c in (features or numeric_columns(df)) if c != target and c in df.columns]
    if not names:
        raise ValueError("No numeric features found")
    one = df.agg(*[correlation(c, target).alias(f"r{i}") for i, c in enumerate(names)])
    rows = rows_of(one, [[("feature", F.lit(c)), ("correlation", F.col(f"r{i}"))]
                         for i, c in enumerate(names)])
    ranked = rows.withColumn("abs_correlation", F.abs("correlation"))
    return ranked.orderBy(F.desc_nulls_last("abs_correlation"), "feature")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """All column pairs as (a, b, correlation); each pair is computed once."""
    pairs = pairwise_correlations(df, cols).drop("n")
    sides = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b"), "correlation") for x, y in ("ab", "ba")])
    itself = F.array(*[F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("correlation")) for c in cols])
    return pairs.select(F.inline(sides)).union(df.sparkSession.range(1).select(F.inline(itself)))


def top_correlated(df: DataFrame, target: str, n: int = 10, exclude: list[str] = ()) -> DataFrame:
    names = [c for c in numeric_columns(df) if c not in exclude and c != target]
    top = correlations(df, target, names).limit(n)
    return top.withColumn("sign", F.when(F.col("correlation") >= 0, "positive").otherwise("negative"))


def mutual_information(df: DataFrame, target: str, features: list[str] | None = None, bins: int = 10) -> DataFrame:
    """Mutual information in nats over equal-frequency bins; rows with a null are left out.

    Bin edges are exact inner quantiles, so equal values share a bin. Joint
    counts have at most features * bins * bins rows.
    """
    names = [c for c in (features or numeric_columns(df)) if c != target]
    require(df, [target, *names])
    known = reduce(and_, [qcol(c).isNotNull() & ~F.isnan(qcol(c)) for c in [*names, target]])
    full = df.select(*qcols([*names, target])).filter(known)
    probs = [k / bins for k in range(1, bins)]
    edges = scalar_row(quantile_row(full, [*names, target], probs, "nearest"))
    placed = full.withColumn("_e", edges)

    def bin_of(c: str):
        total = F.lit(0)
        for i in range(len(probs)):
            total = total + (qcol(c) > F.col("_e").getField(f"{c}_q{i}")).cast("int")
        return total

    binned = placed.select(bin_of(target).alias("_t"), *[bin_of(c).alias(c) for c in names])
    long = binned.unpivot(["_t"], qcols(names), "feature", "_f")
    joint = long.groupBy("feature", "_f", "_t").agg(F.count(F.lit(1)).alias("c"))
    fx = joint.groupBy("feature", "_f").agg(F.sum("c").alias("cx"))
    ty = joint.groupBy("feature", "_t").agg(F.sum("c").alias("cy"))
    total = joint.groupBy("feature").agg(F.sum("c").alias("n"))
    # Each side is bounded by features * bins rows.
    full_counts = (
        joint.join(F.broadcast(fx), ["feature", "_f"])
        .join(F.broadcast(ty), ["feature", "_t"])
        .join(F.broadcast(total), "feature")
    )
    term = F.col("c") / F.col("n") * F.log(F.col("c") * F.col("n") / (F.col("cx") * F.col("cy")))
    return full_counts.groupBy("feature").agg(F.sum(term).alias("mi_score")).orderBy(F.desc("mi_score"), "feature")


def top_features(scores: DataFrame, column: str, n: int = 10) -> DataFrame:
    if n <= 0:
        raise ValueError("n must be positive")
    require(scores, ["feature", column])
    return scores.orderBy(F.desc_nulls_last(qcol(column)), "feature").limit(n)


def compare_rankings(a: DataFrame, b: DataFrame, a_score: str, b_score: str, n: int = 10) -> DataFrame:
    """One row: features in both top-n lists, only in the first, only in the second, and the overlap."""
    in_a = top_features(a, a_score, n).select("feature", F.lit(True).alias("_a"))
    in_b = top_features(b, b_score, n).select("feature", F.lit(True).alias("_b"))
    both = in_a.join(in_b, "feature", "full_outer")
    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    # At most 2n names are collected.
    names = lambda cond: F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("feature")))), ",")
    return both.agg(
        names(has_a & has_b).alias("common_features"),
        names(has_a & ~has_b).alias("a_only"),
        names(~has_a & has_b).alias("b_only"),
        (F.count_if(has_a & has_b) / F.lit(n) * 100).alias("overlap_pct"),
        F.count_if(has_a & has_b).alias("n_common"),
        F.count_if(has_a & ~has_b).alias("n_a_only"),
        F.count_if(~has_a & has_b).alias("n_b_only"),
    )


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x."""
    return df.agg(
        F.regr_slope(qcol(y), qcol(x)).alias("slope"),
        F.regr_intercept(qcol(y), qcol(x)).alias("intercept"),
        F.regr_r2(qcol(y), qcol(x)).alias("r2"),
    )


