"""Drift of a current data set against a reference: per column, per data set, alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import qcol, qcols, require, unpivot
from wattspan.functions.gamma import chi_square_p_value
from wattspan.operators.order import running
from wattspan.operators.small import checkpointed

# Thresholds of the monitoring configuration.
PSI_THRESHOLD = 0.2
KS_P_THRESHOLD = 0.05
WASSERSTEIN_THRESHOLD = 0.1
JS_THRESHOLD = 0.1
DATASET_SHARE = 0.5
DRIFT_SCORE = 0.7
FEATURE_SCORE = 0.5
RMSE_DEGRADATION = 0.15
WARNING_FACTOR = 0.7
MIN_SHARE = 1e-4
LEAST_EXPECTED = 5.0
CHI_SQUARE_P_THRESHOLD = 0.05


def numeric_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per column and distinct value; null and NaN are left out."""
    known = unpivot(df, [], cols, "column", "value").filter("value IS NOT NULL AND NOT isnan(value)")
    return known.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per column and distinct text; null is left out."""
    long = df.select(*[qcol(c).cast("string").alias(c) for c in cols]).unpivot([], qcols(cols), "column", "category")
    return long.filter("category IS NOT NULL").groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Reference:
    """Counts of a reference, settled once for many comparisons."""

    numeric: DataFrame | None
    categorical: DataFrame | None


def settle_reference(reference: DataFrame, numeric: list[str], categorical: list[str]) -> Reference:
    require(reference, [*numeric, *categorical])
    return Reference(checkpointed(numeric_counts(reference, numeric)) if numeric else None,
                     checkpointed(category_counts(reference, categorical)) if categorical else None)


def _side(rows: DataFrame | Reference, cols: list[str], kind: str) -> DataFrame:
    """Counts of one side, settled before or counted here."""
    if isinstance(rows, Reference):
        return getattr(rows, kind).filter(F.col("column").isin(cols))
    require(rows, cols)
    return (numeric_counts if kind == "numeric" else category_counts)(rows, cols)


def _counted(reference: DataFrame | Reference, current: DataFrame | Reference, cols: list[str], kind: str) -> DataFrame:
    """Counts of both sides (``a``, ``b``) per column and value."""
    none = F.lit(0).cast("bigint")
    both = _side(reference, cols, kind).withColumn("b", none).withColumnRenamed("n", "a").unionByName(
        _side(current, cols, kind).withColumn("a", none).withColumnRenamed("n", "b"))
    value = "value" if kind == "numeric" else "category"
    return checkpointed(both.groupBy("column", value).agg(F.sum("a").alias("a"), F.sum("b").alias("b")))


def _psi(a: Column, na: Column, b: Column, nb: Column) -> Column:
    pa = F.greatest(F.try_divide(a, na), F.lit(MIN_SHARE))
    pb = F.greatest(F.try_divide(b, nb), F.lit(MIN_SHARE))
    return F.sum((pb - pa) * F.log(pb / pa))


def ks_p_value(d: Column, na: Column, nb: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    en = F.sqrt(na * nb / (na + nb))
    lam = (en + 0.12 + F.try_divide(F.lit(0.11), en)) * d
    ks = F.sequence(F.lit(1), F.lit(terms))
    sign = lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0)
    total = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + sign(k) * F.exp(-2.0 * k * k * lam * lam))
    # The series does not converge near zero, where the probability is one.
    return F.when(lam.isNull(), None).when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * total)))


def numeric_drift(reference: DataFrame | Reference, current: DataFrame | Reference, cols: list[str], bins: int = 10,
                  test: str = "wasserstein") -> DataFrame:
    """PSI, Kolmogorov-Smirnov and normalised Wasserstein distance per numeric column.

    Both sides are counted per distinct value before any ordering. PSI uses equal
    widths over the reference range with open outer bins; Wasserstein is in
    reference standard deviations. ``test`` names the measure that judges; all are
    reported. A column that is empty on one side has no distance and counts as
    drifted.
    """
    if test not in ("psi", "ks", "wasserstein"):
        raise ValueError(f"unknown test {test}")
    counts = _counted(reference, current, cols, "numeric")
    v, a = F.col("value"), F.col("a")
    mean = F.try_divide(F.sum(v * a), F.sum("a"))
    first = counts.groupBy("column").agg(
        F.sum("a").alias("n_ref"), F.sum("b").alias("n_cur"), mean.alias("_mean"),
        F.min(F.when(a > 0, v)).alias("_lo"), F.max(F.when(a > 0, v)).alias("_hi"),
    )
    # One row per column, here and below.
    spread = counts.join(F.broadcast(first), "column").groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum((v - F.col("_mean")) ** 2 * a), F.max("n_ref"))).alias("_std")
    )
    facts = first.join(F.broadcast(spread), "column")
    placed = counts.join(F.broadcast(facts), "column")
    share = (v - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    index = F.when(F.col("_hi") > F.col("_lo"), F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(share * bins))))
    binned = placed.groupBy("column", F.coalesce(index, F.lit(0)).alias("bin")).agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur")
    )
    # Bins that both sides leave empty add nothing.
    psi = binned.groupBy("column").agg(_psi(F.col("a"), F.col("n_ref"), F.col("b"), F.col("n_cur")).alias("psi"))
    cum = running(counts, ["a", "b"], ["value"], ["column"], previous="value")
    cum = cum.join(F.broadcast(facts), "column")
    gap = F.try_divide("a_cum", "n_ref") - F.try_divide("b_cum", "n_cur")
    gap_before = F.try_divide(F.col("a_cum") - a, F.col("n_ref")) - F.try_divide(F.col("b_cum") - F.col("b"), F.col("n_cur"))
    dist = cum.groupBy("column").agg(
        F.max(F.abs(gap)).alias("ks"),
        F.sum(F.abs(gap_before) * (v - F.col("value_before"))).alias("_w"),
        F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"), F.max("_std").alias("_std"),
    )
    out = dist.join(F.broadcast(psi), "column").select(
        "column", "n_ref", "n_cur", "psi", "ks", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")).alias("ks_p"),
        (F.when(F.col("ks").isNotNull(), F.coalesce("_w", F.lit(0.0))) / F.greatest(F.col("_std"), F.lit(0.001))).alias("wasserstein"),
    )
    by = {
        "psi": (F.col("psi"), F.col("psi") >= PSI_THRESHOLD),
        "ks": (F.col("ks_p"), F.col("ks_p") < KS_P_THRESHOLD),
        "wasserstein": (F.col("wasserstein"), F.col("wasserstein") >= WASSERSTEIN_THRESHOLD),
    }
    score, drifted = by[test]
    return out.select("*", score.alias("drift_score"), F.coalesce(drifted, F.lit(True)).alias("drifted"))


def categorical_drift(reference: DataFrame | Reference, current: DataFrame | Reference, cols: list[str], test: str = "js") -> DataFrame:
    """PSI, Jensen-Shannon distance and chi-square statistic per text column.

    ``test`` names the measure that judges.
    """
    if test not in ("psi", "js"):
        raise ValueError(f"unknown test {test}")
    counts = _counted(reference, current, cols, "categorical")
    totals = counts.groupBy("column").agg(F.sum("a").alias("n_ref"), F.sum("b").alias("n_cur"))
    # One row per column.
    placed = counts.join(F.broadcast(totals), "column")
    a, b, na, nb = (F.col(c) for c in ("a", "b", "n_ref", "n_cur"))
    pa, pb = F.try_divide(a, na), F.try_divide(b, nb)
    m = (pa + pb) / 2
    part = lambda p: F.when(p > 0, p * F.log(p / m)).otherwise(0.0)
    expected = F.when(a > 0, pa * nb)
    out = placed.groupBy("column").agg(
        F.max(na).alias("n_ref"), F.max(nb).alias("n_cur"), _psi(a, na, b, nb).alias("psi"),
        F.when((F.max(na) > 0) & (F.max(nb) > 0), F.sqrt(F.greatest(F.lit(0.0), F.sum(part(pa) + part(pb)) / 2)))
        .alias("js"),
        F.sum((b - expected) * (b - expected) / expected).alias("chi_square"),
        (F.count(F.lit(1)) - 1).alias("degrees"),
    )
    by = {"psi": (F.col("psi"), F.col("psi") >= PSI_THRESHOLD), "js": (F.col("js"), F.col("js") >= JS_THRESHOLD)}
    score, drifted = by[test]
    return out.select("*", score.alias("drift_score"), F.coalesce(drifted, F.lit(True)).alias("drifted"))


def chi_square_test(reference: DataFrame | Reference, current: DataFrame | Reference, cols: list[str],
                    least: float = LEAST_EXPECTED) -> DataFrame:
    """Chi-square test per text column of the current counts against the reference's shares, with its p-value.

    Categories expected fewer than ``least`` times, those unknown to the reference included, are one cell. If that cell
    holds unknown categories alone, nothing is expected in it: its rows are evidence enough (p 0, statistic null). Fewer
    than two cells, or a side without values, give a null p-value.
    """
    counts = _counted(reference, current, cols, "categorical")
    totals = counts.groupBy("column").agg(F.sum("a").alias("n_ref"), F.sum("b").alias("n_cur"))
    # One row per column.
    placed = counts.join(F.broadcast(totals), "column")
    placed = placed.withColumn("expected", F.try_divide(F.col("a") * F.col("n_cur"), F.col("n_ref")))
    small = F.coalesce(F.col("expected") < least, F.lit(True))
    e, b = F.coalesce("expected", F.lit(0.0)), F.col("b")
    sums = placed.groupBy("column").agg(
        F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"), F.count_if(~small).alias("large"),
        F.count_if(small).alias("n_pooled"), F.sum(F.when(~small, (b - e) * (b - e) / e)).alias("known"),
        F.sum(F.when(small, e).otherwise(0.0)).alias("pool_e"), F.sum(F.when(small, b).otherwise(0)).alias("pool_b"))
    pool_e, pool_b = F.col("pool_e"), F.col("pool_b")
    new = (pool_e == 0) & (pool_b > 0)
    sides = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    pooled = F.when(pool_e > 0, (pool_b - pool_e) * (pool_b - pool_e) / pool_e).otherwise(0.0)
    out = sums.select(
        "column", "n_ref", "n_cur", "n_pooled",
        F.when(sides & ~new, F.coalesce("known", F.lit(0.0)) + pooled).alias("chi_square"),
        (F.col("large") + (F.col("n_pooled") > 0).cast("bigint") - 1).alias("degrees"), (sides & new).alias("new"))
    p = F.when(F.col("degrees") > 0, F.when(F.col("new"), 0.0).otherwise(chi_square_p_value(F.col("chi_square"), F.col("degrees"))))
    return out.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < CHI_SQUARE_P_THRESHOLD).drop("new")


def column_drift(reference: DataFrame | Reference, current: DataFrame | Reference, numeric: list[str], categorical: list[str],
                 numeric_test: str = "wasserstein", categorical_test: str = "js") -> DataFrame:
    """Both kinds of column in one report (column, kind, drift_score, drifted)."""
    parts = []
    if numeric:
        parts.append(numeric_drift(reference, current, numeric, test=numeric_test).select(
            "column", F.lit("numeric").alias("kind"), "drift_score", "drifted"))
    if categorical:
        parts.append(categorical_drift(reference, current, categorical, test=categorical_test).select(
            "column", F.lit("categorical").alias("kind"), "drift_score", "drifted"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def dataset_drift(columns: DataFrame) -> DataFrame:
    """One row: drifted columns, their share, the verdict and a map of their scores."""
    # One entry per column of the data set.
    entries = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct("column", "drift_score"))))
    share = F.avg(F.col("drifted").cast("double"))
    return columns.agg(
        F.count(F.lit(1)).alias("number_of_features"),
        F.count_if("drifted").alias("number_of_drifted_features"),
        share.alias("share_of_drifted_features"),
        (share > DATASET_SHARE).alias("dataset_drift"),
        share.alias("drift_score"),
        F.map_from_entries(entries).alias("drifted_features"),
    )


def drifted_features(columns: DataFrame, threshold: float = FEATURE_SCORE) -> DataFrame:
    """Drifted columns with a score of at least the threshold, highest first."""
    kept = columns.filter(F.col("drifted") & (F.col("drift_score") >= threshold))
    return kept.select("column", "drift_score").orderBy(F.desc("drift_score"), "column")


def alert(run: DataFrame, reference_rmse: float | None = None, drift_score: float = DRIFT_SCORE, share: float = 0.5,
          degradation: float = RMSE_DEGRADATION, feature_score: float = FEATURE_SCORE) -> DataFrame:
    """Adds RMSE degradation, severity and the features to name in an alert.

    Warnings start at 70 % of the drift limits; degradation only raises CRITICAL.
    """
    zero = F.lit(0.0)
    has = set(run.columns)
    rmse = F.coalesce(F.col("rmse"), zero) if "rmse" in has else zero
    stored = F.coalesce(F.col("rmse_degradation"), zero) if "rmse_degradation" in has else zero
    worse = stored
    if reference_rmse:
        worse = F.when(rmse > 0, (rmse - reference_rmse) / F.lit(reference_rmse)).otherwise(stored)
    score, part = F.coalesce("drift_score", zero), F.coalesce("share_of_drifted_features", zero)
    out = run.withColumn("performance_degradation", worse)
    critical = (score >= drift_score) | (part >= share) | (F.col("performance_degradation") >= degradation)
    warning = (score >= drift_score * WARNING_FACTOR) | (part >= share * WARNING_FACTOR)
    severity = F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("INFO")
    out = out.withColumn("severity", severity)
    if "drifted_features" in has:
        named = F.map_filter("drifted_features", lambda k, v: v >= feature_score)
        text = F.transform(F.map_entries(named), lambda e: F.format_string("%s: %.3f", e["key"], e["value"]))
        out = out.withColumn("alert_features", text)
    return out
