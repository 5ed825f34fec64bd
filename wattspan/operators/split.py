"""Splits, samples and folds in a seeded md5 order.

The order is a property of each row, so results do not depend on partitions.
md5 digests spread evenly: counting rows per digest prefix finds the prefix in
which a cut falls, only the rows of that prefix are ranked, and all other rows
are labelled by comparing digests. No stratum is ever gathered in one task.
Ids must be unique.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wattspan.functions.columns import numeric_columns, qcol, qcols, require
from wattspan.functions.hashing import seeded_md5, unit_interval
from wattspan.operators.order import row_at, with_position
from wattspan.operators.small import checkpointed, join_small, scalar_row

PREFIX_ROWS = 1_000_000
# Digits by which rows are counted before the prefix length is known.
FINE_PREFIX = 4


def prefix_length(rows: int) -> int:
    """Hex digits needed so that one digest prefix holds about ``PREFIX_ROWS`` rows."""
    return max(2, math.ceil(math.log(max(rows, 1) / PREFIX_ROWS, 16)))


def _prefix_counts(hashed: DataFrame, digest: str, by: list[str] = ()) -> tuple[DataFrame, int]:
    """Rows ``_c`` per stratum and digest prefix ``_pre``, with the prefix length, in one pass over the rows.

    The rows are counted by a finer prefix, at most 65,536 a stratum, and these counts are added up.
    """
    counted = lambda length: checkpointed(hashed.groupBy(
        *qcols(by), F.substring(qcol(digest), 1, length).alias("_pre")).agg(F.count(F.lit(1)).alias("_c")))
    fine = counted(FINE_PREFIX)
    length = prefix_length(fine.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0])
    if length > FINE_PREFIX:
        return counted(length), length
    short = F.substring("_pre", 1, length).alias("_pre")
    return fine.groupBy(*qcols(by), short).agg(F.sum("_c").alias("_c")), length


def _check_sizes(*sizes: float) -> None:
    if abs(sum(sizes) - 1.0) > 1e-8:
        raise ValueError(f"sizes must sum to 1, got {sum(sizes)}")


def equal_width_bin(df: DataFrame, target: str, bins: int, name: str = "_bin") -> DataFrame:
    """1-based equal-width bin of the target; the maximum falls in the last bin.

    Infinite values fall in the outer bins, null and NaN in bin 0, a bin of their own.
    """
    v = qcol(target).cast("double")
    known = v.isNotNull() & ~F.isnan(v)
    finite = F.when(known & (F.abs(v) < float("inf")), v)
    ends = scalar_row(df.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi")))
    out = df.withColumn("_ends", ends)
    lo, hi = F.col("_ends").getField("lo"), F.col("_ends").getField("hi")
    at = F.floor((v - lo) * F.lit(bins) / (hi - lo)) + 1
    place = F.when(v == float("inf"), bins).when(v == float("-inf"), 1).when(hi > lo, F.least(at, F.lit(bins))).otherwise(1)
    return out.withColumn(name, F.when(known, place).otherwise(0).cast("int")).drop("_ends")


def hash_cuts(df: DataFrame, digest: str, by: list[str], quotas: list[Column]) -> DataFrame:
    """Per stratum, the digest of the row at each quota: ``cut0, cut1, ...``.

    Quotas are row counts, written over ``_n``, the stratum's size. A quota below
    1 gives the empty string, which no digest is below.
    """
    counts, length = _prefix_counts(df, digest, by)
    prefix = F.substring(qcol(digest), 1, length).alias("_pre")
    # One row per prefix and stratum goes through these windows.
    stratum = W.partitionBy(*qcols(by)) if by else W.partitionBy()
    upto = stratum.orderBy("_pre").rowsBetween(W.unboundedPreceding, 0)
    summed = counts.withColumn("_cum", F.sum("_c").over(upto)).withColumn("_n", F.sum("_c").over(stratum))
    summed = checkpointed(summed)
    sizes = summed.groupBy(*qcols(by)).agg(F.max("_n").alias("_n"))
    hits = []
    for i, quota in enumerate(quotas):
        q = F.least(quota, F.col("_n"))
        hit = summed.filter((F.col("_cum") - F.col("_c") < q) & (q <= F.col("_cum")))
        hits.append(hit.select(*qcols(by), "_pre", F.lit(i).alias("_cut"), (q - F.col("_cum") + F.col("_c")).alias("_want")))
    wanted = hits[0]
    for h in hits[1:]:
        wanted = wanted.unionByName(h)
    keyed = df.select(*qcols(by), prefix, qcol(digest).alias("_d"))
    near = join_small(keyed, wanted, [*by, "_pre"])
    rank = F.row_number().over(W.partitionBy(*qcols(by), "_pre", "_cut").orderBy("_d"))
    at = near.withColumn("_rk", rank).filter(F.col("_rk") == F.col("_want"))
    cuts = at.groupBy(*qcols(by)).agg(
        *[F.max(F.when(F.col("_cut") == i, F.col("_d"))).alias(f"cut{i}") for i in range(len(quotas))]
    )
    out = join_small(sizes, cuts, by, "left") if by else sizes.withColumn("_x", scalar_row(cuts)).select("_n", "_x.*")
    return out.select(
        *qcols(by), "_n", *[F.coalesce(qcol(f"cut{i}"), F.lit("")).alias(f"cut{i}") for i in range(len(quotas))]
    )


def _with_cuts(df: DataFrame, id_col: str, seed: int, by: list[str], quotas: list[Column]) -> DataFrame:
    require(df, [id_col, *by])
    hashed = df.withColumn("_md5", seeded_md5(qcol(id_col), seed))
    cuts = hash_cuts(hashed.select("_md5", *qcols(by)), "_md5", by, quotas)
    if not by:
        row = scalar_row(checkpointed(cuts))
        out = hashed.withColumn("_cuts", row)
        return out.select(
            *qcols(hashed.columns), *[F.col("_cuts").getField(f"cut{i}").alias(f"cut{i}") for i in range(len(quotas))]
        )
    return join_small(hashed, cuts.drop("_n"), by)


def stratified_split(df: DataFrame, target: str, id_col: str, train: float = 0.70, val: float = 0.15,
                     test: float = 0.15, bins: int = 10, seed: int = 42, name: str = "split") -> DataFrame:
    """Adds the split label, with the shares kept in every stratum of the target.

    Strata are the equal-width bins of a number, and the values of any other type; null is a stratum of its own.
    """
    _check_sizes(train, val, test)
    require(df, [target])
    if target in numeric_columns(df):
        binned = equal_width_bin(df, target, bins)
    else:
        binned = df.withColumn("_bin", qcol(target))
    n = F.col("_n")
    cut = _with_cuts(binned, id_col, seed, ["_bin"], [F.round(n * train), F.round(n * (train + val))])
    label = F.when(F.col("_md5") <= F.col("cut0"), "train").when(F.col("_md5") <= F.col("cut1"), "val").otherwise("test")
    return cut.withColumn(name, label).drop("_md5", "_bin", "cut0", "cut1")


def temporal_split(df: DataFrame, date: str, id_col: str, train: float = 0.70, val: float = 0.15,
                   test: float = 0.15, name: str = "split") -> DataFrame:
    """Earliest rows to train, latest to test.

    The two boundary rows are selected by counts per slice, and only the slices that
    hold them are sorted; the table itself is labelled by comparison, without a shuffle.
    """
    _check_sizes(train, val, test)
    require(df, [date, id_col])
    first = F.floor(F.col("n") * F.lit(train))
    found = row_at(df.select(qcol(date), qcol(id_col)), [date, id_col], F.array(first, first + F.floor(F.col("n") * F.lit(val))))
    pair = F.struct(qcol(date).alias("c0"), qcol(id_col).alias("c1"))
    bounds = scalar_row(checkpointed(found.agg(
        *[F.max(F.when(F.col("place") == i, F.col("point"))).alias(k) for i, k in enumerate("ab")])))
    out = df.withColumn("_b", bounds)
    before = lambda k: F.coalesce(pair < F.col("_b").getField(k), F.lit(True))
    return out.withColumn(name, F.when(before("a"), "train").when(before("b"), "val").otherwise("test")).drop("_b")


def stratified_sample(df: DataFrame, stratum: str, id_col: str, size: int, seed: int = 42) -> DataFrame:
    """``int(size * share)`` rows of every stratum; rows without a stratum count in the total only."""
    total = df.agg(F.count(F.lit(1))).first()[0]
    quota = F.floor(F.lit(size) * (F.col("_n") / F.lit(total)))
    cut = _with_cuts(df.filter(qcol(stratum).isNotNull()), id_col, seed, [stratum], [quota])
    return cut.filter(F.col("_md5") <= F.col("cut0")).drop("_md5", "cut0")


def random_sample(df: DataFrame, id_col: str, size: int, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows, or all of a smaller table."""
    cut = _with_cuts(df, id_col, seed, [], [F.lit(size).cast("bigint")])
    return cut.filter(F.col("_md5") <= F.col("cut0")).drop("_md5", "cut0")


def stratum_distribution(df: DataFrame, stratum: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(qcol(stratum)).agg(F.count(F.lit(1)).alias("count")).withColumn("_t", total)
    return counts.select(qcol(stratum), "count", (F.col("count") / F.col("_t") * 100).alias("percentage"))


def hash_rank(df: DataFrame, id_col: str, seed: int, name: str = "rank") -> DataFrame:
    """0-based rank of every row in md5 order, counted per digest prefix."""
    return digest_rank(df.withColumn("_md5", seeded_md5(qcol(id_col), seed)), "_md5", name)


def digest_rank(hashed: DataFrame, digest: str, name: str = "rank") -> DataFrame:
    """0-based rank of every row by a column of digests, which is dropped."""
    sizes, length = _prefix_counts(hashed, digest)
    hashed = hashed.withColumn("_pre", F.substring(qcol(digest), 1, length))
    # One row per prefix goes through this window.
    before = W.partitionBy().orderBy("_pre").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_pre", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    here = F.row_number().over(W.partitionBy("_pre").orderBy(qcol(digest)))
    # The window has already placed the rows by prefix, so a shuffled join moves only the offsets.
    ranked = join_small(hashed.withColumn("_rn", here), offsets, ["_pre"])
    return ranked.withColumn(name, F.col("_off") + F.col("_rn") - 1).drop(digest, "_pre", "_rn", "_off")


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold numbers 0..k-1 whose sizes differ by at most one row."""
    ranked = hash_rank(df, id_col, seed, "_rank")
    return ranked.withColumn(name, (F.col("_rank") % k).cast("int")).drop("_rank")


def random_split(df: DataFrame, id_col: str, test: float = 0.2, val: float = 0.2, seed: int = 42,
                 name: str = "split") -> DataFrame:
    """Label from the digest as a number in [0, 1): no shuffle, sizes are approximate."""
    u = unit_interval(seeded_md5(qcol(id_col), seed))
    cut = 1.0 - test - val
    return df.withColumn(name, F.when(u < cut, "train").when(u < 1.0 - test, "val").otherwise("test"))
