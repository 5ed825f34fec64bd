"""Duplicates. All forms aggregate before the shuffle, so a huge group of copies is cheap."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import qcol, qcols, require


def keep_one(df: DataFrame, subset: list[str] | None, order_by: list[str], keep: str = "first") -> DataFrame:
    """The first or last row per key by ``order_by``; without a key, per whole row."""
    if subset is None:
        return df.dropDuplicates()
    require(df, [*subset, *order_by])
    rest = [c for c in df.columns if c not in subset]
    at = F.struct(*qcols(order_by))
    pick = F.min_by if keep == "first" else F.max_by
    one = df.groupBy(*qcols(subset)).agg(pick(F.struct(*qcols(rest)), at).alias("_row"))
    return one.select(*[qcol(c) if c in subset else F.col("_row").getField(c).alias(c) for c in df.columns])


def keep_none(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drops every row that has a twin."""
    keys = df.columns if subset is None else subset
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.count(F.lit(1)).alias("_n")]
    if rest:
        aggs.append(F.first(F.struct(*qcols(rest))).alias("_row"))
    alone = df.groupBy(*qcols(keys)).agg(*aggs).filter("_n = 1")
    return alone.select(*[qcol(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def duplicate_report(df: DataFrame, name: str, subset: list[str] | None = None) -> DataFrame:
    """One row: duplicate rows, their share in percent, and distinct repeated patterns."""
    keys = df.columns if subset is None else subset
    require(df, keys)
    groups = df.groupBy(*qcols(keys)).agg(F.count(F.lit(1)).alias("_n"))
    twin = F.col("_n") > 1
    dup = F.coalesce(F.sum(F.when(twin, F.col("_n"))), F.lit(0))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return groups.agg(
        F.lit(name).alias("dataset"),
        total.alias("total_count"),
        dup.alias("duplicate_count"),
        F.when(total > 0, F.round(dup / total * 100, 2)).otherwise(F.lit(0.0)).alias("duplicate_pct"),
        F.count_if(twin).alias("duplicate_patterns"),
    )


def compare_duplicates(dirty: DataFrame, clean: DataFrame, subset: list[str]) -> DataFrame:
    """Exact and key-only duplicates of two data sets side by side."""
    label = f"Partial Duplicates ({', '.join(subset)})"
    parts = []
    for kind, keys in (("Exact Duplicates", None), (label, subset)):
        d = duplicate_report(dirty, "dirty", keys)
        c = duplicate_report(clean, "clean", keys)
        both = d.unionByName(c)
        side = lambda col, which: F.max(F.when(F.col("dataset") == which, F.col(col)))
        parts.append(
            both.agg(
                F.lit(kind).alias("type"),
                side("duplicate_count", "dirty").alias("dirty_count"),
                side("duplicate_pct", "dirty").alias("dirty_pct"),
                side("duplicate_count", "clean").alias("clean_count"),
                side("duplicate_pct", "clean").alias("clean_pct"),
            ).withColumn("difference", F.col("dirty_count") - F.col("clean_count"))
        )
    return parts[0].unionByName(parts[1])
