"""Slice-based order operators against plain windows, with one series holding most rows."""

import random

import pytest
from pyspark.sql import Window as W, functions as F

from wattspan.operators import impute, order


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.5 else (None if rng.random() < 0.05 else f"k{rng.randint(0, 40)}")
        value = None if rng.random() < 0.4 or (key == "hot" and 300 < i < 900) else round(rng.uniform(0, 100), 2)
        rows.append((i, key, i // 3, value))
    return spark.createDataFrame(rows, "id long, key string, at long, v double").repartition(7).cache()


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("slices", [1, 5, 16])
def test_position(skewed, partitions, slices):
    partitions(slices)
    got = order.with_position(skewed, ["at", "id"], ["key"], "pos")
    want = skewed.withColumn("pos", F.row_number().over(W.partitionBy("key").orderBy("at", "id")) - 1)
    assert rows(got, "id", "pos") == rows(want, "id", "pos")
    whole = order.with_position(skewed, ["at", "id"], [], "pos")
    assert rows(whole, "id", "pos") == [(i, i) for i in sorted(range(3000), key=lambda i: repr((i, i)))]


@pytest.mark.parametrize("slices", [1, 5, 16])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_fills(skewed, partitions, slices, keys):
    partitions(slices)
    w = W.partitionBy(*keys).orderBy("at", "id")
    up, down = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    base = skewed.withColumn("rn", F.row_number().over(w)).select(
        "id", "rn", "v",
        F.last("v", True).over(up).alias("v0"), F.last(F.when(F.col("v").isNotNull(), F.col("rn")), True).over(up).alias("p0"),
        F.first("v", True).over(down).alias("v1"), F.first(F.when(F.col("v").isNotNull(), F.col("rn")), True).over(down).alias("p1"),
    )
    assert rows(impute.forward_fill(skewed, ["v"], ["at", "id"], keys), "id", "v") == rows(base.select("id", F.col("v0").alias("v")), "id", "v")
    assert rows(impute.backward_fill(skewed, ["v"], ["at", "id"], keys), "id", "v") == rows(base.select("id", F.col("v1").alias("v")), "id", "v")
    line = F.coalesce("v", F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("rn") - F.col("p0")) / (F.col("p1") - F.col("p0")))
    got = impute.interpolate(skewed, ["v"], ["at", "id"], keys).select("id", F.round("v", 8).alias("v"))
    assert rows(got, "id", "v") == rows(base.select("id", F.round(line, 8).alias("v")), "id", "v")


@pytest.mark.parametrize("slices", [1, 6])
def test_running(skewed, partitions, slices):
    partitions(slices)
    got = order.running(skewed.fillna(0, ["v"]), ["v"], ["at", "id"], ["key"], previous="at")
    w = W.partitionBy("key").orderBy("at", "id")
    want = skewed.fillna(0, ["v"]).select(
        "id", F.round(F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)), 6).alias("s"), F.lag("at").over(w).alias("b"))
    assert rows(got.select("id", F.round("v_cum", 6).alias("s"), F.col("at_before").alias("b")), "id", "s", "b") == rows(want, "id", "s", "b")


def test_blocks_cover_frames(skewed):
    pos = order.with_position(skewed, ["at", "id"], ["key"], "pos")
    cut = order.in_blocks(pos, "pos", 4, 2, block=10)
    w = W.partitionBy("key", "_block").orderBy("pos").rowsBetween(-4, 2)
    got = cut.withColumn("ids", F.collect_list("id").over(w)).filter("_home")
    plain = W.partitionBy("key").orderBy("pos").rowsBetween(-4, 2)
    want = pos.withColumn("ids", F.collect_list("id").over(plain))
    assert rows(got, "id", "ids") == rows(want, "id", "ids")


def test_staged_fill_literal(spark):
    data = [(1, "a", None, None), (2, "a", 1.0, 5), (3, "a", None, None), (4, "a", 3.0, 6), (5, " nan ", 9.0, 7), (6, "a", None, None)]
    df = spark.createDataFrame(data, "id long, date string, v double, nsm long")
    out = impute.staged_fill(df, "date", ["v"], ["nsm"], ["id"])
    assert rows(out, "id", "v", "nsm") == [(1, 1.0, 5), (2, 1.0, 5), (3, 2.0, 5), (4, 3.0, 6), (6, 3.0, 6)]
    assert out.columns == df.columns


def test_all_null_column_fills_with_zero(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None)], "id long, date string, v double")
    assert rows(impute.staged_fill(df, "date", ["v"], [], ["id"]), "id", "v") == [(1, 0.0), (2, 0.0)]
