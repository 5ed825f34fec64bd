import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wattspan.functions import temporal as t
from wattspan.operators import corr, prep, quality, split, temporal


def test_hours_and_days(spark):
    df = spark.createDataFrame([(0,), (3600,), (43200,), (86399,), (86400,), (None,)], "NSM long")
    assert [r["hour"] for r in temporal.add_hour(df).collect()] == [0, 1, 12, 23, 23, None]
    assert temporal.add_hour(df, clamp=False).collect()[4]["hour"] == 24
    assert tuple(temporal.nsm_range(df).first()) == (0, 1)
    days = spark.createDataFrame([(d,) for d in ["Monday", "Friday", "Saturday", "Sunday", "Funday", None]], "Day_of_week string")
    assert [r["d"] for r in temporal.add_day_of_week(days, out="d").collect()] == [0, 4, 5, 6, None, None]
    assert temporal.unknown_days(days).first()[0] == 2
    with pytest.raises(ValueError):
        t.cyclical(F.col("x"), 0)
    with pytest.raises(ValueError):
        temporal.add_hour(days)


def test_all_temporal_features(spark):
    df = spark.createDataFrame([(3600, "Monday", 10.0), (43200, "Friday", 20.0), (72000, "Saturday", 30.0)], "NSM long, Day_of_week string, u double")
    out = temporal.add_temporal_features(df)
    rows = out.collect()
    assert [r["hour"] for r in rows] == [1, 12, 20] and [r["is_weekend"] for r in rows] == [False, False, True]
    assert all(r["cyclical_hour_sin"] ** 2 + r["cyclical_hour_cos"] ** 2 == pytest.approx(1) for r in rows)
    assert rows[0]["cyclical_day_cos"] == 1.0 and rows[0]["day_name"] == "Monday"
    assert quality.temporal_report(out).first()["valid"]
    assert not quality.temporal_report(out.drop("hour")).first()["valid"]
    assert not quality.temporal_report(out.withColumn("hour", F.lit(24))).first()["valid"]


def test_part_of_day_edges(spark):
    df = spark.range(24).select((F.col("id") * 3600).alias("NSM"))
    got = [r["time_of_day"] for r in temporal.add_day_parts(df).orderBy("NSM").collect()]
    assert got == ["night"] * 7 + ["morning"] * 6 + ["afternoon"] * 6 + ["evening"] * 5


def test_scaler_and_encoder(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 5.0, "b", "Weekday"), (3.0, 5.0, "a x", "Weekend"), (5.0, 5.0, "c", "Weekday")], "v double, k double, c string, w string")
    stages = prep.preprocessing(["v", "k"], ["c"], {"w": {"Weekday": 0, "Weekend": 1}})
    model = stages.fit(df)
    out = model.transform(df).collect()
    sd = math.sqrt(8 / 3)
    assert [r["v"] for r in out] == pytest.approx([-2 / sd, 0, 2 / sd]) and [r["k"] for r in out] == [0, 0, 0]
    assert [r["w"] for r in out] == [0, 1, 0] and [r["c_b"] for r in out] == [1, 0, 0] and [r["c_c"] for r in out] == [0, 0, 1]
    new = spark.createDataFrame([(1.0, 5.0, "zz", "Holiday")], df.schema)
    model.write().overwrite().save(str(tmp_path / "m"))
    row = PipelineModel.load(str(tmp_path / "m")).transform(new).first()
    assert (row["c_b"], row["c_c"], row["w"]) == (0, 0, None)
    assert prep.encoded_name("Load_Type", "Medium Load") == "Load_Type_Medium_Load"
    with pytest.raises(ValueError):
        prep.preprocessing(["v"], ["v"])
    with pytest.raises(ValueError):
        prep.CategoryEncoder(columns=["c"], maxCategories=2).fit(df)
    assert [r["c"] for r in prep.ordinal(df, "c", ["a x", "b"]).collect()] == [1, 0, None]
    assert prep.scaler_summary(model.stages[1], df).count() == 2


@pytest.fixture(scope="module")
def population(spark):
    return spark.range(4000).select("id", (F.col("id") * 7919 % 1000).cast("double").alias("y"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("s")).cache()


def test_stratified_split(population, partitions):
    seen = []
    for n in (1, 16):
        partitions(n)
        out = split.stratified_split(population, "y", "id")
        seen.append(sorted((r["id"], r["split"]) for r in out.select("id", "split").collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 4000
    counts = {k: sum(1 for _, s in seen[0] if s == k) for k in ("train", "val", "test")}
    assert abs(counts["train"] - 2800) <= 10 and abs(counts["val"] - 600) <= 10
    other = split.stratified_split(population, "y", "id", seed=7)
    assert sorted((r["id"], r["split"]) for r in other.select("id", "split").collect()) != seen[0]
    with pytest.raises(ValueError):
        split.stratified_split(population, "y", "id", 0.5, 0.1, 0.1)


def test_temporal_split_keeps_order(population):
    dup = population.withColumn("day", (F.col("id") / 1500).cast("int"))
    out = split.temporal_split(dup, "day", "id")
    got = out.groupBy("split").agg(F.count("*").alias("n"), F.min(F.struct("day", "id")).alias("a"), F.max(F.struct("day", "id")).alias("b"))
    r = {x["split"]: x for x in got.collect()}
    assert (r["train"]["n"], r["val"]["n"], r["test"]["n"]) == (2800, 600, 600)
    assert r["train"]["b"] < r["val"]["a"] and r["val"]["b"] < r["test"]["a"]


def test_samples_and_folds(population, spark):
    assert split.random_sample(population, "id", 123).count() == 123
    assert split.random_sample(population, "id", 10_000).count() == 4000
    assert split.random_sample(population, "id", 0).count() == 0
    s = split.stratified_sample(population, "s", "id", 400)
    per = {r["s"]: r["count"] for r in s.groupBy("s").count().collect()}
    n = {r["s"]: r["count"] for r in population.groupBy("s").count().collect()}
    assert per == {k: int(400 * (v / 4000)) for k, v in n.items() if int(400 * (v / 4000))}
    holes = population.withColumn("s", F.when(F.col("id") % 2 == 0, "a"))
    assert split.stratified_sample(holes, "s", "id", 100).groupBy("s").count().collect() == [("a", 50)]
    folds = [r["count"] for r in split.kfold(population, "id", 7).groupBy("fold").count().collect()]
    assert len(folds) == 7 and max(folds) - min(folds) <= 1
    dist = split.stratum_distribution(population, "s").agg(F.sum("percentage")).first()[0]
    assert dist == pytest.approx(100)
    assert split.prefix_length(10) == 2 and split.prefix_length(10**12) == 5


def test_long_prefix_gives_the_same_ranks(population, monkeypatch):
    a = {r["id"]: r["rank"] for r in split.hash_rank(population, "id", 1).collect()}
    monkeypatch.setattr(split, "PREFIX_ROWS", 1)
    b = {r["id"]: r["rank"] for r in split.hash_rank(population, "id", 1).collect()}
    assert a == b and sorted(a.values()) == list(range(4000))


def test_split_report_flags_leakage(spark):
    rows = [(i, float(i % 10), "train" if i < 70 else "val" if i < 85 else "test") for i in range(100)]
    shares = {"train": 0.7, "val": 0.15, "test": 0.15}
    ok = quality.split_report(spark.createDataFrame(rows, "id long, y double, split string"), "split", "y", shares, key_cols=["id"]).first()
    assert ok["no_leakage"] and ok["sizes_ok"]
    bad = quality.split_report(spark.createDataFrame(rows + [(0, 0.0, "test")], "id long, y double, split string"), "split", "y", shares, key_cols=["id"]).first()
    assert bad["train_test_overlap"] == 1 and not bad["valid"]


def test_rankings(spark):
    rows = [(1.0, 5.0, 2.0, 10.0, 7.0), (2.0, 4.0, 2.5, 20.0, 7.0), (3.0, 3.0, 3.0, 30.0, 7.0), (4.0, 2.0, 3.5, 40.0, 7.0), (5.0, 1.0, 4.0, 50.0, 7.0)]
    df = spark.createDataFrame(rows, "feature1 double, feature2 double, feature3 double, Usage_kWh double, flat double")
    out = corr.correlations(df, "Usage_kWh").collect()
    assert out[-1]["feature"] == "flat" and out[-1]["correlation"] is None
    assert {r["feature"]: round(r["correlation"], 9) for r in out[:3]} == {"feature1": 1.0, "feature2": -1.0, "feature3": 1.0}
    mi = corr.mutual_information(df, "Usage_kWh", bins=5).collect()
    assert all(r["mi_score"] >= 0 for r in mi) and mi[-1]["feature"] == "flat" and mi[-1]["mi_score"] == 0
    a = spark.createDataFrame([("x", 3.0), ("y", 2.0), ("z", 1.0)], "feature string, s double")
    b = spark.createDataFrame([("x", 3.0), ("w", 2.0), ("z", 1.0)], "feature string, s double")
    r = corr.compare_rankings(a, b, "s", "s", 2).first()
    assert (r["common_features"], r["a_only"], r["b_only"], r["overlap_pct"]) == ("x", "y", "w", 50.0)
    with pytest.raises(ValueError):
        corr.top_features(a, "s", 0)
    with pytest.raises(ValueError):
        corr.correlations(df, "nope")


def test_rows_that_share_order_and_line_stay_apart(spark, tmp_path):
    """Residuals of two items with one order and line number are not merged."""
    from wattspan.plans.queries import QUERIES

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(50)
    li = li.withColumn("l_orderkey", F.lit(1).cast(li.schema["l_orderkey"].dataType)).withColumn(
        "l_linenumber", F.lit(1).cast(li.schema["l_linenumber"].dataType))
    li.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {(r.a, r.b): r.correlation for r in QUERIES["m8_residual_correlation"](spark, str(tmp_path)).collect()}
    rows = li.select("l_extendedprice", "l_quantity").toPandas()
    flat, rate = rows.l_extendedprice - 30000, rows.l_extendedprice - 1500 * rows.l_quantity
    assert abs(got["flat", "rate"] - flat.corr(rate)) < 1e-6


def test_five_thousand_categories(spark):
    df = spark.range(5000).selectExpr("id", "CASE WHEN id > 0 THEN concat('c', lpad(CAST(id AS STRING), 5, '0')) END AS c")
    out = prep.index_categories(df, prep.category_table(df, ["c"]), ["c"])
    assert [r.c_index for r in out.orderBy("id").collect()] == [None, *range(4999)]
