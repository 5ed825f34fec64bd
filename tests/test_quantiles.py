import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.operators import drift, outliers, quantiles, small


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 10.0, 30_000), 1)
    vals[:10_000] = 7.5
    groups = np.where(rng.random(30_000) < 0.7, "big", np.where(rng.random(30_000) < 0.99, "mid", "tiny"))
    rows = [(str(g), float(v), float(v * v)) for g, v in zip(groups, vals)]
    return rows, spark.createDataFrame(rows, "g string, a double, b double").repartition(5).cache()


def nearest(x, q):
    x = np.sort(x)
    return x[int(np.floor(q * (len(x) - 1) + 0.5))]


@pytest.mark.parametrize("window_rows", [None, 0])
def test_exact_by_group(data, window_rows):
    rows, df = data
    qs = [0.0, 0.01, 0.25, 0.5, 0.753, 0.99, 1.0]
    out = quantiles.exact_quantiles(df, ["a", "b"], [*qs, (0.25, "nearest"), (0.5, "nearest")], ["g"], window_rows=window_rows)
    seen = 0
    for r in out.collect():
        x = np.array([v[1 if r["column"] == "a" else 2] for v in rows if v[0] == r["g"]])
        assert r["n"] == len(x)
        for i, q in enumerate(qs):
            assert r[f"q{i}"] == pytest.approx(np.quantile(x, q), rel=1e-12), (r["g"], q)
        assert r[f"q{len(qs)}"] == nearest(x, 0.25) and r[f"q{len(qs) + 1}"] == nearest(x, 0.5)
        seen += 1
    assert seen == 6


def test_missed_bracket_widens(data, monkeypatch):
    rows, df = data
    monkeypatch.setattr(quantiles, "MARGINS", (0.0, 1.0))
    monkeypatch.setattr(quantiles, "MIN_ROWS", 0)
    monkeypatch.setattr(quantiles, "ACCURACY", 10)
    out = quantiles.exact_quantiles(df, ["b"], [0.3, 0.9]).first()
    x = np.array([v[2] for v in rows])
    assert [out["q0"], out["q1"]] == pytest.approx(list(np.quantile(x, [0.3, 0.9])))


def test_single_row_nulls_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (4.0,)], "v double")
    r = quantiles.exact_quantiles(df, ["v"], [0.0, 0.5, 1.0]).first()
    assert (r["n"], r["q0"], r["q1"], r["q2"]) == (1, 4.0, 4.0, 4.0)


def test_cap_and_remove(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(1e6,), (None,)], "v double")
    cap = outliers.treat_outliers(df, ["v"], "cap", 0.05, 0.95)
    hi, lo = nearest(np.array([*range(100), 1e6]), 0.95), nearest(np.array([*range(100), 1e6]), 0.05)
    row = cap.agg(F.max("v").alias("hi"), F.min("v").alias("lo"), F.count_if(F.isnull("v")).alias("n")).first()
    assert (row["hi"], row["lo"], row["n"]) == (hi, lo, 1)
    gone = outliers.treat_outliers(df, ["v"], "remove", 0.05, 0.95)
    assert gone.count() == 102 and gone.filter("v > 95").count() == 0
    with pytest.raises(ValueError):
        outliers.treat_outliers(df, ["v"], "other")


def test_zscore_of_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "v double")
    assert outliers.zscore_report(df).first()["outlier_count"] == 0
    assert outliers.zscore_outliers(df, "v").count() == 0


def test_drift_distances(spark):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(0, 1, 3000), 2), np.round(rng.normal(0.5, 1.2, 2000), 2)
    ref = spark.createDataFrame([(float(x),) for x in a], "v double")
    cur = spark.createDataFrame([(float(x),) for x in b], "v double")
    r = drift.numeric_drift(ref, cur, ["v"]).first()
    grid = np.union1d(a, b)
    fa, fb = (np.searchsorted(np.sort(x), grid, side="right") / len(x) for x in (a, b))
    assert r["ks"] == pytest.approx(np.abs(fa - fb).max())
    w = np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)) / a.std()
    assert r["wasserstein"] == pytest.approx(w)
    assert r["drifted"] and r["n_ref"] == 3000
    same = drift.numeric_drift(ref, ref, ["v"]).first()
    assert (same["psi"], same["ks"], same["wasserstein"], same["ks_p"], same["drifted"]) == (0.0, 0.0, 0.0, 1.0, False)


def test_categorical_drift_and_dataset(spark):
    ref = spark.createDataFrame([("a",)] * 1500 + [("b",)] * 500, "c string")
    cur = spark.createDataFrame([("a",)] * 200 + [("b",)] * 700 + [("z",)] * 10, "c string")
    r = drift.categorical_drift(ref, cur, ["c"]).first()
    assert r["drifted"] and r["degrees"] == 2 and r["chi_square"] > 0
    run = drift.dataset_drift(drift.column_drift(ref, cur, [], ["c"])).first()
    assert run["dataset_drift"] and list(run["drifted_features"]) == ["c"]
    calm = drift.dataset_drift(drift.column_drift(ref, ref, [], ["c"])).first()
    assert calm["share_of_drifted_features"] == 0 and calm["drifted_features"] == {}


@pytest.mark.parametrize("score, share, rmse, want", [
    (0.7, 0.0, 10.0, "CRITICAL"), (0.0, 0.5, 10.0, "CRITICAL"), (0.0, 0.0, 11.5, "CRITICAL"), (0.5, 0.0, 10.0, "WARNING"),
    (0.0, 0.36, 11.4, "WARNING"), (0.36, 0.3, 11.4, "INFO")])
def test_alert_severity(spark, score, share, rmse, want):
    run = spark.createDataFrame([(score, share, rmse)], "drift_score double, share_of_drifted_features double, rmse double")
    assert drift.alert(run, 10.0).first()["severity"] == want


def test_join_small_both_ways(spark):
    big = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("a", 4)], "k string, v int")
    side = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    want = [("a", 1, 10), ("a", 4, 10), ("b", 3, None), (None, 2, 20)]
    for limit in (None, 0):
        got = small.join_small(big, side, ["k"], "left", limit).select("k", "v", "w").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_drift_of_an_empty_column(spark):
    full = spark.createDataFrame([(float(i), "a") for i in range(20)], "v double, c string")
    empty = spark.createDataFrame([(None, None)], "v double, c string")
    for ref, cur in ((full, empty), (empty, full)):
        rows = drift.column_drift(ref, cur, ["v"], ["c"]).collect()
        assert len(rows) == 2 and all(r["drifted"] for r in rows)
