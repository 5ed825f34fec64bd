import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.operators import tseries


@pytest.fixture(scope="module")
def seasonal(spark):
    rng = np.random.default_rng(9)
    t = np.arange(500)
    y = 0.05 * t + 50 + 10 * np.sin(2 * np.pi * t / 24) + rng.normal(0, 2, 500)
    rows = [(int(i), "A" if i % 2 else "B", float(v)) for i, v in zip(t, y)]
    return y, spark.createDataFrame(rows, "t long, g string, v double").repartition(6).cache()


def classical(y, p):
    h, n = p // 2, len(y)
    trend = np.full(n, np.nan)
    w = np.ones(p) / p if p % 2 else np.r_[0.5, np.ones(p - 1), 0.5] / p
    for i in range(h, n - h):
        trend[i] = (w * y[i - h:i + h + 1]).sum()
    raw = np.array([np.nanmean((y - trend)[k::p]) for k in range(p)])
    s = np.array([raw[i % p] for i in range(n)]) - raw.mean()
    return trend, s, y - trend - s


@pytest.mark.parametrize("period", [24, 7])
@pytest.mark.parametrize("block", [None, 40])
def test_decomposition(seasonal, period, block):
    y, df = seasonal
    out = tseries.decompose(df, [], ["t"], "v", period, block).orderBy("pos").toPandas()
    trend, s, resid = classical(y, period)
    np.testing.assert_allclose(out["trend"].to_numpy(float), trend, atol=1e-9)
    np.testing.assert_allclose(out["seasonal"].to_numpy(float), s, atol=1e-9)
    np.testing.assert_allclose(out["resid"].to_numpy(float), resid, atol=1e-9)
    known = out.dropna()
    np.testing.assert_allclose(known["observed"], known["trend"] + known["seasonal"] + known["resid"], atol=1e-9)


def test_strengths_find_the_season(seasonal):
    _, df = seasonal
    r = tseries.strengths(tseries.decompose(df, [], ["t"], "v", 24), []).first()
    assert 0.9 < r["seasonal_strength"] <= 1 and 0 <= r["trend_strength"] <= 1
    assert r["seasonal_peak_to_trough"] == pytest.approx(20, abs=3)


def test_groups_and_short_group(seasonal, spark):
    _, df = seasonal
    short = spark.createDataFrame([(1000 + i, "C", 1.0) for i in range(5)], "t long, g string, v double")
    out = {r["g"]: r for r in tseries.seasonality_by_group(df.unionByName(short), "g", ["t"], "v", 12).collect()}
    assert out["A"]["error"] is None and out["A"]["seasonal_strength"] > 0.8
    assert "shorter" in out["C"]["error"] and out["C"]["seasonal_strength"] is None


@pytest.mark.parametrize("block", [None, 50])
def test_acf_pacf(spark, block):
    rng = np.random.default_rng(42)
    y = np.zeros(200)
    for i in range(1, 200):
        y[i] = 0.7 * y[i - 1] + rng.normal()
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)], "k string, t long, v double")
    acf = tseries.autocorrelation(df, ["k"], ["t"], "v", 10, block).orderBy("lag").toPandas()
    x = y - y.mean()
    want = [1.0] + [(x[k:] * x[:-k]).sum() / (x * x).sum() for k in range(1, 11)]
    np.testing.assert_allclose(acf["acf"], want)
    assert acf["band"][0] == 0 and acf["band"][1] == pytest.approx(1.959963984540054 / np.sqrt(200))
    pacf = tseries.partial_autocorrelation(spark.createDataFrame(acf), ["k"]).orderBy("lag").toPandas()["pacf"]
    assert pacf[0] == 1 and pacf[1] == pytest.approx(want[1])
    for k in (2, 3):
        m = np.array([[want[abs(i - j)] for j in range(k)] for i in range(k)])
        assert pacf[k] == pytest.approx(np.linalg.solve(m, np.array(want[1:k + 1]))[-1])


def test_short_series_has_fewer_lags(spark):
    df = spark.createDataFrame([("s", i, float(i)) for i in range(3)], "k string, t long, v double")
    assert tseries.autocorrelation(df, ["k"], ["t"], "v", 10).count() == 3


def test_packaging(spark):
    df = spark.createDataFrame([("a", i, float(i), float(-i)) for i in range(7)] + [("b", 0, 9.0, 1.0)], "k string, t long, v double, c double")
    one = tseries.pack_series(df, ["k"], ["t"], "v", ["c"], ["c"], chunk=100)
    rec = {r["k"]: r for r in one.collect()}
    assert rec["a"]["target"] == [float(i) for i in range(7)] and rec["a"]["past_covariates"]["c"][3] == -3.0
    parts = tseries.pack_series(df, ["k"], ["t"], "v", ["c"], chunk=3)
    joined = [x for r in sorted(parts.filter("k = 'a'").collect(), key=lambda r: r["part"]) for x in r["target"]]
    assert joined == rec["a"]["target"]
    st = tseries.packaging_stats(parts, ["k"]).first()
    assert (st["n_series"], st["min_length"], st["max_length"], st["has_future_covariates"]) == (2, 1, 7, False)
    with pytest.raises(ValueError):
        tseries.pack_series(df, ["k"], ["t"], "v", [], ["c"], chunk=9, require_subset=True)
    with pytest.raises(ValueError):
        tseries.pack_series(df, ["k"], ["t"], "missing", chunk=9)


@pytest.mark.parametrize("block", [None, 16])
def test_context_and_cap(seasonal, block):
    y, df = seasonal
    out = tseries.context_windows(df, [], ["t"], "v", 12, block=block).orderBy("pos").collect()
    assert len(out) == 488 and out[5]["context"] == pytest.approx(list(y[5:17])) and out[5]["observed"] == pytest.approx(y[17])
    assert tseries.context_windows(df, [], ["t"], "v", 12, max_predictions=9).count() == 9
    scores = tseries.backtest_scores(tseries.backtest(df, [], ["t"], "v", 24, 24)).filter(F.col("model") == "seasonal_naive").first()
    assert scores["n"] == 476 and scores["rmse"] == pytest.approx(np.sqrt(np.mean((y[24:] - y[:-24]) ** 2)))
