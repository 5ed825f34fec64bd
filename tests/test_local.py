"""Local-regression decomposition, neighbour information and rank selection against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.operators import loess, neighbours, order, split, tseries


def one_fit(y, w, q, x):
    """A local line at x, point by point."""
    n = len(y)
    left = min(max(x - (q - 1) // 2, 0), max(n - q, 0))
    right = min(left + q, n) - 1
    h = max(x - left, right - x) + max(q - n, 0) // 2
    ws = {}
    for j in range(left, right + 1):
        r = abs(j - x)
        if r <= 0.999 * h:
            ws[j] = w[j] * (1 if r <= 0.001 * h else (1 - (r / h) ** 3) ** 3)
    total = sum(ws.values())
    if total <= 0:
        return None
    ws = {j: v / total for j, v in ws.items()}
    a = sum(v * j for j, v in ws.items())
    c = sum(v * (j - a) ** 2 for j, v in ws.items())
    slope = (x - a) / c if math.sqrt(c) > 0.001 * (n - 1) else 0
    return sum(v * (1 + slope * (j - a)) * y[j] for j, v in ws.items())


def plain_stl(y, p, q, trend_q, low_q, inner, outer):
    n = len(y)
    trend, w = np.zeros(n), np.ones(n)
    for turn in range(outer + 1):
        for _ in range(inner):
            c = np.zeros(n + 2 * p)
            for k in range(p):
                own, ws = (y - trend)[k::p], w[k::p]
                fit = [one_fit(own, ws, q, x) for x in range(-1, len(own) + 1)]
                fit[1:-1] = [o if f is None else f for f, o in zip(fit[1:-1], own)]
                fit[0] = fit[1] if fit[0] is None else fit[0]
                fit[-1] = fit[-2] if fit[-1] is None else fit[-1]
                c[k::p][:len(fit)] = fit
            low = c
            for m in (p, p, 3):
                low = np.array([low[i:i + m].mean() for i in range(len(low) - m + 1)])
            season = c[p:-p] - np.array([one_fit(low, np.ones(n), low_q, x) for x in range(n)])
            rest = y - season
            trend = np.array([rest[x] if (f := one_fit(rest, w, trend_q, x)) is None else f for x in range(n)])
        r = np.abs(y - season - trend)
        h = 6 * np.median(r)
        used = w
        w = np.where(r <= 0.001 * h, 1, np.where(r <= 0.999 * h, (1 - (r / h) ** 2) ** 2, 0))
    return trend, season, used


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(3)
    t = np.arange(330)
    y = 0.03 * t + 5 * np.sin(2 * np.pi * t / 6) + rng.normal(0, 1, 330)
    y[[40, 200, 201]] += 300
    rows = [(int(i), "long", float(v)) for i, v in zip(t, y)] + [(i, "short", 1.0) for i in range(11)]
    rows += [(i, None, float(v)) for i, v in zip(range(40), y)] + [(1000, "long", None), (1001, "long", float("nan"))]
    return y, spark.createDataFrame(rows, "t long, g string, v double").repartition(5).cache()


@pytest.mark.parametrize("block", [None, 90])
def test_loess_decomposition(series, block):
    """Also in blocks, where halos stand in for the rest of the series."""
    y, df = series
    out = loess.decompose_loess(df, ["g"], ["t"], "v", 6, outer=2, block=block)
    for g, own in (("long", y), (None, y[:40])):
        got = out.filter(F.col("g").eqNullSafe(F.lit(g))).orderBy("pos").toPandas()
        trend, season, weight = plain_stl(own, 6, 7, 13, 7, 2, 2)
        np.testing.assert_allclose(got["trend"].to_numpy(float), trend, atol=1e-8)
        np.testing.assert_allclose(got["seasonal"].to_numpy(float), season, atol=1e-8)
        np.testing.assert_allclose(got["weight"].to_numpy(float), weight, atol=1e-8)
        np.testing.assert_allclose(got["observed"], got["trend"] + got["seasonal"] + got["resid"])
    assert out.filter("g = 'short' AND trend IS NULL").count() == 11


def test_robust_fit_ignores_spikes(series):
    y, df = series
    # The clean trend at place 40 is 1.2.
    off = lambda **how: abs(loess.decompose_loess(df.filter("g = 'long'"), [], ["t"], "v", 6, **how).filter("pos = 40").first()["trend"] - 1.2)
    assert off(outer=3) < 0.5 * off(robust=False)
    by_group = tseries.seasonality_by_group(df, "g", ["t"], "v", 6, lambda *a: loess.decompose_loess(*a, robust=False))
    found = {r["g"]: r for r in by_group.collect()}
    assert found["long"]["error"] is None and "shorter" in found["short"]["error"]
    with pytest.raises(ValueError):
        loess.decompose_loess(df, ["g"], ["t"], "v", 6, seasonal=8)


def plain_information(x, y, k):
    x, y = x / x.std(), y / y.std()
    n, psi = len(x), lambda m: -0.5772156649015329 + sum(1 / j for j in range(1, m))
    total = 0
    for i in range(n):
        dx, dy = np.abs(x - x[i]), np.abs(y - y[i])
        r = np.sort(np.maximum(dx, dy))[k]
        nx, ny = (int((d == 0).sum() if r == 0 else (d < r * (1 - 1e-9)).sum()) for d in (dx, dy))
        total += psi(nx) + psi(ny)
    return max(0.0, psi(n) + psi(k) - total / n)


@pytest.mark.parametrize("box", [neighbours.BOX, 20])
def test_neighbour_information(spark, box):
    """Also with many boxes; one column has few values, and a fifth of the rows is one point."""
    rng = np.random.default_rng(8)
    n = 500
    a, b = rng.normal(size=n), rng.integers(0, 6, n).astype(float)
    y = a * a + 0.3 * b + rng.normal(0, 0.2, n)
    for v, hot in ((a, 1.5), (b, 2.0), (y, 4.0)):
        v[:100] = hot
    rows = [tuple(map(float, r)) for r in zip(a, b, rng.normal(size=n), np.ones(n), y)] + [(None, 1.0, 1.0, 1.0, 1.0), (1.0, float("nan"), 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, `c.d` double, one double, y double").repartition(4)
    got = {r["feature"]: r["mi_score"] for r in neighbours.neighbour_information(df, "y", box=box).collect()}
    assert got["one"] == 0
    for name, i in (("a", 0), ("b", 1), ("c.d", 2)):
        assert got[name] == pytest.approx(plain_information(np.array([r[i] for r in rows[:n]]), y, 3), abs=1e-9)
    few = neighbours.neighbour_information(df.limit(3), "y", ["a"])
    assert [tuple(r) for r in few.collect()] == [("a", 0.0)]


def test_digamma(spark):
    got = spark.range(1, 60).select("id", neighbours.digamma(F.col("id")).alias("d")).collect()
    for r in got:
        assert r["d"] == pytest.approx(-0.5772156649015329 + sum(1 / j for j in range(1, r["id"])), abs=1e-12)


def test_rows_are_shuffled_and_sorted_once(spark):
    """Row numbers and the windows of a fill are planned on the slices' own order."""
    df = spark.range(1000).selectExpr("id", "id % 3 AS k", "CAST(id AS double) AS v")
    w = order._here(["k"], ["id"])
    plan = order.arrange(df, ["id"], ["k"]).withColumn("x", F.sum("v").over(w))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_slices_follow_the_order(spark, slices):
    rows = [(None if i % 11 == 0 else f"k{i % 4}", float("nan") if i % 13 == 0 else i / 7, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, x double, id long")
    number, n = order.slicing(df, ["k", "x", "id"], slices)
    got = df.withColumn("s", number).orderBy("k", "x", "id").collect()
    numbers = [r["s"] for r in got]
    assert n == slices and numbers == sorted(numbers) and len(set(numbers)) == slices
    assert slices == 1 or max(map(numbers.count, set(numbers))) < 3 * 2000 / slices


def test_rows_at_ranks_and_ties_of_dates(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(100)], "d int, id long")
    got = {r["place"]: tuple(r["point"]) for r in order.row_at(df, ["d", "id"], F.array(F.lit(0), F.col("n") - 1, F.lit(50), F.col("n"))).collect()}
    ordered = sorted((i % 5, i) for i in range(100))
    assert got == {0: ordered[0], 1: ordered[-1], 2: ordered[50]}
    # Cuts fall inside equal dates.
    parts = split.temporal_split(df, "d", "id", 0.5, 0.25, 0.25).collect()
    want = {i: "train" if k < 50 else "val" if k < 75 else "test" for k, (_, i) in enumerate(ordered)}
    assert {r["id"]: r["split"] for r in parts} == want


def test_loess_of_series_side_by_side():
    rng = np.random.default_rng(7)
    y, w = rng.normal(size=(40, 3)), rng.random((40, 3))
    first, whole = np.array([0, 5, 12]), np.array([40, 90, 52])
    zero = np.zeros_like(y)
    together = loess.passes(y, zero, w, 6, 7, 13, 7, 2, first, whole)
    for k in range(3):
        alone = loess.passes(y[:, [k]], zero[:, [k]], w[:, [k]], 6, 7, 13, 7, 2, first[[k]], whole[[k]])
        for a, b in zip(together, alone):
            assert a[:, [k]] == pytest.approx(b, abs=1e-12)


def test_loess_of_many_series_in_few_calls(spark, monkeypatch):
    # Null is a key of its own; the lengths differ, and one series is too short for its period.
    rows = [(None if g == 3 else g, t, float((t * 7 + g) % 11)) for g in range(12) for t in range(9 if g == 5 else 14 + g % 3)]
    df = spark.createDataFrame(rows, "g long, t long, v double").repartition(5)
    got = []
    for size in (1, 50, 65_536):
        monkeypatch.setattr(loess, "CALL_ROWS", size)
        out = loess.decompose_loess(df, ["g"], ["t"], "v", 5, outer=1)
        got.append({(r.g, r.t): r.trend for r in out.collect()})
    assert len(got[0]) == len(rows) and all(v is None for (g, _), v in got[0].items() if g == 5)
    for other in got[1:]:
        assert other == pytest.approx({k: v for k, v in got[0].items()}, abs=1e-12, nan_ok=True)
