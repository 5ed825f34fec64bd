"""Decomposition, autocorrelation, packaging and backtests of the user series."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspan.operators import loess, tseries
from wattspan.plans.queries.base import query, r, rounded, table

_ORDER = ["ts", "event_id"]
_P, _TYPE_P = 7, 4
_POS = """pos AS (SELECT user_id, event_id, ts, event_type, value AS y, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) - 1 AS pos,
  count(*) OVER (PARTITION BY {key}) AS n FROM events)"""
_EVEN = "CASE WHEN count(y) OVER w = 5 THEN (sum(y) OVER w - (lag(y, 2) OVER o + lead(y, 2) OVER o) / 2) / 4 END"
_ODD = "CASE WHEN count(y) OVER w = 7 THEN sum(y) OVER w / 7 END"
_DEC = _POS + """, ma AS (SELECT *, {trend} AS trend, CAST(pos % {p} AS INTEGER) AS phase FROM pos
    WINDOW w AS (PARTITION BY {key} ORDER BY pos ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING), o AS (PARTITION BY {key} ORDER BY pos)),
  ph AS (SELECT {key}, phase, avg(y - trend) AS raw FROM ma WHERE trend IS NOT NULL GROUP BY 1, 2),
  se AS (SELECT {key}, phase, raw - avg(raw) OVER (PARTITION BY {key}) AS seasonal FROM ph),
  dec AS (SELECT ma.*, seasonal, y - trend - seasonal AS resid FROM ma LEFT JOIN se ON ma.{key} = se.{key} AND ma.phase = se.phase)"""
_USER = _DEC.format(key="user_id", trend=_ODD, p=_P, half=3)
_TYPE = _DEC.format(key="event_type", trend=_EVEN, p=_TYPE_P, half=2)
_STRENGTH = """count(*) AS n,
  CASE WHEN var_pop(resid + seasonal) = 0 THEN 0 ELSE greatest(0, 1 - var_pop(resid) / var_pop(resid + seasonal)) END AS seasonal_strength,
  CASE WHEN var_pop(resid + trend) = 0 THEN 0 ELSE greatest(0, 1 - var_pop(resid) / var_pop(resid + trend)) END AS trend_strength,
  max(seasonal) - min(seasonal) AS seasonal_peak_to_trough, avg(resid) AS residual_mean, stddev_samp(resid) AS residual_std"""
_R6 = """round(seasonal_strength, 6) AS seasonal_strength, round(trend_strength, 6) AS trend_strength,
  round(seasonal_peak_to_trough, 6) AS seasonal_peak_to_trough, round(residual_mean, 6) + 0 AS residual_mean, round(residual_std, 6) AS residual_std"""


def _decomposed(spark, sf, key):
    return tseries.decompose(table(spark, sf, "events"), [key], _ORDER, "value", _P)


@query("ts1_decompose", f"""WITH {_USER} SELECT user_id, event_id, pos, phase, y AS observed, round(trend, 8) AS trend,
  round(seasonal, 8) AS seasonal, round(resid, 8) + 0 AS resid FROM dec""")
def _(spark, sf):
    return rounded(_decomposed(spark, sf, "user_id").drop("ts"), 8)


_SPIKE = _USER.replace("value AS y", "CASE WHEN event_id = 77 THEN 1e17 ELSE value END AS y")


@query("ts1_decompose_spike", f"""WITH {_SPIKE} SELECT user_id, event_id, pos, CASE WHEN abs(trend) < 1e9 THEN round(trend, 8) END AS trend FROM dec""")
def _(spark, sf):
    spike = F.when(F.col("event_id") == 77, 1e17).otherwise(F.col("value"))
    out = tseries.decompose(table(spark, sf, "events").withColumn("value", spike), ["user_id"], _ORDER, "value", _P)
    return out.select("user_id", "event_id", "pos", F.when(F.abs("trend") < 1e9, r("trend", 8)).alias("trend"))


def _fits(name: str, points: str, source: str, q: int, key: str) -> str:
    """SQL of local lines through ``source`` (key, i, n, y, w) at ``points`` (key, x)."""
    left = f"greatest(0, least(x - {(q - 1) // 2}, n - least({q}, n)))"
    return f"""{name}_p AS (SELECT {key}, x, n, {left} AS lo, {left} + least({q}, n) - 1 AS hi FROM {points}),
  {name}_h AS (SELECT *, greatest(x - lo, hi - x) + greatest({q} - n, 0) // 2 AS h FROM {name}_p),
  {name}_w AS (SELECT {key}, x, p.n, s.i - x AS d, s.y, s.w * CASE WHEN abs(s.i - x) <= 0.001 * h THEN 1
      WHEN abs(s.i - x) <= 0.999 * h THEN (1 - (abs(s.i - x) / h) ** 3) ** 3 ELSE 0 END AS w
    FROM {name}_h p JOIN {source} s USING ({key}) WHERE s.i BETWEEN lo AND hi),
  {name}_m AS (SELECT {key}, x, max(n) AS n, sum(w) AS s0, sum(w * d) / nullif(sum(w), 0) AS c, sum(w * d * d) / nullif(sum(w), 0) AS d2,
    sum(w * y) / nullif(sum(w), 0) AS t0, sum(w * d * y) / nullif(sum(w), 0) AS t1 FROM {name}_w GROUP BY ALL),
  {name} AS MATERIALIZED (SELECT {key}, x, t0 + CASE WHEN sqrt(greatest(d2 - c * c, 0)) > 0.001 * (n - 1) THEN -c / (d2 - c * c) * (t1 - c * t0)
    ELSE 0 END AS fit FROM {name}_m)"""


def _stl(p: int, seasonal: int, trend: int, low: int, inner: int, outer: int) -> str:
    """SQL of the robust decomposition of the users' series, pass by pass."""
    out = [f"""{_POS.format(key='user_id')}, st0 AS (SELECT user_id, pos, n, y, 0.0::DOUBLE AS trend, 1.0::DOUBLE AS w FROM pos WHERE n >= {2 * p})"""]
    k = 0
    for turn in range(outer + 1):
        for _ in range(inner):
            a = f"a{k}"
            out.append(f"""{a}_s AS MATERIALIZED (SELECT user_id * 100 + pos % {p} AS g, user_id, pos % {p} AS phase, pos // {p} AS i,
    count(*) OVER (PARTITION BY user_id, pos % {p}) AS n, y - trend AS y, w FROM st{k}),
  {a}_x AS (SELECT g, unnest(range(-1, max(n) + 1)) AS x, max(n) AS n FROM {a}_s GROUP BY g),
  {_fits(f'{a}_f', f'{a}_x', f'{a}_s', seasonal, 'g')},
  {a}_i AS (SELECT f.g, f.x, coalesce(f.fit, s.y) AS fit FROM {a}_f f LEFT JOIN {a}_s s ON f.g = s.g AND f.x = s.i),
  {a}_c AS (SELECT g // 100 AS user_id, (x + 1) * {p} + g % 100 AS e, coalesce(fit, CASE WHEN x < 0 THEN lead(fit) OVER o ELSE lag(fit) OVER o END)
    AS c FROM {a}_i WINDOW o AS (PARTITION BY g ORDER BY x)),
  {a}_m1 AS (SELECT user_id, e, avg(c) OVER w AS c, count(*) OVER w AS k FROM {a}_c
    WINDOW w AS (PARTITION BY user_id ORDER BY e ROWS BETWEEN CURRENT ROW AND {p - 1} FOLLOWING)),
  {a}_m2 AS (SELECT user_id, e, avg(c) OVER w AS c, count(*) OVER w AS k FROM {a}_m1 WHERE k = {p}
    WINDOW w AS (PARTITION BY user_id ORDER BY e ROWS BETWEEN CURRENT ROW AND {p - 1} FOLLOWING)),
  {a}_m3 AS (SELECT user_id, e, avg(c) OVER w AS c, count(*) OVER w AS k FROM {a}_m2 WHERE k = {p}
    WINDOW w AS (PARTITION BY user_id ORDER BY e ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
  {a}_v AS MATERIALIZED (SELECT user_id, e AS i, count(*) OVER (PARTITION BY user_id) AS n, c AS y, 1.0 AS w FROM {a}_m3 WHERE k = 3),
  {a}_vx AS (SELECT user_id, i AS x, n FROM {a}_v),
  {_fits(f'{a}_l', f'{a}_vx', f'{a}_v', low, 'user_id')},
  {a}_d AS MATERIALIZED (SELECT s.user_id, s.pos AS i, s.n, s.w, s.y AS raw, c.c - l.fit AS season, s.y - (c.c - l.fit) AS y FROM st{k} s
    JOIN {a}_c c ON c.user_id = s.user_id AND c.e = s.pos + {p} JOIN {a}_l l ON l.user_id = s.user_id AND l.x = s.pos),
  {a}_dx AS (SELECT user_id, i AS x, n FROM {a}_d),
  {_fits(f'{a}_t', f'{a}_dx', f'{a}_d', trend, 'user_id')},
  st{k + 1} AS MATERIALIZED (SELECT d.user_id, d.i AS pos, d.n, d.raw AS y, coalesce(t.fit, d.y) AS trend, d.w, d.season
    FROM {a}_d d JOIN {a}_t t ON t.user_id = d.user_id AND t.x = d.i)""")
            k += 1
        if turn < outer:
            out.append(f"""b{k} AS (SELECT *, abs(y - trend - season) AS r, 6 * median(abs(y - trend - season)) OVER (PARTITION BY user_id) AS h FROM st{k}),
  st{k + 1} AS MATERIALIZED (SELECT user_id, pos, n, y, trend, season, CASE WHEN r <= 0.001 * h THEN 1 WHEN r <= 0.999 * h THEN (1 - (r / h) ** 2) ** 2
    ELSE 0 END AS w FROM b{k})""")
            k += 1
    return ",\n  ".join(out) + f""", dec AS (SELECT p.*, CAST(p.pos % {p} AS INTEGER) AS phase, trend, season AS seasonal, p.y - trend - season AS resid, w AS weight
    FROM pos p LEFT JOIN st{k} s USING (user_id, pos))"""


def _robust(spark, sf, spike: bool = False):
    df = table(spark, sf, "events")
    if spike:
        df = df.withColumn("value", F.when(F.col("event_id") % 97 == 0, 1e5).otherwise(F.col("value")))
    return loess.decompose_loess(df, ["user_id"], _ORDER, "value", _P, outer=2)


_STL = _stl(_P, 7, 15, 9, 2, 2)


@query("ts1_loess", f"""WITH {_STL} SELECT user_id, event_id, pos, phase, y AS observed, round(trend, 6) + 0 AS trend,
  round(seasonal, 6) + 0 AS seasonal, round(resid, 6) + 0 AS resid, round(weight, 6) AS weight FROM dec""")
def _(spark, sf):
    return rounded(_robust(spark, sf).drop("ts"))


@query("ts2_loess_strengths_spike", f"""WITH {_STL.replace("value AS y", "CASE WHEN event_id % 97 = 0 THEN 1e5 ELSE value END AS y")},
  s AS (SELECT user_id, {_STRENGTH} FROM dec GROUP BY 1) SELECT user_id, n, round(seasonal_strength, 6) AS seasonal_strength,
  round(trend_strength, 6) AS trend_strength, round(seasonal_peak_to_trough, 4) AS seasonal_peak_to_trough FROM s""")
def _(spark, sf):
    out = tseries.strengths(_robust(spark, sf, True), ["user_id"])
    return out.select("user_id", "n", r("seasonal_strength").alias("seasonal_strength"), r("trend_strength").alias("trend_strength"),
                      r("seasonal_peak_to_trough", 4).alias("seasonal_peak_to_trough"))


@query("ts2_strengths", f"WITH {_USER}, s AS (SELECT user_id, {_STRENGTH} FROM dec GROUP BY 1) SELECT user_id, n, {_R6} FROM s")
def _(spark, sf):
    return rounded(tseries.strengths(_decomposed(spark, sf, "user_id"), ["user_id"]))


@query("ts3_seasonality_by_group", f"""WITH {_TYPE}, s AS (SELECT event_type, {_STRENGTH} FROM dec GROUP BY 1)
  SELECT event_type, n, {_R6}, NULL::VARCHAR AS error FROM s""")
def _(spark, sf):
    return rounded(tseries.seasonality_by_group(table(spark, sf, "events"), "event_type", _ORDER, "value", _TYPE_P))


@query("ts4_seasonal_pattern", f"""WITH {_USER} SELECT user_id, phase AS period_index, round(avg(seasonal), 8) AS seasonal_value
  FROM dec WHERE pos < floor(n / {_P}) * {_P} GROUP BY 1, 2""")
def _(spark, sf):
    return rounded(tseries.seasonal_pattern(_decomposed(spark, sf, "user_id"), ["user_id"], _P), 8)


_LAGS = 12
_ACF = f"""{_POS.format(key='event_type')}, m AS (SELECT *, y - avg(y) OVER (PARTITION BY event_type) AS x FROM pos),
  l AS (SELECT a.event_type, k.k AS lag, max(a.n) AS n, sum(a.x * b.x) AS s FROM m a, range(0, {_LAGS + 1}) k(k), m b
    WHERE b.event_type = a.event_type AND b.pos = a.pos + k.k GROUP BY 1, 2),
  acf AS (SELECT event_type, CAST(lag AS INTEGER) AS lag, n, s / max(s) FILTER (lag = 0) OVER (PARTITION BY event_type) AS acf FROM l)"""


@query("ts5_autocorrelation", f"""WITH {_ACF} SELECT event_type, n, lag, round(acf, 6) + 0 AS acf,
  round(CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
    OVER (PARTITION BY event_type ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END, 6) AS band FROM acf""")
def _(spark, sf):
    return rounded(tseries.autocorrelation(table(spark, sf, "events"), ["event_type"], _ORDER, "value", _LAGS))


@query("ts6_partial_autocorrelation", f"""WITH RECURSIVE {_ACF},
  r AS (SELECT event_type, list(acf ORDER BY lag) AS r FROM acf GROUP BY 1),
  d AS (SELECT event_type, r, 1 AS k, [r[2]] AS phi, r[2] AS p FROM r
    UNION ALL
    SELECT event_type, r, k + 1, list_concat(list_transform(range(1, k + 1), lambda j: phi[j] - q * phi[k + 1 - j]), [q]), q
    FROM (SELECT *, (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])))
      / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1]))) AS q FROM d WHERE k < {_LAGS}))
  SELECT event_type, 0 AS lag, 1.0::DOUBLE AS pacf, 0.0::DOUBLE AS band FROM r UNION ALL
  SELECT event_type, CAST(k AS INTEGER), round(p, 6) + 0, round(1.959963984540054 / sqrt(n), 6)
  FROM d JOIN (SELECT event_type, max(n) AS n FROM acf GROUP BY 1) USING (event_type)""")
def _(spark, sf):
    acf = tseries.autocorrelation(table(spark, sf, "events"), ["event_type"], _ORDER, "value", _LAGS)
    return rounded(tseries.partial_autocorrelation(acf, ["event_type"]))


_CHUNK = 1000


@query("ts7_pack_series", f"""WITH {_POS.format(key='event_type')} SELECT event_type, CAST(pos // {_CHUNK} AS INTEGER) AS part,
  list(CAST(y AS FLOAT) ORDER BY pos) AS target, list(CAST(user_id AS FLOAT) ORDER BY pos) AS past_user, TRUE AS no_future
  FROM pos GROUP BY 1, 2""")
def _(spark, sf):
    packed = tseries.pack_series(
        table(spark, sf, "events"), ["event_type"], _ORDER, "value", past=["user_id"], chunk=_CHUNK)
    return packed.select(
        "event_type", "part", "target", F.col("past_covariates")["user_id"].alias("past_user"),
        F.col("future_covariates").isNull().alias("no_future"))


@query("ts9_packaging_stats", """SELECT count(*) AS n_series, min(n) AS min_length, max(n) AS max_length, round(avg(n), 6) AS avg_length,
  TRUE AS has_past_covariates, TRUE AS has_future_covariates FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    packed = tseries.pack_series(ev, ["user_id"], _ORDER, "value", ["event_id"], ["event_id"], chunk=_CHUNK, require_subset=True)
    return rounded(tseries.packaging_stats(packed, ["user_id"]))


_CTX = _POS.format(key="user_id") + """, ctx AS (SELECT *, list(y) OVER (PARTITION BY user_id ORDER BY pos
  ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS context FROM pos)"""


@query("ts10_context_windows", f"WITH {_CTX} SELECT user_id, event_id, pos, y AS observed, context FROM ctx WHERE pos >= 8")
def _(spark, sf):
    return tseries.context_windows(table(spark, sf, "events"), ["user_id"], _ORDER, "value", 8).drop("ts")


_BACK = f"""WITH {_CTX}, f AS (SELECT * FROM ctx WHERE pos >= 8),
  b AS (SELECT 'last_value' AS model, y, context[8] AS p FROM f UNION ALL SELECT 'seasonal_naive', y, context[5] FROM f
    UNION ALL SELECT 'window_mean', y, list_avg(context) FROM f
    UNION ALL SELECT 'window_median', y, (list_sort(context)[4] + list_sort(context)[5]) / 2 FROM f)"""
METRICS_SQL = """count(*) AS n, round(sqrt(avg((y - p) ** 2)), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
  round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2, round(avg(abs((y - p) / y)) FILTER (y <> 0) * 100, 4) AS mape,
  round(max(abs(y - p)), 4) AS max_error"""


@query("ts11_backtest", f"{_BACK} SELECT model, {METRICS_SQL.replace(', 4)', ', 6)')} FROM b GROUP BY model")
def _(spark, sf):
    scored = tseries.backtest(table(spark, sf, "events"), ["user_id"], _ORDER, "value", 8, _TYPE_P)
    out = tseries.backtest_scores(scored)
    return out.select("model", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2", "mape", "max_error")])
