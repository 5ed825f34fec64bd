"""Drift, alerts, metric history, text logs and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wattspan.operators import drift, drift_state, history, textlog
from wattspan.plans import monitoring as jobs
from wattspan.plans.queries.base import ORACLES, query, r, rounded, scratch, table
from wattspan.sources import io
from wattspan.streaming import jobs as streams

_CUT = "TIMESTAMP '2000-01-01'"
_NUM = ["o_totalprice", "amount"]


def _halves(spark, sf):
    """Orders before and after a cut date; the later amounts are inflated."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"), F.col("o_totalprice") * 1.2)
        .otherwise(F.col("o_totalprice")).alias("amount"))
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    o = o.withColumn("o_orderpriority", F.when(late & (F.col("o_orderkey") % 2 == 0), "1-URGENT").otherwise(F.col("o_orderpriority")))
    return o.filter(~late), o.filter(late)


_HALVES = f"""o AS (SELECT *, o_orderdate >= {_CUT} AS late,
    CASE WHEN o_orderdate >= {_CUT} THEN o_totalprice * 1.2::DOUBLE ELSE o_totalprice END AS amount,
    CASE WHEN o_orderdate >= {_CUT} AND o_orderkey % 2 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS prio FROM orders)"""


def _num_sql(c):
    return f"""SELECT '{c}' AS "column", (SELECT na FROM t_{c}) AS n_ref, (SELECT nb FROM t_{c}) AS n_cur,
      (SELECT sum((greatest(b / nb, 0.0001) - greatest(a / na, 0.0001)) * ln(greatest(b / nb, 0.0001) / greatest(a / na, 0.0001)))
        FROM (SELECT CAST(greatest(0, least(9, floor(({c} - lo) / (hi - lo) * 10))) AS INTEGER) AS bin,
          count(*) FILTER (NOT late) AS a, count(*) FILTER (late) AS b FROM o, t_{c} GROUP BY 1), t_{c}) AS psi,
      (SELECT max(abs(ca / na - cb / nb)) FROM r_{c}, t_{c}) AS ks,
      (SELECT sum(abs(coalesce((ca - a) / na - (cb - b) / nb, 0)) * coalesce(v - pv, 0)) / max(sd) FROM r_{c}, t_{c}) AS wasserstein"""


def _num_ctes(c):
    return f"""t_{c} AS (SELECT count(*) FILTER (NOT late) AS na, count(*) FILTER (late) AS nb, min({c}) FILTER (NOT late) AS lo,
      max({c}) FILTER (NOT late) AS hi, stddev_pop({c}) FILTER (NOT late) AS sd FROM o),
    v_{c} AS (SELECT {c} AS v, count(*) FILTER (NOT late) AS a, count(*) FILTER (late) AS b FROM o GROUP BY 1),
    r_{c} AS (SELECT v, a, b, sum(a) OVER w AS ca, sum(b) OVER w AS cb, lag(v) OVER (ORDER BY v) AS pv FROM v_{c}
      WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


_NUMERIC = f"""WITH {_HALVES}, {', '.join(_num_ctes(c) for c in _NUM)}, d AS ({' UNION ALL '.join(_num_sql(c) for c in _NUM)}),
  e AS (SELECT *, sqrt(n_ref * n_cur / (n_ref + n_cur)) AS en FROM d),
  l AS (SELECT *, (en + 0.12 + 0.11 / en) * ks AS lam FROM e),
  p AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
    lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0::DOUBLE * k * k * lam * lam))))) END AS ks_p FROM l),
  num AS (SELECT "column", n_ref, n_cur, psi, ks, ks_p, wasserstein, wasserstein AS drift_score,
    wasserstein >= 0.1 AS drifted FROM p)"""


@query("r1_numeric_drift", _NUMERIC + """ SELECT "column", n_ref, n_cur, round(psi, 6) AS psi, round(ks, 6) AS ks, round(ks_p, 6) AS ks_p,
  round(wasserstein, 6) AS wasserstein, round(drift_score, 6) AS drift_score, drifted FROM num""")
def _(spark, sf):
    return rounded(drift.numeric_drift(*_halves(spark, sf), _NUM))


@query("r1_merged_runs", ORACLES["r1_numeric_drift"])
def _(spark, sf):
    before, after = _halves(spark, sf)
    path, month = scratch(spark, "drift-states"), F.date_format("o_orderdate", "yyyy-MM")
    for rows in (before, after):
        drift_state.store(drift_state.summarise(rows, _NUM, [], month), path)
    states = drift_state.stored(spark, path)
    old, new = drift_state.merged(states, last="1999-12"), drift_state.merged(states, first="2000-01")
    return rounded(drift.numeric_drift(old, new, _NUM))


_CATS = [("o_orderstatus", "o_orderstatus"), ("o_orderpriority", "prio")]


def _cat_sql(name, c):
    return f"""SELECT '{name}' AS "column", max(na) AS n_ref, max(nb) AS n_cur,
      sum((greatest(b / nb, 0.0001) - greatest(a / na, 0.0001)) * ln(greatest(b / nb, 0.0001) / greatest(a / na, 0.0001))) AS psi,
      sqrt(greatest(0, sum(CASE WHEN a > 0 THEN a / na * ln(a / na / ((a / na + b / nb) / 2)) ELSE 0 END
        + CASE WHEN b > 0 THEN b / nb * ln(b / nb / ((a / na + b / nb) / 2)) ELSE 0 END) / 2)) AS js,
      sum(CASE WHEN a > 0 THEN (b - a / na * nb) ** 2 / (a / na * nb) END) AS chi_square, count(*) - 1 AS degrees
      FROM (SELECT *, CAST(sum(a) OVER () AS BIGINT) AS na, CAST(sum(b) OVER () AS BIGINT) AS nb FROM (SELECT {c}, count(*) FILTER (NOT late) AS a,
        count(*) FILTER (late) AS b FROM o GROUP BY 1))"""


_CATEGORICAL = " UNION ALL ".join(_cat_sql(n, c) for n, c in _CATS)
_CAT = f"""cat AS (SELECT *, js AS drift_score,
  js >= 0.1 AS drifted FROM ({_CATEGORICAL}))"""


@query("r2_categorical_drift", f"""WITH {_HALVES}, {_CAT} SELECT "column", n_ref, n_cur, round(psi, 6) AS psi, round(js, 6) AS js,
  round(chi_square, 4) AS chi_square, degrees, round(drift_score, 6) AS drift_score, drifted FROM cat""")
def _(spark, sf):
    out = drift.categorical_drift(*_halves(spark, sf), [n for n, _ in _CATS])
    return rounded(out.withColumn("chi_square", F.round("chi_square", 4)))


_CHI = ["o_orderstatus", "o_orderpriority", "o_custkey"]
_CHI_COUNTS = " UNION ALL ".join(f"""SELECT '{c}' AS "column", {c}::VARCHAR AS v, count(*) FILTER (o_orderdate < {_CUT}) AS a,
  count(*) FILTER (o_orderdate >= {_CUT}) AS b FROM orders WHERE {c} IS NOT NULL GROUP BY 2""" for c in _CHI)


# The twin sums the lower function's series term by term; the query takes a continued fraction where that is shorter.
@query("r2_chi_square_test", f"""WITH counts AS ({_CHI_COUNTS}),
  e AS (SELECT *, a * nb / na AS e FROM (SELECT *, sum(a) OVER w AS na, sum(b) OVER w AS nb FROM counts WINDOW w AS (PARTITION BY "column"))),
  cells AS (SELECT "column", max(na)::BIGINT AS n_ref, max(nb)::BIGINT AS n_cur, sum(e) AS e, sum(b) AS b,
    count(*) FILTER (e < 5) AS small FROM e GROUP BY "column", CASE WHEN e >= 5 THEN v END),
  t AS (SELECT "column", max(n_ref) AS n_ref, max(n_cur) AS n_cur, sum(small)::BIGINT AS n_pooled, sum((b - e) ** 2 / e) AS chi,
    count(*) - 1 AS degrees FROM cells GROUP BY 1),
  p AS (SELECT *, greatest(0, 1 - list_sum(list_transform(range(0, 40000), lambda n:
    exp((degrees / 2 + n) * ln(chi / 2) - chi / 2 - lgamma(degrees / 2 + n + 1))))) AS p FROM t)
  SELECT "column", n_ref, n_cur, n_pooled, round(chi, 4) AS chi_square, degrees, round(p, 6) AS p_value, p < 0.05 AS drifted FROM p""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderdate", *_CHI)
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    out = drift.chi_square_test(o.filter(~late), o.filter(late), _CHI)
    return rounded(out.withColumn("chi_square", F.round("chi_square", 4)))


def _columns(spark, sf):
    return drift.column_drift(*_halves(spark, sf), _NUM, [n for n, _ in _CATS])


_BOTH = _NUMERIC + f""", {_CAT}, allc AS (SELECT "column", drift_score, drifted FROM num UNION ALL SELECT "column", drift_score, drifted FROM cat)"""
_DATASET = _BOTH + """, ds AS (SELECT count(*) AS number_of_features, count(*) FILTER (drifted) AS number_of_drifted_features,
  avg(drifted::INT) AS share_of_drifted_features, avg(drifted::INT) > 0.5 AS dataset_drift, avg(drifted::INT) AS drift_score,
  string_agg("column", ',' ORDER BY "column") FILTER (drifted) AS names FROM allc)"""


@query("r3_dataset_drift", _DATASET + " SELECT * FROM ds")
def _(spark, sf):
    run = drift.dataset_drift(_columns(spark, sf))
    names = F.array_join(F.array_sort(F.map_keys("drifted_features")), ",")
    return run.withColumn("names", F.when(names != "", names)).drop("drifted_features")


@query("r4_drifted_features", _BOTH + """ SELECT "column", round(drift_score, 6) AS drift_score FROM allc
  WHERE drifted AND drift_score >= 0.15""")
def _(spark, sf):
    return rounded(drift.drifted_features(_columns(spark, sf), 0.15))


@query("r5_regression_performance", f"""WITH {_HALVES} SELECT count(*) AS n, round(sqrt(avg((amount - o_totalprice) ** 2)), 4) AS rmse,
  round(avg(abs(amount - o_totalprice)), 4) AS mae, round(1 - sum((amount - o_totalprice) ** 2) / (var_pop(amount) * count(*)), 6) AS r2,
  round(avg(abs((amount - o_totalprice) / amount)) * 100, 4) AS mape, round(max(abs(amount - o_totalprice)), 4) AS max_error FROM o WHERE late""")
def _(spark, sf):
    from wattspan.operators import evaluate
    from wattspan.plans.queries.training import _scores

    return _scores(evaluate.metrics(_halves(spark, sf)[1], "amount", "o_totalprice"))


@query("r6_alert", _DATASET + """, m AS (SELECT sqrt(avg((amount - o_totalprice) ** 2)) AS rmse FROM o WHERE late)
  SELECT share_of_drifted_features, round((rmse - 50000) / 50000, 6) AS performance_degradation,
    CASE WHEN share_of_drifted_features >= 0.5 OR (rmse - 50000) / 50000 >= 0.15 THEN 'CRITICAL'
      WHEN share_of_drifted_features >= 0.5::DOUBLE * 0.7 THEN 'WARNING' ELSE 'INFO' END AS severity FROM ds, m""")
def _(spark, sf):
    _, late = _halves(spark, sf)
    spec = jobs.MonitoringSpec(_NUM, [n for n, _ in _CATS], "amount", "o_totalprice")
    run = jobs.run_metrics(_columns(spark, sf), late, spec, "2000-06-01 00:00:00")
    out = drift.alert(run, 50000.0)
    return rounded(out.select("share_of_drifted_features", "performance_degradation", "severity"))


# ---- history -----------------------------------------------------------------------


def _history(spark, sf):
    """One run per day of events, with the ten history columns."""
    e = table(spark, sf, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("timestamp")
    share = F.avg((F.col("value") > 60).cast("double"))
    err = F.col("value") - 50
    # A zero value is infinitely far off, as in the SQL; a plain quotient is an error there.
    off = F.when(F.col("value") == 0, float("inf")).otherwise(F.abs(err / F.col("value")))
    return e.groupBy(day).agg(
        share.alias("drift_score"), share.alias("share_of_drifted_features"),
        F.count_if(F.col("value") > 60).alias("number_of_drifted_features"), (share > 0.5).alias("dataset_drift"),
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        F.when(F.dayofmonth("timestamp") % 4 != 0, 1 - F.avg(F.abs(err)) / 100).alias("r2_score"),
        F.avg(off).alias("mape"), F.lit(0.0).alias("rmse_degradation"),
    )


_HIST = """h AS (SELECT date_trunc('day', ts)::TIMESTAMP AS timestamp, avg((value > 60)::INT) AS drift_score,
  avg((value > 60)::INT) AS share_of_drifted_features, CAST(count(*) FILTER (value > 60) AS DOUBLE) AS number_of_drifted_features,
  sqrt(avg((value - 50) ** 2)) AS rmse, avg(abs(value - 50)) AS mae,
  CASE WHEN day(date_trunc('day', ts)) % 4 <> 0 THEN 1 - avg(abs(value - 50)) / 100 END AS r2_score,
  avg(abs((value - 50) / value)) AS mape, 0.0::DOUBLE AS rmse_degradation
  FROM events GROUP BY date_trunc('day', ts))"""
_ALL = history.TRACKED


def _hist_long(window, metrics=_ALL):
    parts = " UNION ALL ".join(f"SELECT timestamp, '{m}' AS metric, {m} AS value FROM w" for m in metrics)
    return f"""{_HIST}, w AS (SELECT * FROM h ORDER BY timestamp DESC LIMIT {window}),
      long AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY timestamp) - 1 AS pos FROM ({parts}) WHERE value IS NOT NULL)"""


_TREND = """CASE WHEN count(*) < 2 THEN NULL WHEN regr_slope(value, pos) > 0.001 THEN 'increasing'
  WHEN regr_slope(value, pos) < -0.001 THEN 'decreasing' ELSE 'stable' END"""
_STATS = """round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS "min", round(max(value), 6) AS "max",
  round(arg_max(value, timestamp), 6) AS latest"""
_Z = """CASE WHEN count(*) < 3 THEN NULL WHEN stddev_samp(value) = 0 THEN 0 ELSE abs((arg_max(value, timestamp) - avg(value)) / stddev_samp(value)) END"""


@query("s10_history_append", f"WITH {_HIST} SELECT count(*) AS n, round(sum(rmse), 6) AS rmse FROM h")
def _(spark, sf):
    path = scratch(spark, "history")
    io.append_history(_history(spark, sf), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("rmse"), 6).alias("rmse"))


@query("s11_history_scan", f"WITH {_HIST} SELECT timestamp, round(rmse, 6) AS rmse FROM h ORDER BY timestamp DESC LIMIT 5")
def _(spark, sf):
    path = scratch(spark, "history")
    io.append_history(_history(spark, sf), path)
    return rounded(io.read_history(spark, path, 5).select("timestamp", "rmse"))


@query("s12_retention", f"""WITH {_HIST} SELECT timestamp, round(rmse, 6) AS rmse FROM h
  WHERE timestamp >= (SELECT max(timestamp) FROM h) - INTERVAL 12 DAY""")
def _(spark, sf):
    path, kept = scratch(spark, "history"), scratch(spark, "retained")
    io.append_history(_history(spark, sf), path)
    io.rewrite_retained(spark, path, kept, 12)
    return rounded(spark.read.parquet(kept).select("timestamp", "rmse"))


@query("s12_remove_expired", f"""WITH {_HIST}, c AS (SELECT max(timestamp) - INTERVAL 12 DAY AS cut FROM h)
  SELECT timestamp, round(rmse, 6) AS rmse, (SELECT count(*) FROM h, c WHERE timestamp < cut) AS removed FROM h, c WHERE timestamp >= cut""")
def _(spark, sf):
    path = scratch(spark, "history")
    io.append_history(_history(spark, sf), path)
    removed = io.remove_expired(spark, path, 12)
    return rounded(spark.read.parquet(path).select("timestamp", "rmse", F.lit(removed).cast("bigint").alias("removed")))


@query("r7_trends", f"WITH {_hist_long(5)} SELECT metric, round(regr_slope(value, pos), 6) AS slope, {_TREND} AS trend FROM long GROUP BY 1")
def _(spark, sf):
    return rounded(history.trends(_history(spark, sf), _ALL))


@query("r8_summaries", f'WITH {_hist_long(30)} SELECT metric, {_STATS}, count(*) AS "count" FROM long GROUP BY 1')
def _(spark, sf):
    return rounded(history.summaries(_history(spark, sf), _ALL))


@query("r9_anomalies", f"""WITH {_hist_long(30)} SELECT metric, round(arg_max(value, timestamp), 6) AS latest, round({_Z}, 6) AS z_score,
  coalesce({_Z} > 2, FALSE) AS is_anomalous FROM long GROUP BY 1""")
def _(spark, sf):
    return rounded(history.anomalies(_history(spark, sf), _ALL))


@query("r10_trend_report", f"""WITH {_hist_long(10)} SELECT metric, {_STATS}, count(*) AS "count", round(regr_slope(value, pos), 6) AS slope,
  {_TREND} AS trend, round({_Z}, 6) AS z_score, coalesce({_Z} > 2, FALSE) AS is_anomalous FROM long GROUP BY 1""")
def _(spark, sf):
    return rounded(history.trend_report(_history(spark, sf)))


@query("r11_history_summary", f"""WITH {_hist_long(100, [*_ALL, 'mape', 'rmse_degradation'])} SELECT metric, {_STATS},
  (SELECT count(*) FROM w) AS total_records, (SELECT min(timestamp) FROM w) AS first_run, (SELECT max(timestamp) FROM w) AS last_run
  FROM long GROUP BY 1""")
def _(spark, sf):
    return rounded(history.history_summary(_history(spark, sf)))


@query("r12_monitoring_job", _DATASET + """, m AS (SELECT sqrt(avg((amount - o_totalprice) ** 2)) AS rmse FROM o WHERE late)
  SELECT number_of_drifted_features, dataset_drift, round(rmse, 4) AS rmse, 1::BIGINT AS runs, CASE WHEN share_of_drifted_features >= 0.5
    OR (rmse - 50000) / 50000 >= 0.15 THEN 'CRITICAL' WHEN share_of_drifted_features >= 0.5::DOUBLE * 0.7 THEN 'WARNING' ELSE 'INFO' END AS severity
  FROM ds, m""")
def _(spark, sf):
    ref, cur = _halves(spark, sf)
    spec = jobs.MonitoringSpec(_NUM, [n for n, _ in _CATS], "amount", "o_totalprice", 50000.0)
    path = scratch(spark, "history")
    out = jobs.monitoring_job(ref, cur.withColumn("extra", F.lit(1)), spec, "2000-06-01 00:00:00", path)
    runs = spark.read.parquet(path).agg(F.count(F.lit(1))).scalar()
    return out["alert"].select(
        "number_of_drifted_features", "dataset_drift", F.round("rmse", 4).alias("rmse"), "severity").withColumn("runs", runs)


@query("r13_log_drift", _DATASET + " SELECT number_of_features, number_of_drifted_features, dataset_drift FROM ds")
def _(spark, sf):
    keep = [*_NUM, *[n for n, _ in _CATS]]
    ref, cur = (df.select(*keep) for df in _halves(spark, sf))
    path = scratch(spark, "log")
    io.append_predictions(cur.withColumn("prediction", F.col("amount") * 2), path, F.lit("2000-06-01 00:00:00"))
    run = jobs.log_drift(ref, spark.read.parquet(path), "2000-06-01 00:00:00")
    return run.select("number_of_features", "number_of_drifted_features", "dataset_drift")


# ---- text logs ---------------------------------------------------------------------


# Endings with triggers; the prose of the table has none.
_ENDINGS = ["", " what will usage be tomorrow at 3 pm", " what if we shift it to low load", " why was there a spike on friday",
            " explain what is medium load at 10:30 am", " hoy at 12am with max load", " sábado, por qué", " the definition at 7 pm"]


def _messages(spark, sf):
    at = (F.col("conv_id") * 3 + F.col("turn")) % len(_ENDINGS)
    ending = F.element_at(F.array(*[F.lit(e) for e in _ENDINGS]), (at + 1).cast("int"))
    return table(spark, sf, "conversations").withColumn("text", F.concat(F.regexp_replace("text", "[0-9]", ""), ending))


_MESSAGES = ("m AS (SELECT conv_id, turn, lower(regexp_replace(text, '[0-9]', '', 'g') || [" + ", ".join(f"'{e}'" for e in _ENDINGS)
             + f"][(conv_id * 3 + turn) % {len(_ENDINGS)} + 1]) AS t FROM conversations)")


def _score_sql(patterns):
    return " + ".join("regexp_matches(t, '{}')::INT".format(textlog.whole_words(p).replace("'", "''")) for p in patterns)


_INTENT = ("WITH " + _MESSAGES + ", s AS (SELECT *, "
           + ", ".join(f"{_score_sql(ps)} AS s{i}" for i, ps in enumerate(textlog.INTENTS.values()))
           + " FROM m), g AS (SELECT *, greatest(s0, s1, s2, s3) AS b FROM s), tagged AS (SELECT conv_id, turn, CASE WHEN b = 0 THEN 'general' "
           + " ".join(f"WHEN s{i} = b THEN '{n}'" for i, n in enumerate(textlog.INTENTS)) + " END AS intent FROM g)")


@query("l1_intents", _INTENT + " SELECT * FROM tagged")
def _(spark, sf):
    return textlog.tag_intent(_messages(spark, sf), "text").select("conv_id", "turn", "intent")


@query("l1_intent_counts", _INTENT + " SELECT intent, count(*) AS n FROM tagged GROUP BY 1")
def _(spark, sf):
    return textlog.intent_counts(_messages(spark, sf), "text")


_TODAY = dt.date(2024, 1, 17)
_TIME = textlog.TIME_PATTERN


def _words_sql(words, default):
    q = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return "CASE " + " ".join(f"WHEN contains(t, '{w}') THEN {q(v)}" for w, v in words) + f" ELSE {q(default)} END"


_SLOTS = f"""WITH {_MESSAGES},
  p AS (SELECT *, TRY_CAST(regexp_extract(t, '{_TIME}', 1) AS INTEGER) AS h, coalesce(TRY_CAST(regexp_extract(t, '{_TIME}', 2) AS INTEGER), 0) AS mi,
    regexp_extract(t, '{_TIME}', 3) AS half FROM m),
  d AS (SELECT *, CASE WHEN contains(t, 'tomorrow') OR contains(t, 'mañana') THEN {(_TODAY + dt.timedelta(days=1)).weekday()}
      WHEN contains(t, 'today') OR contains(t, 'hoy') THEN {_TODAY.weekday()} ELSE {_words_sql(textlog.DAY_WORDS, 0)} END AS day FROM p)
  SELECT conv_id, turn, coalesce(CASE WHEN half = 'pm' AND h <> 12 THEN h + 12 WHEN half = 'am' AND h = 12 THEN 0 ELSE h END * 3600 + mi * 60, 36000) AS nsm,
    CAST(day AS INTEGER) AS day_of_week, {_words_sql(textlog.LOAD_WORDS, 'Medium')} AS load_type,
    CASE WHEN day < 5 THEN 'Weekday' ELSE 'Weekend' END AS week_status FROM d"""


@query("l2_slots", _SLOTS)
def _(spark, sf):
    out = textlog.extract_slots(_messages(spark, sf), "text", _TODAY)
    return out.select("conv_id", "turn", "nsm", "day_of_week", "load_type", "week_status")


@query("l3_last_turns", """SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
  FROM conversations) WHERE rn <= 3""")
def _(spark, sf):
    return textlog.last_turns(table(spark, sf, "conversations"), ["conv_id"], "turn", 3)


# ---- streams -----------------------------------------------------------------------


def _log(spark, sf, files=4):
    """The events as a folder of log files, with a readable stream over it."""
    path = scratch(spark, "events-log")
    ev = table(spark, sf, "events")
    ev.repartitionByRange(files, "ts").write.parquet(path)
    return streams.log_stream(spark, path, ev.schema)


@query("z1_window_statistics", """WITH w AS (SELECT date_trunc('hour', ts) AS s, event_type, count(*) AS n, avg(value) AS mean,
    stddev_samp(value) AS std, min(value) AS "min", max(value) AS "max" FROM events GROUP BY 1, 2)
  SELECT s AS start, s + INTERVAL 1 HOUR AS "end", event_type, n, round(mean, 6) AS mean, round(std, 6) AS std, "min", "max",
    s + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AS closed FROM w""")
def _(spark, sf):
    stream = streams.window_statistics(_log(spark, sf), "ts", ["event_type"], "value")
    out, check = scratch(spark, "windows"), scratch(spark, "windows-state")
    streams.run_window_statistics(stream, out, check).awaitTermination()
    written = spark.read.parquet(out)
    rest = streams.open_windows(table(spark, sf, "events"), written, "ts", ["event_type"], "value")
    df = written.withColumn("closed", F.lit(True)).unionByName(rest.withColumn("closed", F.lit(False)))
    return rounded(df.withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("end", F.col("end").cast("timestamp_ntz")))


@query("z2_stream_validation", """SELECT count(*) FILTER (value <= 100) AS accepted, count(*) FILTER (value > 100) AS rejected,
  CASE WHEN count(*) FILTER (value > 100) > 0 THEN 1 ELSE 0 END::BIGINT AS reasons FROM events""")
def _(spark, sf):
    good, bad, check = (scratch(spark, n) for n in ("accepted", "rejected", "validation-state"))
    streams.run_validation(_log(spark, sf), ["value", "user_id"], {"value": (0, 100)}, good, bad, check).awaitTermination()
    rejected = spark.read.parquet(bad)
    out = rejected.agg(F.count(F.lit(1)).alias("rejected"), F.countDistinct("error").alias("reasons"))
    return out.withColumn("accepted", spark.read.parquet(good).agg(F.count(F.lit(1))).scalar())


_PARTS = 3


def _part_sql(k):
    """Drift of the events with event_id % 3 = k against all events."""
    return f"""t{k} AS (SELECT count(*) AS na, count(*) FILTER (event_id % {_PARTS} = {k}) AS nb, stddev_pop(value) AS sd, max(ts) FILTER (event_id % {_PARTS} = {k}) AS seen FROM events),
    v{k} AS (SELECT value AS v, count(*) AS a, count(*) FILTER (event_id % {_PARTS} = {k}) AS b FROM events GROUP BY 1),
    r{k} AS (SELECT v, a, b, sum(a) OVER w AS ca, sum(b) OVER w AS cb, lag(v) OVER (ORDER BY v) AS pv FROM v{k}
      WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    w{k} AS (SELECT sum(abs(coalesce((ca - a) / na - (cb - b) / nb, 0)) * coalesce(v - pv, 0)) / max(sd) AS score FROM r{k}, t{k}),
    c{k} AS (SELECT event_type, count(*) / max(na) AS p, count(*) FILTER (event_id % {_PARTS} = {k}) / max(nb) AS q FROM events, t{k} GROUP BY 1),
    j{k} AS (SELECT sqrt(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2) AS score FROM c{k}),
    b{k} AS (SELECT nb AS "rows", seen AS timestamp, 'value' AS "column", round(w{k}.score, 6) AS drift_score, w{k}.score >= 0.1 AS drifted FROM t{k}, w{k}
      UNION ALL SELECT nb, seen, 'event_type', round(greatest(j{k}.score, 0), 6), j{k}.score >= 0.1 FROM t{k}, j{k})"""


@query("z3_stream_drift", f"""WITH {', '.join(_part_sql(k) for k in range(_PARTS))} """
       + " UNION ALL ".join(f"SELECT * FROM b{k}" for k in range(_PARTS)))
def _(spark, sf):
    ev = table(spark, sf, "events")
    log = scratch(spark, "events-log")
    for k in range(_PARTS):
        ev.filter(F.col("event_id") % _PARTS == k).coalesce(1).write.mode("append").parquet(log)
    hist, check = scratch(spark, "drift"), scratch(spark, "drift-state")
    stream = streams.log_stream(spark, log, ev.schema, files_per_batch=1)
    streams.run_drift(stream, ev, ["value"], ["event_type"], hist, check, "ts").awaitTermination()
    runs = spark.read.parquet(hist).select("rows", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), F.inline("columns"))
    return runs.select("rows", "timestamp", "column", r("drift_score").alias("drift_score"), "drifted")
