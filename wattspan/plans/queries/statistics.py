"""Grouped statistics, correlations, rankings, joins and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspan.operators import corr, evaluate, gramian, stats
from wattspan.operators.neighbours import neighbour_information
from wattspan.plans.queries.base import READINGS, exact_quantile_sql as eq, query, r, readings, rounded, table


def _group_sql(by, value, source):
    return f"""SELECT {by}, count(*) AS "count", round(avg({value}), 4) AS "avg", min({value}) AS "min",
      max({value}) AS "max", round(stddev_samp({value}), 4) AS "std" FROM {source} GROUP BY {by}"""


@query("a1_grouped_stats", _group_sql("event_type", "value", "events"))
def _(spark, sf):
    return rounded(stats.group_stats(table(spark, sf, "events"), ["event_type"], "value", digits=None), 4)


@query("a1_grouped_stats_items", _group_sql("l_returnflag", "l_extendedprice", "lineitem"))
def _(spark, sf):
    return rounded(stats.group_stats(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", None), 4)


for _unit, _n in (("hour", 3600), ("minute", 60), ("day", 86400)):
    @query(f"a2_{_unit}_bucket_stats", f"""WITH {READINGS} SELECT CAST(floor(nsm / {_n}) AS BIGINT) AS {_unit},
      count(*) AS records, round(avg(value), 6) AS avg_value, round(stddev_samp(value), 6) AS std_value
      FROM readings GROUP BY 1""")
    def _(spark, sf, unit=_unit):
        return rounded(stats.time_bucket_stats(readings(spark, sf), "nsm", "value", unit, None))


@query("a3_week_status_stats", f"WITH {READINGS} {_group_sql('week_status', 'value', 'readings')}")
def _(spark, sf):
    return rounded(stats.week_status_stats(readings(spark, sf), "week_status", "value", None), 4)


@query("a4_day_of_week_stats", f"""WITH {READINGS} SELECT day_of_week, count(*) AS "count",
  round(avg(value), 6) AS "avg" FROM readings GROUP BY 1""")
def _(spark, sf):
    return rounded(stats.day_of_week_stats(readings(spark, sf), "day_of_week", "value", None))


@query("a5_two_key_stats", f"WITH {READINGS} {_group_sql('event_type, day_of_week', 'value', 'readings')}")
def _(spark, sf):
    return rounded(stats.group_stats(readings(spark, sf), ["event_type", "day_of_week"], "value", None), 4)


@query("a6_mode", """SELECT c_mktsegment AS mode FROM customer WHERE c_mktsegment IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""")
def _(spark, sf):
    return stats.mode_value(table(spark, sf, "customer"), "c_mktsegment")


@query("a7_cardinality", """WITH c AS (SELECT p_type AS category, count(*) AS n FROM part GROUP BY 1)
  SELECT category, n, round(n / (SELECT count(*) FROM part), 6) AS share,
    (SELECT count(*) FROM c) AS n_categories, (SELECT count(*) FROM c) - 1 AS encoding_size,
    (SELECT category FROM c ORDER BY n DESC, category LIMIT 1) AS most_common,
    (SELECT category FROM c ORDER BY n, category DESC LIMIT 1) AS least_common FROM c""")
def _(spark, sf):
    return rounded(stats.cardinality(table(spark, sf, "part"), "p_type"))


_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _summary_sql(cols, source):
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean,
      round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
      round(quantile_cont({c}, 0.5), 4) AS median, CAST({eq(source, c, 0.25)} AS DOUBLE) AS q25,
      CAST({eq(source, c, 0.75)} AS DOUBLE) AS q75 FROM {source}""" for c in cols)


@query("a8_numeric_summary", _summary_sql(_LI, "lineitem"))
def _(spark, sf):
    return rounded(stats.numeric_summary(table(spark, sf, "lineitem"), _LI), 4)


@query("a9_feature_statistics", f"""WITH {READINGS} SELECT 'numeric' AS type, 'value' AS "column",
  round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS "min", max(value) AS "max",
  round(quantile_cont(value, 0.5), 6) AS median, NULL::BIGINT AS true_count, NULL::BIGINT AS false_count,
  NULL::DOUBLE AS true_pct FROM readings
  UNION ALL SELECT 'boolean', 'is_weekend', NULL, NULL, NULL, NULL, NULL, count(*) FILTER (dow >= 5),
  count(*) FILTER (dow < 5), round(count(*) FILTER (dow >= 5) / count(*) * 100, 6) FROM readings""")
def _(spark, sf):
    df = readings(spark, sf).withColumn("is_weekend", F.col("dow") >= 5)
    return rounded(stats.feature_statistics(df, ["value", "is_weekend"]))


_SPLIT = "CASE WHEN l_orderkey % 10 < 7 THEN 'train' WHEN l_orderkey % 10 < 9 THEN 'val' ELSE 'test' END"


def split_items(spark, sf):
    k = F.col("l_orderkey") % 10
    return table(spark, sf, "lineitem").withColumn(
        "split", F.when(k < 7, "train").when(k < 9, "val").otherwise("test"))


@query("a10_split_statistics", " UNION ALL ".join(f"""SELECT split, '{c}' AS "column", round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
  round(quantile_cont({c}, 0.5), 4) AS median FROM (SELECT *, {_SPLIT} AS split FROM lineitem) GROUP BY split"""
                                                  for c in ("l_quantity", "l_extendedprice")))
def _(spark, sf):
    return rounded(stats.split_statistics(split_items(spark, sf), "split", ["l_quantity", "l_extendedprice"]), 4)


@query("a10_split_category_counts", f"""SELECT split, 'l_returnflag' AS "column", l_returnflag AS category,
  count(*) AS n FROM (SELECT *, {_SPLIT} AS split FROM lineitem) GROUP BY 1, 3 UNION ALL
  SELECT split, 'l_linestatus', l_linestatus, count(*) FROM (SELECT *, {_SPLIT} AS split FROM lineitem) GROUP BY 1, 3""")
def _(spark, sf):
    return stats.split_category_counts(split_items(spark, sf), "split", ["l_returnflag", "l_linestatus"])


@query("a11_feature_types", """SELECT 'event_id' AS "column", 'numeric' AS kind UNION ALL SELECT 'ts', 'datetime'
  UNION ALL SELECT 'event_type', CASE WHEN (SELECT count(DISTINCT event_type) / count(*) FROM events) < 0.1
    THEN 'categorical' ELSE 'excluded' END
  UNION ALL SELECT 'props', CASE WHEN (SELECT count(DISTINCT props) / count(*) FROM events) < 0.1
    THEN 'categorical' ELSE 'excluded' END UNION ALL SELECT 'value', 'numeric'""")
def _(spark, sf):
    return stats.feature_types(table(spark, sf, "events"), exclude=["user_id"])


@query("a12_hour_weekday_matrix", f"""WITH {READINGS} SELECT CAST(nsm // 3600 AS INTEGER) AS hour, """
       + ", ".join(f"round(avg(value) FILTER (dow = {d}), 6) AS d{d}" for d in range(7))
       + " FROM readings GROUP BY 1")
def _(spark, sf):
    df = readings(spark, sf).withColumn("hour", F.floor(F.col("nsm") / 3600).cast("int"))
    return rounded(stats.hour_weekday_matrix(df, "hour", "dow", "value"))


@query("a13_hourly_profile", f"""WITH {READINGS}, p AS (SELECT CAST(nsm // 3600 AS INTEGER) AS bucket,
    avg(value) AS mean, stddev_samp(value) AS std, count(*) AS n FROM readings GROUP BY 1)
  SELECT bucket, round(mean, 6) AS mean, round(std, 6) AS std, n,
    bucket = (SELECT bucket FROM p ORDER BY mean DESC, bucket LIMIT 1) AS is_peak FROM p""")
def _(spark, sf):
    df = readings(spark, sf).withColumn("hour", F.floor(F.col("nsm") / 3600).cast("int"))
    return rounded(stats.usage_profile(df, "hour", "value"))


@query("a14_weekend_effect", f"""WITH {READINGS}, m AS (SELECT avg(value) FILTER (dow >= 5) AS we,
    avg(value) FILTER (dow < 5) AS wd FROM readings)
  SELECT round(we, 6) AS weekend_avg, round(wd, 6) AS weekday_avg, round((we - wd) / wd * 100, 6) AS difference_pct,
    round(wd - we, 6) AS saving_per_hour, round((wd - we) * 24, 6) AS saving_per_day,
    round((wd - we) * 24 * 104, 6) AS saving_per_year FROM m""")
def _(spark, sf):
    return rounded(stats.weekend_effect(readings(spark, sf), F.col("dow") >= 5, "value"))


for _how, _agg in (("mean", "avg(value)"), ("sum", "sum(value)"), ("median", "quantile_cont(value, 0.5)")):
    @query(f"a15_series_{_how}", f"""SELECT date_trunc('hour', ts) AS time, round({_agg}, 6) AS value
      FROM events GROUP BY 1""")
    def _(spark, sf, how=_how):
        ev = table(spark, sf, "events")
        hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
        return rounded(stats.series_by_time(ev, hour, "value", how))


@query("a16_histogram", """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
  b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
    FROM lineitem, e GROUP BY 1)
  SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 50 * g.bin, 4) AS lower,
    round(lo + (hi - lo) / 50 * (g.bin + 1), 4) AS upper, coalesce(n, 0) AS n
  FROM range(50) g(bin) LEFT JOIN b ON g.bin = b.bin, e""")
def _(spark, sf):
    return rounded(stats.histogram(table(spark, sf, "lineitem"), "l_extendedprice"), 4)


@query("a17_box_summary", """SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS minimum,
  round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
  round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, max(l_extendedprice) AS maximum FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return rounded(stats.box_summary(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice"), 4)


@query("a18_prediction_summary", """SELECT count(*) AS n, round(avg(l_quantity * 1000), 4) AS "avg",
  min(l_quantity * 1000) AS "min", max(l_quantity * 1000) AS "max" FROM lineitem""")
def _(spark, sf):
    scored = table(spark, sf, "lineitem").withColumn("prediction", F.col("l_quantity") * 1000)
    return rounded(stats.prediction_summary(scored), 4)


@query("a19_energy_cost", f"""WITH {READINGS} SELECT CAST(ts AS DATE) AS day, round(sum(value * 0.15), 5) AS base_cost,
  round(sum(CASE WHEN nsm // 3600 BETWEEN 9 AND 18 THEN value * 0.15 * 0.5 ELSE 0 END), 5) AS surcharge,
  round(sum(CASE WHEN nsm // 3600 BETWEEN 9 AND 18 THEN value * 0.15 * 1.5 ELSE value * 0.15 END), 5) AS total_cost,
  round(sum(CASE WHEN nsm // 3600 BETWEEN 9 AND 18 THEN value * 0.15 * 0.5 ELSE 0 END), 5) AS savings_potential
  FROM readings GROUP BY 1""")
def _(spark, sf):
    peak = F.floor(F.col("nsm") / 3600).between(9, 18)
    costed = stats.energy_cost(readings(spark, sf), "value", peak)
    return rounded(stats.cost_by_day(costed, F.to_date("ts")), 5)


@query("a20_power_factor_classes", """WITH p AS (SELECT ((1 - l_discount * 4) + (1 - l_tax)) / 2 AS m FROM lineitem)
  SELECT CASE WHEN m >= 0.95 THEN 'Excelente' WHEN m >= 0.90 THEN 'Muy Bueno' WHEN m >= 0.85 THEN 'Bueno'
    WHEN m >= 0.75 THEN 'Aceptable' ELSE 'Mejorable' END AS efficiency_class,
    CAST(CASE WHEN m >= 0.95 THEN 100 WHEN m >= 0.90 THEN 90 WHEN m >= 0.85 THEN 75
    WHEN m >= 0.75 THEN 60 ELSE 40 END AS INTEGER) AS efficiency_score,
    count(*) AS n, round(avg(greatest((0.95 - m) * 100, 0)), 6) AS mean_gap FROM p GROUP BY 1, 2""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(
        (1 - F.col("l_discount") * 4).alias("lag"), (1 - F.col("l_tax")).alias("lead"))
    classed = stats.power_factor_classes(li, "lag", "lead")
    return classed.groupBy("efficiency_class", "efficiency_score").agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("improvement_potential")).alias("mean_gap"))


_EMISSIONS = """SELECT value AS kwh, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value * (event_id % 8) * 0.00045::DOUBLE END AS co2 FROM events"""


@query("a20_emission_impact", f"""WITH e AS ({_EMISSIONS}), x AS (SELECT *, co2 / greatest(kwh, 0.001) AS x FROM e)
  SELECT CASE WHEN x <= 0.0008 THEN 'Bajo Impacto' WHEN x <= 0.0015 THEN 'Impacto Moderado Bajo' WHEN x <= 0.0025 THEN 'Impacto Moderado'
    WHEN x IS NOT NULL THEN 'Alto Impacto' END AS impact_class,
    CAST(CASE WHEN x <= 0.0008 THEN 100 WHEN x <= 0.0015 THEN 80 WHEN x <= 0.0025 THEN 60 WHEN x IS NOT NULL THEN 40 END AS INTEGER) AS impact_score,
    count(*) AS n, round(sum(co2 * 50), 4) AS trees, round(sum(co2 * 4500), 2) AS km FROM x GROUP BY 1, 2""")
def _(spark, sf):
    e = F.col("event_id")
    co2 = F.when(e % 11 != 0, F.col("value") * (e % 8) * 0.00045)
    out = stats.emission_impact(table(spark, sf, "events").select(F.col("value").alias("kwh"), co2.alias("co2")), "kwh", "co2")
    return out.groupBy("impact_class", "impact_score").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("trees_equivalent"), 4).alias("trees"), F.round(F.sum("car_km_equivalent"), 2).alias("km"))


# ---- correlation -------------------------------------------------------------------

_TARGET = "l_extendedprice"
_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("c1_correlation", "SELECT round(corr(l_quantity, l_extendedprice), 8) AS correlation FROM lineitem")
def _(spark, sf):
    return rounded(corr.pearson(table(spark, sf, "lineitem"), "l_quantity", _TARGET), 8)


def _corr_rows(features):
    return " UNION ALL ".join(f"""SELECT '{c}' AS feature, corr({c}, {_TARGET}) AS correlation,
      abs(corr({c}, {_TARGET})) AS abs_correlation FROM lineitem""" for c in features)


def _round_corr(features, extra=""):
    return f"""SELECT feature, round(correlation, 8) AS correlation, round(abs_correlation, 8) AS abs_correlation{extra}
      FROM ({_corr_rows(features)})"""


@query("c2_target_correlations", _round_corr(_FEATURES))
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*_FEATURES, _TARGET)
    return rounded(corr.correlations(li, _TARGET), 8)


@query("c3_listed_correlations", _round_corr(["l_quantity", "l_tax"]))
def _(spark, sf):
    return rounded(corr.correlations(table(spark, sf, "lineitem"), _TARGET, ["l_quantity", "l_tax"]), 8)


_MATRIX = ["l_quantity", "l_discount", "l_extendedprice"]


@query("c4_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS correlation FROM lineitem"
    for a in _MATRIX for b in _MATRIX))
def _(spark, sf):
    return rounded(corr.correlation_matrix(table(spark, sf, "lineitem"), _MATRIX), 8)


# Missing values in other rows of each column, and a constant one.
_SPARSE = {
    "quantity": "CASE WHEN l_orderkey % 3 <> 0 THEN l_quantity END", "discount": "CASE WHEN l_linenumber <> 2 THEN l_discount END",
    "price": "l_extendedprice", "tax": "CASE WHEN l_orderkey % 3 = 0 THEN l_tax ELSE l_quantity END", "flat": "CAST(1.5 AS DOUBLE)"}


@query("c4_pairwise_complete", "WITH s AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _SPARSE.items()) + " FROM lineitem) "
       + " UNION ALL ".join(
           f"""SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n,
             CASE WHEN '{b}' <> 'flat' THEN round(corr({a}, {b}), 8) END AS correlation FROM s"""
           for i, a in enumerate(_SPARSE) for b in list(_SPARSE)[i + 1:]))
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(*[F.expr(e).alias(c) for c, e in _SPARSE.items()])
    return rounded(gramian.pairwise_correlations(df, list(_SPARSE), 2), 8)


@query("c5_top_correlated", _round_corr(
    ["l_quantity", "l_discount", "l_linenumber"],
    ", CASE WHEN correlation >= 0 THEN 'positive' ELSE 'negative' END AS sign") + " ORDER BY abs_correlation DESC LIMIT 2")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*_FEATURES, _TARGET)
    return rounded(corr.top_correlated(li, _TARGET, 2, ["l_tax"]), 8)


def _edges(c):
    return " + ".join(f"({c} > (SELECT e{i} FROM edges_{c}))::INT" for i in range(1, 10))


def _edge_cte(c):
    vals = ", ".join(f"max({c}) FILTER (rk = round({i / 10} * (n - 1))) AS e{i}" for i in range(1, 10))
    return f"""edges_{c} AS (SELECT {vals} FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS rk,
      count(*) OVER () AS n FROM lineitem))"""


_MI = ["l_quantity", "l_discount", "l_tax"]


@query("c6_mutual_information", "WITH " + ", ".join(_edge_cte(c) for c in [*_MI, _TARGET]) + """,
  b AS (SELECT """ + ", ".join(f"{_edges(c)} AS b_{c}" for c in [*_MI, _TARGET]) + """ FROM lineitem),
  long AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, b_{c} AS f, b_{_TARGET} AS t FROM b" for c in _MI) + """),
  j AS (SELECT feature, f, t, count(*) AS c FROM long GROUP BY ALL),
  k AS (SELECT *, sum(c) OVER (PARTITION BY feature, f) AS cx, sum(c) OVER (PARTITION BY feature, t) AS cy,
    sum(c) OVER (PARTITION BY feature) AS n FROM j)
  SELECT feature, round(CAST(sum(c / n * ln(c * n / (cx * cy))) AS DOUBLE), 6) AS mi_score FROM k GROUP BY feature""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*_MI, _TARGET)
    return rounded(corr.mutual_information(li, _TARGET))


_NEAR = ["p_size", "p_partkey"]


@query("c6_neighbour_information", "WITH z AS (" + " UNION ALL ".join(f"""SELECT '{c}' AS feature, p_partkey AS i,
    {c} / stddev_pop({c}) OVER () AS x, p_retailprice / stddev_pop(p_retailprice) OVER () AS y FROM part""" for c in _NEAR) + """),
  r AS MATERIALIZED (SELECT a.feature, a.i, a.x, a.y, min(greatest(abs(a.x - b.x), abs(a.y - b.y)), 3)[3] AS r
    FROM z a JOIN z b ON a.feature = b.feature AND a.i <> b.i GROUP BY ALL),
  c AS MATERIALIZED (SELECT r.feature, r.i,
      count(*) FILTER (abs(r.x - b.x) < r * (1 - 1e-9) OR (r = 0 AND r.x = b.x)) AS nx,
      count(*) FILTER (abs(r.y - b.y) < r * (1 - 1e-9) OR (r = 0 AND r.y = b.y)) AS ny
    FROM r JOIN z b ON r.feature = b.feature GROUP BY ALL),
  psi AS (SELECT k AS m, -0.5772156649015329 + coalesce(sum(1.0::DOUBLE / k) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS v
    FROM range(1, (SELECT count(*) + 2 FROM part)) t(k))
  SELECT feature, round(greatest(0, (SELECT v FROM psi WHERE m = (SELECT count(*) FROM part)) + (SELECT v FROM psi WHERE m = 3)
    - avg(p.v + q.v)), 6) AS mi_score FROM c JOIN psi p ON p.m = nx JOIN psi q ON q.m = ny GROUP BY feature""")
def _(spark, sf):
    return rounded(neighbour_information(table(spark, sf, "part").select(*_NEAR, "p_retailprice"), "p_retailprice"))


@query("c7_top_features", _round_corr(_FEATURES) + " ORDER BY abs_correlation DESC LIMIT 3")
def _(spark, sf):
    scores = corr.correlations(table(spark, sf, "lineitem"), _TARGET, _FEATURES)
    return rounded(corr.top_features(scores, "abs_correlation", 3), 8)


@query("c8_compare_rankings", f"""WITH a AS (SELECT feature FROM ({_corr_rows(_FEATURES)}) ORDER BY abs_correlation DESC LIMIT 2),
  b AS (SELECT feature FROM (SELECT 'l_quantity' AS feature, stddev_samp(l_quantity) AS s FROM lineitem
    UNION ALL SELECT 'l_discount', stddev_samp(l_discount) FROM lineitem
    UNION ALL SELECT 'l_tax', stddev_samp(l_tax) FROM lineitem
    UNION ALL SELECT 'l_linenumber', stddev_samp(l_linenumber) FROM lineitem) ORDER BY s DESC LIMIT 2),
  u AS (SELECT coalesce(a.feature, b.feature) AS f, a.feature IS NOT NULL AS ia, b.feature IS NOT NULL AS ib
    FROM a FULL JOIN b ON a.feature = b.feature)
  SELECT coalesce(string_agg(f, ',' ORDER BY f) FILTER (ia AND ib), '') AS common_features,
    coalesce(string_agg(f, ',' ORDER BY f) FILTER (ia AND NOT ib), '') AS a_only,
    coalesce(string_agg(f, ',' ORDER BY f) FILTER (ib AND NOT ia), '') AS b_only,
    count(*) FILTER (ia AND ib) / 2 * 100 AS overlap_pct, count(*) FILTER (ia AND ib) AS n_common,
    count(*) FILTER (ia AND NOT ib) AS n_a_only, count(*) FILTER (ib AND NOT ia) AS n_b_only FROM u""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*_FEATURES, _TARGET)
    a = corr.correlations(li, _TARGET)
    b = stats.numeric_summary(li, _FEATURES, quartiles=False).select(F.col("column").alias("feature"), "std")
    return corr.compare_rankings(a, b, "abs_correlation", "std", 2)


@query("c9_trend_line", """SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 8) AS r2 FROM lineitem""")
def _(spark, sf):
    out = corr.trend_line(table(spark, sf, "lineitem"), "l_quantity", _TARGET)
    return out.select(r("slope").alias("slope"), r("intercept", 4).alias("intercept"), r("r2", 8).alias("r2"))


# ---- joins and sets ----------------------------------------------------------------


@query("j1_inner_join_suffix", """SELECT o.o_custkey, c.c_custkey AS o_custkey_clean, o_orderkey, c_mktsegment
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey_clean"), "c_mktsegment")
    return o.join(c, o.o_custkey == c.o_custkey_clean)


@query("j2_full_outer_join", """SELECT coalesce(a.event_type, b.event_type) AS event_type, a.n AS n_first, b.n AS n_second
  FROM (SELECT event_type, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1) a
  FULL JOIN (SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1) b
  ON a.event_type = b.event_type""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    a = ev.filter("event_id % 2 = 0").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_first"))
    b = ev.filter("event_type <> 'view'").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_second"))
    return a.join(b, "event_type", "full_outer")


@query("j3_row_intersection", """SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'
  INTERSECT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    side = lambda f: li.filter(F.col("l_returnflag") == f).select("l_partkey", "l_suppkey")
    return side("A").intersect(side("R"))


@query("j4_set_difference", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    buyers = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_custkey")
    return table(spark, sf, "customer").select("c_custkey").subtract(buyers)


@query("j5_union", "SELECT c_custkey AS k, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("k"))
    return c.unionByName(s)


# ---- top rows ----------------------------------------------------------------------


@query("k1_top_rows", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 10")
def _(spark, sf):
    return stats.top_rows(table(spark, sf, "events"), "value", 10, columns=["event_id", "value"], tiebreak=["event_id"])


@query("k1_bottom_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5")
def _(spark, sf):
    return stats.top_rows(table(spark, sf, "orders"), "o_totalprice", 5, True, ["o_orderkey", "o_totalprice"],
                          ["o_orderkey"])


@query("k2_limit", "SELECT least(count(*), 7) AS n FROM events")
def _(spark, sf):
    return table(spark, sf, "events").limit(7).agg(F.count(F.lit(1)).alias("n"))


@query("k3_best_by_metric", """SELECT event_type AS best, round(s, 6) AS rmse FROM (SELECT event_type,
  sqrt(avg((value - 50) * (value - 50))) AS s FROM events GROUP BY 1) ORDER BY s, event_type LIMIT 1""")
def _(spark, sf):
    ev = table(spark, sf, "events").withColumn("guess", F.lit(50.0))
    return rounded(stats.best_by(evaluate.metrics(ev, "value", "guess", ["event_type"]), "event_type", "rmse"))


# ---- NaN, null and infinite values -------------------------------------------------

_HOLES = """holes AS (SELECT event_id, CASE WHEN event_id % 100 = 3 THEN 'NaN'::DOUBLE WHEN event_id % 100 = 5 THEN NULL
  WHEN event_id = 77 THEN 'Infinity'::DOUBLE ELSE value END AS v FROM events)"""


def _holes(spark, sf):
    e = F.col("event_id")
    v = F.when(e % 100 == 3, float("nan")).when(e % 100 == 5, None).when(e == 77, float("inf")).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", v.alias("v"))


@query("a16_histogram_nan", f"""WITH {_HOLES}, k AS (SELECT v FROM holes WHERE v IS NOT NULL AND isfinite(v)),
  e AS (SELECT min(v) AS lo, max(v) AS hi FROM k),
  b AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n FROM k, e GROUP BY 1)
  SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 20 * g.bin, 4) AS lower,
    round(lo + (hi - lo) / 20 * (g.bin + 1), 4) AS upper, coalesce(n, 0) AS n
  FROM range(20) g(bin) LEFT JOIN b ON g.bin = b.bin, e""")
def _(spark, sf):
    return rounded(stats.histogram(_holes(spark, sf), "v", 20), 4)


@query("o6_zscore_report_nan", f"""WITH {_HOLES}, k AS (SELECT v FROM holes WHERE v IS NOT NULL AND isfinite(v)),
  s AS (SELECT avg(v) AS m, stddev_samp(v) AS d FROM k)
  SELECT 'v' AS "column", count(*) FILTER (abs((v - m) / d) > 1.5) AS outlier_count,
    round(count(*) FILTER (abs((v - m) / d) > 1.5) * 100.0 / (SELECT count(*) FROM holes WHERE event_id <> 77), 2) AS outlier_pct,
    (SELECT count(*) FROM holes WHERE event_id <> 77) AS total_count, round(any_value(m), 6) AS mean, round(any_value(d), 6) AS std FROM k, s""")
def _(spark, sf):
    from wattspan.operators import outliers

    return rounded(outliers.zscore_report(_holes(spark, sf).filter("event_id <> 77").select("v"), threshold=1.5))


@query("a8_quartiles_infinity", f"""WITH {_HOLES}, k AS (SELECT v FROM holes WHERE v IS NOT NULL AND NOT isnan(v))
  SELECT 'v' AS "column", min(v) AS q0, round(quantile_cont(v, 0.5), 6) AS q1, max(v) AS q2, count(*) AS n FROM k""")
def _(spark, sf):
    from wattspan.operators.quantiles import exact_quantiles

    return rounded(exact_quantiles(_holes(spark, sf), ["v"], [0.0, 0.5, 1.0]))
