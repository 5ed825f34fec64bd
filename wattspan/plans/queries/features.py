"""Temporal features, encoders, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspan.functions import temporal as t
from wattspan.operators import category_tables, prep, split, stats, temporal
from wattspan.plans.cleaning import clean_readings
from wattspan.plans.queries.cleaning import CLEAN_SQL, READING_SPEC
from wattspan.plans.queries.base import READINGS, dirty_csv, query, r, readings, rounded, scratch, table

_TAU = "2 * pi()"


def _named(spark, sf):
    """Readings with the meter file's own column names."""
    return readings(spark, sf).select("event_id", "value", F.col("nsm").alias("NSM"), F.col("day_of_week").alias("Day_of_week"))


@query("f1_hour_clamped", f"""WITH {READINGS}, n AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 86400 ELSE nsm END AS nsm
  FROM readings) SELECT event_id, CASE WHEN nsm >= 86400 THEN 23 ELSE CAST(nsm // 3600 AS INTEGER) END AS hour FROM n""")
def _(spark, sf):
    df = readings(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 50 == 0, 86400).otherwise(F.col("nsm")).alias("nsm"))
    return temporal.add_hour(df, "nsm").select("event_id", "hour")


@query("f1_nsm_range", f"""WITH {READINGS} SELECT count(*) FILTER (nsm * 2 < 0 OR nsm * 2 > 86400) AS out_of_range,
  count(*) FILTER (nsm IS NULL) AS null_values FROM readings""")
def _(spark, sf):
    return temporal.nsm_range(readings(spark, sf).select((F.col("nsm") * 2).alias("NSM")))


@query("f2_hour_unclamped", f"""WITH {READINGS}, n AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 86400 ELSE nsm END AS nsm
  FROM readings) SELECT event_id, CAST(nsm // 3600 AS INTEGER) AS hour FROM n""")
def _(spark, sf):
    df = readings(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 50 == 0, 86400).otherwise(F.col("nsm")).alias("nsm"))
    return temporal.add_hour(df, "nsm", clamp=False).select("event_id", "hour")


@query("f3_day_number", f"WITH {READINGS} SELECT event_id, dow AS day_num FROM readings")
def _(spark, sf):
    return temporal.add_day_of_week(_named(spark, sf), "Day_of_week", "day_num").select("event_id", "day_num")


@query("f3_unknown_days", "SELECT count(*) FILTER (event_id % 10 = 0) AS invalid_days FROM events")
def _(spark, sf):
    name = F.when(F.col("event_id") % 20 == 0, "Funday").when(F.col("event_id") % 10 != 0, F.col("day_of_week"))
    return temporal.unknown_days(readings(spark, sf).select(name.alias("Day_of_week")))


@query("f4_weekend_by_number", f"WITH {READINGS} SELECT event_id, dow >= 5 AS is_weekend FROM readings")
def _(spark, sf):
    return temporal.add_is_weekend(readings(spark, sf), "dow").select("event_id", "is_weekend")


@query("f5_weekend_by_name", f"""WITH {READINGS} SELECT event_id, CAST(day_of_week IN ('Saturday', 'Sunday') AS INTEGER)
  AS is_weekend FROM readings""")
def _(spark, sf):
    stage = temporal.WeekendNameStage(inputCol="Day_of_week", outputCol="is_weekend")
    return stage.transform(_named(spark, sf)).select("event_id", "is_weekend")


@query("f6_cyclical", f"""WITH {READINGS} SELECT event_id, round(sin({_TAU} * dow / 7), 8) + 0 AS cyclical_dow_sin,
  round(cos({_TAU} * dow / 7), 8) + 0 AS cyclical_dow_cos FROM readings""")
def _(spark, sf):
    df = readings(spark, sf).select("event_id", "dow")
    return rounded(temporal.add_cyclical(df, "dow", 7).drop("dow"), 8)


_F7 = f"""event_id, CAST(nsm // 3600 AS INTEGER) AS hour, dow AS day_of_week, dow >= 5 AS is_weekend,
  round(sin({_TAU} * (nsm // 3600) / 24), 8) + 0 AS cyclical_hour_sin, round(cos({_TAU} * (nsm // 3600) / 24), 8) + 0 AS cyclical_hour_cos,
  round(sin({_TAU} * dow / 7), 8) + 0 AS cyclical_day_sin, round(cos({_TAU} * dow / 7), 8) + 0 AS cyclical_day_cos"""
_F7_COLS = ["event_id", "hour", "day_of_week", "is_weekend", "cyclical_hour_sin", "cyclical_hour_cos",
            "cyclical_day_sin", "cyclical_day_cos"]


@query("f7_temporal_features", f"WITH {READINGS} SELECT {_F7} FROM readings")
def _(spark, sf):
    return rounded(temporal.add_temporal_features(_named(spark, sf)).select(*_F7_COLS), 8)


@query("f8_day_parts", f"""WITH {READINGS}, h AS (SELECT event_id, nsm, CAST(nsm // 3600 AS INTEGER) AS hour FROM readings)
  SELECT event_id, hour, CAST(nsm % 3600 // 60 AS INTEGER) AS minute, CAST(hour >= 22 OR hour <= 6 AS INTEGER) AS is_night,
    CAST(hour BETWEEN 9 AND 18 AS INTEGER) AS is_peak_hour, CASE WHEN hour <= 6 THEN 'night' WHEN hour <= 12 THEN 'morning'
    WHEN hour <= 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day FROM h""")
def _(spark, sf):
    return temporal.add_day_parts(readings(spark, sf).select("event_id", "nsm"), "nsm", drop_original=True)


@query("f9_day_name_features", f"""WITH {READINGS} SELECT event_id, dow AS day_num, round(sin({_TAU} * dow / 7), 8) + 0 AS day_sin,
  round(cos({_TAU} * dow / 7), 8) + 0 AS day_cos, CAST(dow >= 5 AS INTEGER) AS is_weekend FROM readings""")
def _(spark, sf):
    return rounded(temporal.add_day_name_features(_named(spark, sf).select("event_id", "Day_of_week")).drop("Day_of_week"), 8)


@query("f10_calendar_parts", f"""SELECT o_orderkey, CAST(hour(o_orderdate) AS INTEGER) AS hour, CAST(day(o_orderdate) AS INTEGER) AS day,
  CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
  round(sin({_TAU} * hour(o_orderdate) / 24), 8) + 0 AS hour_sin, round(cos({_TAU} * hour(o_orderdate) / 24), 8) + 0 AS hour_cos,
  round(sin({_TAU} * day(o_orderdate) / 31), 8) + 0 AS day_sin, round(cos({_TAU} * day(o_orderdate) / 31), 8) + 0 AS day_cos,
  round(sin({_TAU} * month(o_orderdate) / 12), 8) + 0 AS month_sin, round(cos({_TAU} * month(o_orderdate) / 12), 8) + 0 AS month_cos
  FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return rounded(temporal.add_calendar_parts(o, "o_orderdate").drop("o_orderdate"), 8)


@query("f11_feature_stages", f"""WITH {READINGS} SELECT event_id, CAST(nsm // 3600 AS INTEGER) AS hour,
  round(sin({_TAU} * (nsm // 3600) / 24), 8) + 0 AS hour_sin, round(cos({_TAU} * (nsm // 3600) / 24), 8) + 0 AS hour_cos,
  CAST(dow >= 5 AS INTEGER) AS is_weekend FROM readings""")
def _(spark, sf):
    stages, names = temporal.feature_stages(
        temporal.HourStage(), temporal.CyclicalStage(inputCol="hour", outputCol="hour", period=24.0),
        temporal.WeekendNameStage())
    df = _named(spark, sf)
    return rounded(stages.fit(df).transform(df).select("event_id", *names), 8)


@query("f12_request_features", f"""WITH {READINGS} SELECT event_id, day_of_week AS day_name, week_status,
  CAST(nsm // 3600 AS INTEGER) AS hour, dow >= 5 AS is_weekend,
  round(sin({_TAU} * (nsm // 3600) / 24), 8) + 0 AS cyclical_hour_sin, round(cos({_TAU} * (nsm // 3600) / 24), 8) + 0 AS cyclical_hour_cos,
  round(sin({_TAU} * dow / 7), 8) + 0 AS cyclical_day_sin, round(cos({_TAU} * dow / 7), 8) + 0 AS cyclical_day_cos FROM readings""")
def _(spark, sf):
    req = readings(spark, sf).select("event_id", "nsm", "dow")
    return rounded(temporal.request_features(req, "dow").drop("nsm", "dow"), 8)


# ---- scaling and encoding ----------------------------------------------------------

_NUM = ["l_quantity", "l_extendedprice"]


@query("e1_standard_scaling", """WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
    avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem WHERE l_orderkey % 10 < 7)
  SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_extendedprice - mp) / sp, 6) AS l_extendedprice
  FROM lineitem, s""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_NUM)
    model = prep.NumericScaler(columns=_NUM).fit(li.filter("l_orderkey % 10 < 7"))
    return rounded(model.transform(li))


@query("e2_one_hot", """SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
  CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return prep.CategoryEncoder(columns=["o_orderstatus"]).fit(o).transform(o)


@query("e2_category_index", """WITH k AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c FROM orders)
  SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY c) - 1 AS BIGINT) AS c_index FROM k""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("c"))
    return prep.index_categories(o, prep.category_table(o, ["c"]), ["c"]).select("o_orderkey", "c_index")


@query("e2_table_encoder", """WITH k AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c FROM orders),
  s AS (SELECT greatest(count(DISTINCT c) FILTER (c NOT LIKE '%7') - 1, 1) AS width FROM k),
  d AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i FROM (SELECT DISTINCT c FROM k WHERE c NOT LIKE '%7'))
  SELECT o_orderkey, CAST(i AS BIGINT) AS c_index,
    CASE WHEN i > 0 THEN concat('(', width, ',[', i - 1, '],[1.0])') ELSE concat('(', width, ',[],[])') END AS c_vector
  FROM k LEFT JOIN d USING (c), s""")
def _(spark, sf):
    from pyspark.ml import Pipeline, PipelineModel

    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("c"))
    path = scratch(spark, "category-tables")
    stage = category_tables.TableEncoder(columns=["c"])
    Pipeline(stages=[stage]).fit(o.filter("c NOT LIKE '%7'")).write().save(path)
    return PipelineModel.load(path).transform(o).withColumn("c_vector", F.col("c_vector").cast("string"))


@query("e2_one_hot_unknown", """SELECT o_orderkey, CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS "o_orderpriority_2-HIGH"
  FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    seen = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return prep.CategoryEncoder(columns=["o_orderpriority"]).fit(seen).transform(o)


@query("e3_map_binary", f"""WITH {READINGS} SELECT event_id, CASE week_status WHEN 'Weekday' THEN 0 WHEN 'Weekend' THEN 1 END
  AS week_status FROM readings""")
def _(spark, sf):
    df = readings(spark, sf).select("event_id", "week_status")
    return prep.map_binary(df, "week_status", {"Weekday": 0, "Weekend": 1})


@query("e4_ordinal", """SELECT p_partkey, CAST((SELECT count(DISTINCT p_type) FROM part q WHERE q.p_type < p.p_type) AS INTEGER)
  AS p_type FROM part p""")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    return prep.ordinal(part, "p_type", prep.sorted_order(part, "p_type"))


_E5 = f"""WITH {READINGS}, s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM readings)
  SELECT event_id, round((value - m) / d, 6) AS value, CASE week_status WHEN 'Weekday' THEN 0 WHEN 'Weekend' THEN 1 END AS week_status,
    CAST(event_type = 'error' AS INTEGER) AS event_type_error, CAST(event_type = 'purchase' AS INTEGER) AS event_type_purchase,
    CAST(event_type = 'signup' AS INTEGER) AS event_type_signup, CAST(event_type = 'view' AS INTEGER) AS event_type_view"""


@query("e5_preprocessing_saved", _E5 + " FROM readings, s")
def _(spark, sf):
    from pyspark.ml import PipelineModel

    df = readings(spark, sf)
    stages = prep.preprocessing(["value"], ["event_type"], {"week_status": {"Weekday": 0, "Weekend": 1}}, ["event_id"])
    path = scratch(spark, "preprocessing")
    stages.fit(df).write().save(path)
    return rounded(PipelineModel.load(path).transform(df))


@query("e6_column_transformer", _E5 + ", user_id, dow FROM readings, s")
def _(spark, sf):
    df = readings(spark, sf).drop("ts", "nsm", "day_of_week")
    stages = prep.preprocessing(
        ["value"], ["event_type"], {"week_status": {"Weekday": 0, "Weekend": 1}}, passthrough=True)
    return rounded(stages.fit(df).transform(df))


@query("e7_inverse_scaling", "SELECT o_orderkey, round(o_totalprice, 4) AS restored FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    model = prep.NumericScaler(columns=["o_totalprice"]).fit(o)
    scaled = model.transform(o)
    return scaled.select("o_orderkey", r(model.unscaled(F.col("o_totalprice"), "o_totalprice"), 4).alias("restored"))


# ---- splits and samples ------------------------------------------------------------


@query("x1_stratified_split", """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
  b AS (SELECT o_orderkey, CAST(least(floor((o_totalprice - lo) * 10 / (hi - lo)) + 1, 10) AS INTEGER) AS bin,
    md5(concat('42|', o_orderkey)) AS h FROM orders, e),
  k AS (SELECT o_orderkey, row_number() OVER (PARTITION BY bin ORDER BY h) AS rn, count(*) OVER (PARTITION BY bin) AS n FROM b)
  SELECT o_orderkey, CASE WHEN rn <= round(n * 0.70::DOUBLE) THEN 'train'
    WHEN rn <= round(n * (0.70::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM k""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return split.stratified_split(o, "o_totalprice", "o_orderkey").drop("o_totalprice")


def _strata_sql(stratum, source="orders"):
    return f"""WITH b AS (SELECT o_orderkey, {stratum} AS bin, md5(concat('42|', o_orderkey)) AS h FROM {source}),
  k AS (SELECT o_orderkey, row_number() OVER (PARTITION BY bin ORDER BY h) AS rn, count(*) OVER (PARTITION BY bin) AS n FROM b)
  SELECT o_orderkey, CASE WHEN rn <= round(n * 0.70::DOUBLE) THEN 'train'
    WHEN rn <= round(n * (0.70::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM k"""


_SOME_PRIORITY = "CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END"
_SOME_PRICE = """CASE WHEN o_orderkey % 10 < 2 THEN 0 ELSE CAST(least(floor((o_totalprice - lo) * 10 / (hi - lo)) + 1, 10) AS INTEGER) END"""


@query("x1_stratified_split_category", _strata_sql(_SOME_PRIORITY))
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(_SOME_PRIORITY).alias("c"))
    return split.stratified_split(o, "c", "o_orderkey").drop("c")


@query("x1_stratified_split_nulls", _strata_sql(_SOME_PRICE, """orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi
    FROM orders WHERE o_orderkey % 10 >= 2)"""))
def _(spark, sf):
    k = F.col("o_orderkey") % 10
    price = F.when(k == 0, None).when(k == 1, float("nan")).otherwise(F.col("o_totalprice"))
    o = table(spark, sf, "orders").select("o_orderkey", price.alias("p"))
    return split.stratified_split(o, "p", "o_orderkey").drop("p")


@query("x2_temporal_split", """WITH k AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos,
    count(*) OVER () AS n FROM orders)
  SELECT o_orderkey, CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train'
    WHEN pos < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM k""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return split.temporal_split(o, "o_orderdate", "o_orderkey").drop("o_orderdate")


@query("x3_stratified_sample", """WITH k AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type
    ORDER BY md5(concat('42|', event_id))) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events)
  SELECT event_id, event_type FROM k WHERE rn <= floor(500 * (n / (SELECT count(*) FROM events)))""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return split.stratified_sample(ev, "event_type", "event_id", 500)


@query("x4_random_sample", "SELECT event_id FROM events ORDER BY md5(concat('42|', event_id)) LIMIT 300")
def _(spark, sf):
    return split.random_sample(table(spark, sf, "events").select("event_id"), "event_id", 300)


@query("x5_stratum_distribution", """SELECT event_type, count(*) AS "count",
  round(count(*) / (SELECT count(*) FROM events) * 100, 6) AS percentage FROM events GROUP BY 1""")
def _(spark, sf):
    return rounded(split.stratum_distribution(table(spark, sf, "events"), "event_type"))


@query("x6_kfold", """SELECT o_orderkey, CAST((row_number() OVER (ORDER BY md5(concat('42|', o_orderkey))) - 1) % 5 AS INTEGER)
  AS fold FROM orders""")
def _(spark, sf):
    return split.kfold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("x7_random_split", """WITH u AS (SELECT o_orderkey, CAST(CAST('0x' || md5(concat('42|', o_orderkey))[1:8] AS BIGINT) AS DOUBLE)
    / 4294967296 AS u FROM orders)
  SELECT o_orderkey, CASE WHEN u < 1.0::DOUBLE - 0.2::DOUBLE - 0.2::DOUBLE THEN 'train' WHEN u < 1.0::DOUBLE - 0.2::DOUBLE
    THEN 'val' ELSE 'test' END AS split FROM u""")
def _(spark, sf):
    return split.random_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("hourly_profile_of_cleaned", CLEAN_SQL + """ SELECT load_type, CASE WHEN nsm >= 86400 THEN 23
  ELSE CAST(nsm // 3600 AS INTEGER) END AS hour, count(*) AS "count", round(avg(usage), 8) AS "avg",
  round(min(usage), 8) AS "min", round(max(usage), 8) AS "max", round(stddev_samp(usage), 8) AS "std"
  FROM cleaned GROUP BY 1, 2""")
def _(spark, sf):
    """Cleaned readings, temporal features, then the profile by hour and load type."""
    cleaned = clean_readings(dirty_csv(spark, sf), READING_SPEC)
    hourly = cleaned.withColumn("hour", t.hour_of(F.col("nsm")))
    return rounded(stats.group_stats(hourly, ["load_type", "hour"], "usage", None), 8)
