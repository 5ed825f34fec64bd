"""Scans, casts, filters, fills, duplicates and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspan.operators import clean, dedup, impute, outliers
from wattspan.plans.cleaning import CleaningSpec, clean_readings
from wattspan.plans.queries.base import (
    DIRTY, GAPPY, READINGS, SCHEMA, TYPED, dirty, dirty_csv, exact_quantile_sql as eq, gappy, query, readings, rounded,
    scratch, table, typed,
)
from wattspan.sources import io

# ---- sources and sinks -------------------------------------------------------------


@query("s1_csv_scan", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    path = scratch(spark, "csv")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").write.option(
        "header", True).csv(path)
    raw = io.read_csv(spark, path, ["o_orderkey", "o_orderstatus", "o_totalprice"])
    return clean.cast_schema(raw, {"o_orderkey": "bigint", "o_totalprice": "double"})


@query("s2_parquet_scan", "SELECT event_type, count(*) AS n, max(value) AS top FROM events GROUP BY event_type")
def _(spark, sf):
    df = io.read_parquet(spark, f"{sf}/events.parquet")
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))


@query("s3_load_table", "SELECT 2 * count(*) AS n FROM orders")
def _(spark, sf):
    name = "wattspan_orders_" + scratch(spark, "t")[-8:]
    path = f"{sf}/orders.parquet"
    where = scratch(spark, "table")
    io.load_table(spark, path, name, mode="replace", location=where)
    io.load_table(spark, path, name, mode="append", location=where)
    return spark.table(name).agg(F.count(F.lit(1)).alias("n"))


@query("s4_ensure_table", "SELECT count(*) AS n FROM customer")
def _(spark, sf):
    name = "wattspan_customer_" + scratch(spark, "t")[-8:]
    path, where = f"{sf}/customer.parquet", scratch(spark, "table")
    io.ensure_table(spark, path, name, location=where)
    io.ensure_table(spark, path, name, location=where)
    return spark.table(name).agg(F.count(F.lit(1)).alias("n"))


@query("s5_table_info", """SELECT column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type,
  (SELECT count(*) FROM events) AS row_count
  FROM (SELECT column_name, column_type AS data_type FROM (DESCRIBE events))""")
def _(spark, sf):
    return io.table_info(table(spark, sf, "events"))


@query("s6_parquet_write", "SELECT * FROM customer")
def _(spark, sf):
    path = scratch(spark, "parquet")
    io.write_parquet(table(spark, sf, "customer"), path)
    return spark.read.parquet(path)


@query("s7_split_write", """SELECT CASE WHEN o_orderkey % 10 < 7 THEN 'train' WHEN o_orderkey % 10 < 9 THEN 'val'
  ELSE 'test' END AS split, count(*) AS n FROM orders GROUP BY 1""")
def _(spark, sf):
    k = F.col("o_orderkey") % 10
    labelled = table(spark, sf, "orders").withColumn(
        "split", F.when(k < 7, "train").when(k < 9, "val").otherwise("test"))
    path = scratch(spark, "splits")
    io.write_splits(labelled, path)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("s8_reference_limit", "SELECT least(count(*), 100) AS n FROM orders")
def _(spark, sf):
    return io.limited(table(spark, sf, "orders"), 100).agg(F.count(F.lit(1)).alias("n"))


@query("s9_prediction_log", """SELECT count(*) AS n, count(DISTINCT run_id) AS runs FROM
  (SELECT l_orderkey, 1 AS run_id FROM lineitem UNION ALL SELECT l_orderkey, 2 AS run_id FROM lineitem)""")
def _(spark, sf):
    path = scratch(spark, "log")
    scored = table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", "l_tax", (F.col("l_quantity") * 1000).alias("prediction"))
    for run in (1, 2):
        io.append_predictions(scored.withColumn("run_id", F.lit(run)), path, F.lit("2024-02-01 00:00:00"))
    log = spark.read.parquet(path)
    return log.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("run_id").alias("runs"))


@query("s13_two_scans", """SELECT
  (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-16') AS reference_rows,
  (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16') AS production_rows,
  FALSE AS reference_empty, FALSE AS production_empty,
  (SELECT count(*) < 100 FROM events WHERE ts >= TIMESTAMP '2024-01-16') AS below_min""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    return io.sample_check(ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut), min_samples=100)


# ---- projections, filters, casts ---------------------------------------------------


@query("p1_cast_schema", f"WITH {TYPED} SELECT * FROM typed")
def _(spark, sf):
    return typed(spark, sf)


@query("p2_drop_blank", f"""WITH {DIRTY} SELECT event_id, date FROM dirty WHERE date IS NOT NULL
  AND upper(trim(date)) NOT IN ('NAN', 'N/A', '')""")
def _(spark, sf):
    return clean.drop_blank(dirty(spark, sf), "date").select("event_id", "date")


@query("p3_drop_sparse", f"""WITH {TYPED} SELECT * FROM typed WHERE
  (date IS NULL)::INT + (usage IS NULL)::INT + ("CO2(tCO2)" IS NULL)::INT + ("power.factor" IS NULL)::INT
  + (nsm IS NULL)::INT + (week_status IS NULL)::INT + (load_type IS NULL)::INT <= 1""")
def _(spark, sf):
    return clean.drop_sparse(typed(spark, sf), max_nulls=1)


@query("p4_clamp", f"""WITH {TYPED} SELECT event_id, abs(usage) AS usage,
  CASE WHEN "power.factor" < 0 THEN 0 WHEN "power.factor" > 100 THEN 100 ELSE "power.factor" END AS "power.factor",
  CASE WHEN nsm < 0 THEN 0 WHEN nsm > 86400 THEN 86400 ELSE nsm END AS nsm FROM typed""")
def _(spark, sf):
    rules = {"power.factor": {"min": 0, "max": 100}, "nsm": {"min": 0, "max": 86400}}
    return clean.clamp(typed(spark, sf), rules, ["usage"]).select("event_id", "usage", "`power.factor`", "nsm")


_CATS = f"""WITH {DIRTY}, c1 AS (SELECT event_id,
    CASE WHEN week_status IS NULL OR upper(trim(week_status)) IN ('NAN', 'N/A', '') THEN NULL
      ELSE upper(trim(week_status)[1]) || lower(trim(week_status)[2:]) END AS week_status,
    CASE WHEN load_type IS NULL OR upper(trim(load_type)) IN ('NAN', 'N/A', '') THEN NULL
      ELSE upper(load_type[1]) || lower(replace(load_type[2:], '_LOAD', '_load')) END AS load_type
  FROM dirty),
  c2 AS (SELECT event_id, week_status, replace(load_type, '_load', '_Load') AS load_type FROM c1)
  SELECT event_id, coalesce(week_status, (SELECT week_status FROM c2 WHERE week_status IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), 'Unknown') AS week_status,
    coalesce(load_type, (SELECT load_type FROM c2 WHERE load_type IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), 'Unknown') AS load_type FROM c2"""


@query("p5_clean_categories", _CATS)
def _(spark, sf):
    df = dirty(spark, sf).select("event_id", "week_status", "load_type")
    return clean.clean_categories(df, ["week_status", "load_type"])


@query("p6_map_values", """SELECT event_id, CASE event_type WHEN 'error' THEN 'Fault' WHEN 'view' THEN 'View'
  ELSE event_type END AS event_type FROM events""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return clean.map_values(ev, "event_type", {"error": "Fault", "view": "View"})


@query("p6_map_values_table", """SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def _(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("k"), "n_name")
    return clean.map_values_from(cust, "nation", nation, "k", "n_name")


@query("p7_text_dates", f"""WITH {DIRTY} SELECT event_id, strptime(trim(date), '%d/%m/%Y %H:%M') AS date,
  trim(week_status) AS week_status FROM dirty
  WHERE date IS NOT NULL AND upper(trim(date)) NOT IN ('NAN', 'N/A', '')""")
def _(spark, sf):
    df = dirty(spark, sf).select("event_id", "date", "week_status")
    return clean.tidy_strings_and_dates(df, "date")


@query("p8_to_numeric", f"WITH {DIRTY} SELECT event_id, TRY_CAST(trim(usage) AS DOUBLE) AS usage FROM dirty")
def _(spark, sf):
    return clean.to_numeric(dirty(spark, sf).select("event_id", "usage"), ["usage"])


@query("p9_select_features", "SELECT l_quantity, l_discount, l_tax FROM lineitem")
def _(spark, sf):
    cols = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    return clean.select_features(table(spark, sf, "lineitem"), cols, ["l_extendedprice"])


@query("p10_align_schema", f"""WITH {DIRTY} SELECT event_id, TRY_CAST(trim(nsm) AS DOUBLE) AS value FROM dirty""")
def _(spark, sf):
    ref = table(spark, sf, "events").select("event_id", "value")
    other = dirty(spark, sf).select(F.col("nsm").alias("value"), "event_id", "date")
    return clean.align_schema(ref, other)


@query("p11_subset", "SELECT event_id, value FROM events WHERE event_type IN ('view', 'click')")
def _(spark, sf):
    return clean.subset(table(spark, sf, "events"), "event_type", ["view", "click"], ["event_id", "value"])


@query("p12_labels_from_dummies", """SELECT event_id, CASE event_type WHEN 'view' THEN 'View' WHEN 'click' THEN 'Click'
  WHEN 'error' THEN 'Error' ELSE 'View' END AS label FROM events""")
def _(spark, sf):
    kind = lambda v: (F.col("event_type") == v).cast("int")
    ev = table(spark, sf, "events").select(
        "event_id", kind("view").alias("is_view"), kind("click").alias("is_click"), kind("error").alias("is_error"))
    labels = {"is_view": "View", "is_click": "Click", "is_error": "Error"}
    return clean.labels_from_dummies(ev, labels, "label").select("event_id", "label")


@query("p13_null_tokens", f"""WITH {DIRTY} SELECT event_id,
  CASE WHEN load_type IN ('nan', 'NaN', 'None', 'NULL', 'null') THEN NULL ELSE load_type END AS load_type FROM dirty""")
def _(spark, sf):
    return clean.null_tokens(dirty(spark, sf).select("event_id", "load_type"))


# ---- fills -------------------------------------------------------------------------

_NEAR = GAPPY + """, numbered AS (SELECT *, row_number() OVER ({part} ORDER BY ts, event_id) AS rn FROM gappy),
  near AS (SELECT *,
    last_value(CASE WHEN usage IS NOT NULL THEN rn END IGNORE NULLS) OVER up AS p0,
    last_value(usage IGNORE NULLS) OVER up AS v0,
    first_value(CASE WHEN usage IS NOT NULL THEN rn END IGNORE NULLS) OVER dn AS p1,
    first_value(usage IGNORE NULLS) OVER dn AS v1,
    last_value(nsm IGNORE NULLS) OVER up AS n0, first_value(nsm IGNORE NULLS) OVER dn AS n1
  FROM numbered
  WINDOW up AS ({part} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    dn AS ({part} ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_ALL = _NEAR.format(part="")
_USER = _NEAR.format(part="PARTITION BY user_id")
_LINE = "coalesce(usage, v0 + (v1 - v0) * (rn - p0) / (p1 - p0))"
_ORDER = ["ts", "event_id"]


@query("i1_interpolate", f"WITH {_ALL} SELECT event_id, round({_LINE}, 6) AS usage FROM near")
def _(spark, sf):
    return rounded(impute.interpolate(gappy(spark, sf), ["usage"], _ORDER).select("event_id", "usage"))


@query("i1_interpolate_series", f"WITH {_USER} SELECT event_id, round({_LINE}, 6) AS usage FROM near")
def _(spark, sf):
    out = impute.interpolate(gappy(spark, sf), ["usage"], _ORDER, ["user_id"])
    return rounded(out.select("event_id", "usage"))


@query("i2_forward_fill", f"WITH {_USER} SELECT event_id, v0 AS usage FROM near")
def _(spark, sf):
    return impute.forward_fill(gappy(spark, sf), ["usage"], _ORDER, ["user_id"]).select("event_id", "usage")


@query("i3_backward_fill", f"WITH {_USER} SELECT event_id, v1 AS usage FROM near")
def _(spark, sf):
    return impute.backward_fill(gappy(spark, sf), ["usage"], _ORDER, ["user_id"]).select("event_id", "usage")


@query("i4_constant_fill", f"WITH {GAPPY} SELECT event_id, coalesce(usage, 0) AS usage FROM gappy")
def _(spark, sf):
    return impute.constant_fill(gappy(spark, sf), ["usage"], 0.0).select("event_id", "usage")


@query("i5_staged_fill", f"""WITH {TYPED}, kept AS (SELECT * FROM typed
    WHERE date IS NOT NULL AND upper(trim(date)) NOT IN ('NAN', 'N/A', '') AND
    (usage IS NULL)::INT + ("CO2(tCO2)" IS NULL)::INT + ("power.factor" IS NULL)::INT
    + (nsm IS NULL)::INT + (week_status IS NULL)::INT + (load_type IS NULL)::INT <= 3),
  numbered AS (SELECT *, "CO2(tCO2)" AS co2, row_number() OVER (ORDER BY event_id) AS rn FROM kept),
  near AS (SELECT *,
    last_value(CASE WHEN usage IS NOT NULL THEN rn END IGNORE NULLS) OVER up AS p0, last_value(usage IGNORE NULLS) OVER up AS v0,
    first_value(CASE WHEN usage IS NOT NULL THEN rn END IGNORE NULLS) OVER dn AS p1, first_value(usage IGNORE NULLS) OVER dn AS v1,
    last_value(CASE WHEN co2 IS NOT NULL THEN rn END IGNORE NULLS) OVER up AS q0, last_value(co2 IGNORE NULLS) OVER up AS w0,
    first_value(CASE WHEN co2 IS NOT NULL THEN rn END IGNORE NULLS) OVER dn AS q1, first_value(co2 IGNORE NULLS) OVER dn AS w1,
    last_value(nsm IGNORE NULLS) OVER up AS n0, first_value(nsm IGNORE NULLS) OVER dn AS n1 FROM numbered
    WINDOW up AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      dn AS (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  SELECT event_id, round(coalesce(usage, v0 + (v1 - v0) * (rn - p0) / (p1 - p0), v0, v1, 0), 6) AS usage,
    round(coalesce(co2, w0 + (w1 - w0) * (rn - q0) / (q1 - q0), w0, w1, 0), 6) AS co2,
    coalesce(n0, n1) AS nsm FROM near""")
def _(spark, sf):
    out = impute.staged_fill(typed(spark, sf), "date", ["usage", "CO2(tCO2)", "power.factor"], ["nsm"], ["event_id"])
    return rounded(out.select("event_id", "usage", F.col("`CO2(tCO2)`").alias("co2"), "nsm"))


@query("i6_centre_fill", f"""WITH {GAPPY}, g AS (SELECT event_id, usage,
    CASE WHEN event_id % 9 <> 0 THEN event_type END AS kind FROM gappy)
  SELECT event_id, round(coalesce(usage, (SELECT quantile_cont(usage, 0.5) FROM g)), 6) AS usage,
    coalesce(kind, (SELECT kind FROM g WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS kind
  FROM g""")
def _(spark, sf):
    g = gappy(spark, sf).select(
        "event_id", "usage", F.when(F.col("event_id") % 9 != 0, F.col("event_type")).alias("kind"))
    return rounded(impute.centre_fill(g, ["usage"], ["kind"]))


# ---- duplicates --------------------------------------------------------------------

_KEYED = "SELECT user_id, event_type, event_id, value FROM events"


def _keyed(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")


for _keep, _dir in (("first", "ASC"), ("last", "DESC")):
    @query(f"d1_keep_{_keep}", f"""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id, event_type ORDER BY event_id {_dir}) AS rn FROM events) WHERE rn = 1""")
    def _(spark, sf, keep=_keep):
        return dedup.keep_one(_keyed(spark, sf), ["user_id", "event_type"], ["event_id"], keep)


@query("d1_keep_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_tax FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_tax")
    return dedup.keep_one(li, None, [])


@query("d2_keep_none", """SELECT l_partkey, l_suppkey, l_orderkey FROM (SELECT *, count(*) OVER
  (PARTITION BY l_partkey, l_suppkey) AS n FROM lineitem) WHERE n = 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey")
    return dedup.keep_none(li, ["l_partkey", "l_suppkey"])


def _dup_sql(name, keys, source):
    return f"""SELECT '{name}' AS dataset, CAST(sum(n) AS BIGINT) AS total_count,
      CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_count,
      round(coalesce(sum(n) FILTER (n > 1), 0) / sum(n) * 100, 2) AS duplicate_pct,
      count(*) FILTER (n > 1) AS duplicate_patterns
      FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})"""


_LI4 = "l_quantity, l_discount, l_tax, l_returnflag"
_LI2 = "l_quantity, l_discount"


@query("d3_exact_duplicates", _dup_sql("items", _LI4, "lineitem"))
def _(spark, sf):
    return dedup.duplicate_report(table(spark, sf, "lineitem").select(*_LI4.split(", ")), "items")


@query("d4_partial_duplicates", _dup_sql("items", "l_partkey, l_suppkey", "lineitem"))
def _(spark, sf):
    return dedup.duplicate_report(table(spark, sf, "lineitem"), "items", ["l_partkey", "l_suppkey"])


def _cmp_sql(label, keys):
    d, c = _dup_sql("d", keys, "lineitem"), _dup_sql("c", keys, "(SELECT * FROM lineitem WHERE l_returnflag = 'R')")
    return f"""SELECT '{label}' AS type, d.duplicate_count AS dirty_count, d.duplicate_pct AS dirty_pct,
      c.duplicate_count AS clean_count, c.duplicate_pct AS clean_pct,
      d.duplicate_count - c.duplicate_count AS difference FROM ({d}) d, ({c}) c"""


@query("d5_compare_duplicates", _cmp_sql("Exact Duplicates", _LI4) + " UNION ALL "
       + _cmp_sql(f"Partial Duplicates ({_LI2})", _LI2))
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*_LI4.split(", "))
    return dedup.compare_duplicates(li, li.filter("l_returnflag = 'R'"), _LI2.split(", "))


# ---- outliers ----------------------------------------------------------------------

_LO, _HI = eq("events", "value", 0.01), eq("events", "value", 0.99)


@query("o1_cap_outliers", f"""WITH b AS (SELECT {_LO} AS lo, {_HI} AS hi)
  SELECT event_id, CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END AS value FROM events, b""")
def _(spark, sf):
    return outliers.treat_outliers(table(spark, sf, "events").select("event_id", "value"), ["value"])


@query("o2_null_outliers", f"""WITH b AS (SELECT {_LO} AS lo, {_HI} AS hi)
  SELECT event_id, CASE WHEN value < lo OR value > hi THEN NULL ELSE value END AS value FROM events, b""")
def _(spark, sf):
    return outliers.treat_outliers(table(spark, sf, "events").select("event_id", "value"), ["value"], "remove")


def _iqr_sql(source, cols, which=None):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", (SELECT count(*) FROM {source} WHERE {c} < lo OR {c} > hi) AS outlier_count,
          round((SELECT count(*) FROM {source} WHERE {c} < lo OR {c} > hi) / (SELECT count(*) FROM {source}) * 100, 2) AS outlier_pct,
          (SELECT count(*) FROM {source}) AS total_count, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
          round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound
          FROM (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
            (SELECT CAST({eq(source, c, 0.25)} AS DOUBLE) AS q1, CAST({eq(source, c, 0.75)} AS DOUBLE) AS q3))""")
    return " UNION ALL ".join(parts)


@query("o3_iqr_outliers", f"""WITH b AS (SELECT {eq('events', 'value', 0.25)} AS q1, {eq('events', 'value', 0.75)} AS q3)
  SELECT event_id, value FROM events, b WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def _(spark, sf):
    return outliers.iqr_outliers(table(spark, sf, "events").select("event_id", "value"), "value")


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("o4_iqr_report", _iqr_sql("lineitem", _NUM))
def _(spark, sf):
    return rounded(outliers.iqr_report(table(spark, sf, "lineitem").select(*_NUM)))


@query("o5_zscore_outliers", """WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
  SELECT event_id, value, round(abs((value - m) / sd), 6) AS zscore FROM events, s
  WHERE abs((value - m) / sd) > 3.0""")
def _(spark, sf):
    return rounded(outliers.zscore_outliers(table(spark, sf, "events").select("event_id", "value"), "value"))


def _z_sql(source, cols):
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER (abs((v - m) / sd) > 2.0) AS outlier_count,
      round(count(*) FILTER (abs((v - m) / sd) > 2.0) / count(*) * 100, 2) AS outlier_pct, count(*) AS total_count,
      round(max(m), 4) AS mean, round(max(sd), 4) AS std
      FROM (SELECT CAST({c} AS DOUBLE) AS v, avg({c}) OVER () AS m, stddev_samp({c}) OVER () AS sd FROM {source})""" for c in cols)


@query("o6_zscore_report", _z_sql("orders", ["o_orderkey", "o_custkey", "o_totalprice"]))
def _(spark, sf):
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    return rounded(outliers.zscore_report(table(spark, sf, "orders").select(*cols), threshold=2.0), 4)


@query("o7_drop_iqr_rows", """WITH a AS (SELECT p_partkey, p_size, p_retailprice * p_size AS cost FROM part),
  b AS (SELECT a.* FROM a, (SELECT quantile_cont(cost, 0.25) AS q1, quantile_cont(cost, 0.75) AS q3 FROM a)
    WHERE cost >= q1 - 1.5 * (q3 - q1) AND cost <= q3 + 1.5 * (q3 - q1))
  SELECT b.p_partkey FROM b, (SELECT quantile_cont(p_size, 0.25) AS q1, quantile_cont(p_size, 0.75) AS q3 FROM b)
    WHERE p_size >= q1 - 1.5 * (q3 - q1) AND p_size <= q3 + 1.5 * (q3 - q1)""")
def _(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", "p_size", (F.col("p_retailprice") * F.col("p_size")).alias("cost"))
    return outliers.drop_iqr_rows(part, ["cost", "p_size"]).select("p_partkey")


READING_SPEC = CleaningSpec(
    schema=SCHEMA, drop=["mixed_type_col"], critical="date",
    interpolated=["usage", "CO2(tCO2)", "power.factor"], carried=["nsm"],
    categories=["week_status", "load_type"],
    ranges={"power.factor": {"min": 0, "max": 100}, "nsm": {"min": 0, "max": 86400}},
    absolute=["usage", "CO2(tCO2)"], capped=["usage", "CO2(tCO2)"], order_by=["event_id"],
    subset=["date", "usage", "nsm", "week_status", "load_type"],
)

def _filled_sql(c):
    return (f"abs(coalesce({c}, {c}_v0 + ({c}_v1 - {c}_v0) * (rn - {c}_p0) / ({c}_p1 - {c}_p0), {c}_v0, {c}_v1, 0))")


def _near_cols(c):
    return f"""last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER up AS {c}_p0,
      last_value({c} IGNORE NULLS) OVER up AS {c}_v0,
      first_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER dn AS {c}_p1,
      first_value({c} IGNORE NULLS) OVER dn AS {c}_v1"""


CLEAN_SQL = f"""WITH {TYPED}, kept AS (SELECT event_id, date, usage, "CO2(tCO2)" AS co2, "power.factor" AS pf, nsm FROM typed
    WHERE date IS NOT NULL AND upper(trim(date)) NOT IN ('NAN', 'N/A', '') AND
    (usage IS NULL)::INT + ("CO2(tCO2)" IS NULL)::INT + ("power.factor" IS NULL)::INT
    + (nsm IS NULL)::INT + (week_status IS NULL)::INT + (load_type IS NULL)::INT <= 3),
  numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM kept),
  near AS (SELECT *, {_near_cols('usage')}, {_near_cols('co2')}, {_near_cols('nsm')}
    FROM numbered WINDOW up AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      dn AS (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  words AS (SELECT event_id,
    CASE WHEN week_status IS NULL OR upper(trim(week_status)) IN ('NAN', 'N/A', '') THEN NULL
      ELSE upper(trim(week_status)[1]) || lower(trim(week_status)[2:]) END AS week_status,
    CASE WHEN load_type IS NULL OR upper(trim(load_type)) IN ('NAN', 'N/A', '') THEN NULL
      ELSE replace(upper(load_type[1]) || lower(load_type[2:]), '_load', '_Load') END AS load_type
    FROM typed WHERE event_id IN (SELECT event_id FROM kept)),
  modal AS (SELECT
    (SELECT week_status FROM words WHERE week_status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS w,
    (SELECT load_type FROM words WHERE load_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS l),
  whole AS (SELECT near.event_id, date, {_filled_sql('usage')} AS usage, {_filled_sql('co2')} AS co2,
      least(greatest(pf, 0), 100) AS pf, least(greatest(coalesce(nsm_v0, nsm_v1), 0), 86400) AS nsm,
      coalesce(week_status, w) AS week_status, coalesce(load_type, l) AS load_type
    FROM near JOIN words ON near.event_id = words.event_id, modal),
  ends AS (SELECT {eq('whole', 'usage', 0.01)} AS ulo, {eq('whole', 'usage', 0.99)} AS uhi,
    {eq('whole', 'co2', 0.01)} AS clo, {eq('whole', 'co2', 0.99)} AS chi),
  capped AS (SELECT event_id, date, CASE WHEN usage < ulo THEN ulo WHEN usage > uhi THEN uhi ELSE usage END AS usage,
      CASE WHEN co2 < clo THEN clo WHEN co2 > chi THEN chi ELSE co2 END AS co2, pf, nsm, week_status, load_type
    FROM whole, ends),
  cleaned AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, usage, nsm, week_status, load_type
    ORDER BY event_id) AS dup FROM capped) WHERE dup = 1)"""


@query("cleaning_job", CLEAN_SQL + """ SELECT event_id, date, round(usage, 6) AS usage, round(co2, 6) AS co2, pf, nsm,
  week_status, load_type FROM cleaned""")
def _(spark, sf):
    cleaned = clean_readings(dirty_csv(spark, sf), READING_SPEC)
    return rounded(cleaned.withColumnRenamed("CO2(tCO2)", "co2").withColumnRenamed("power.factor", "pf"))
