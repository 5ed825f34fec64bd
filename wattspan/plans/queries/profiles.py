"""Data-quality profiles and validations."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspan.operators import quality, split, temporal
from wattspan.plans.queries.base import DIRTY, READINGS, TYPED, dirty, query, readings, rounded, table, typed
from wattspan.plans.queries.statistics import split_items

_COLS = ["event_id", "date", "usage", "CO2(tCO2)", "power.factor", "nsm", "week_status", "load_type"]


def _profile_sql(source, cols=_COLS):
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" IS NULL) AS null_count,
      round(count(*) FILTER ("{c}" IS NULL) / count(*) * 100, 2) AS null_pct, count(*) AS total_rows FROM {source}"""
                              for c in cols)


@query("v1_null_profile", f"WITH {TYPED} {_profile_sql('typed')}")
def _(spark, sf):
    return quality.null_profile(typed(spark, sf))


@query("v1_null_profile_empty", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", 0::BIGINT AS null_count, 0.0::DOUBLE AS null_pct, 0::BIGINT AS total_rows""" for c in ("event_id", "value")))
def _(spark, sf):
    return quality.null_profile(table(spark, sf, "events").select("event_id", "value").filter("value < 0"))


@query("v2_compare_null_profiles", f"""WITH {TYPED}, d AS ({_profile_sql('typed')}),
  c AS ({_profile_sql('dirty', ['event_id', 'date', 'usage', 'nsm', 'mixed_type_col'])}),
  j AS (SELECT coalesce(d."column", c."column") AS "column", coalesce(d.null_count, 0) AS dn, coalesce(d.null_pct, 0) AS dp,
    coalesce(c.null_count, 0) AS cn, coalesce(c.null_pct, 0) AS cp FROM d FULL JOIN c ON d."column" = c."column")
  SELECT "column", dn AS dirty_null_count, dp AS dirty_null_pct, cn AS clean_null_count, cp AS clean_null_pct,
    dn - cn AS null_count_diff, round(dp - cp, 6) AS null_pct_diff FROM j""")
def _(spark, sf):
    raw = dirty(spark, sf).select("event_id", "date", "usage", "nsm", "mixed_type_col")
    return rounded(quality.compare_null_profiles(quality.null_profile(typed(spark, sf)), quality.null_profile(raw)))


@query("v3_type_report", f"""WITH {TYPED} SELECT 'usage' AS "column", 'invalid' AS status, 'double' AS expected_type,
    'string' AS actual_type, (SELECT count(*) FROM dirty d JOIN typed t USING (event_id)
    WHERE d.usage IS NOT NULL AND t.usage IS NULL) AS failing_values, (SELECT count(*) FROM dirty) AS total_rows
  UNION ALL SELECT 'nsm', 'invalid', 'bigint', 'string', 0, (SELECT count(*) FROM dirty)
  UNION ALL SELECT 'date', 'valid', 'string', 'string', 0, (SELECT count(*) FROM dirty)
  UNION ALL SELECT 'kwh', 'missing', 'double', NULL, 0, (SELECT count(*) FROM dirty)
  UNION ALL SELECT 'event_id', 'extra', NULL, 'bigint', 0, (SELECT count(*) FROM dirty)""")
def _(spark, sf):
    df = dirty(spark, sf).select("event_id", "date", "usage", "nsm")
    return quality.type_report(df, {"date": "string", "usage": "double", "nsm": "bigint", "kwh": "double"})


@query("v3_compare_type_reports", """SELECT * FROM (VALUES ('usage', FALSE, TRUE, TRUE), ('date', TRUE, TRUE, FALSE),
  ('nsm', FALSE, TRUE, TRUE)) t("column", dirty_valid, clean_valid, issue_introduced)""")
def _(spark, sf):
    want = {"date": "string", "usage": "double", "nsm": "bigint"}
    cols = ["date", "usage", "nsm"]
    d = quality.type_report(dirty(spark, sf).select(*cols), want)
    c = quality.type_report(typed(spark, sf).select(*cols), want)
    return quality.compare_type_reports(d, c)


@query("v3_compare_schemas", """SELECT t.*, (SELECT count(*) FROM orders) AS dirty_rows,
  (SELECT count(*) FROM customer) AS clean_rows FROM (VALUES ('amount', 'type_changed', 'double', 'int'), ('key', 'common', 'bigint', 'bigint'),
  ('o_orderstatus', 'added', 'string', NULL), ('c_name', 'removed', NULL, 'string')) t("column", change, dirty_type, clean_type)""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"), "o_orderstatus")
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("amount"), "c_name")
    return quality.compare_schemas(o, c)


_RULES = {"power.factor": {"min": 0, "max": 100}, "nsm": {"max": 86400}, "usage": {"min": 0}, "kwh": {"min": 0}}


def _range_sql(source, col, cond, lo, hi, num=None):
    n = num or f'"{col}"'
    return f"""SELECT '{col}' AS "column", CASE WHEN count(*) FILTER ({cond}) > 0 THEN 'violations_found' ELSE 'valid' END AS status,
      count(*) FILTER ({cond}) AS violations, round(count(*) FILTER ({cond}) / count({n}) * 100, 2) AS violation_pct,
      count({n}) AS total_count, {lo}::DOUBLE AS min_expected, {hi}::DOUBLE AS max_expected,
      list_sort(list(DISTINCT CAST({n} AS DOUBLE)) FILTER ({cond}))[1:5] AS examples FROM {source}"""


_RANGES = f"""{_range_sql('typed', 'power.factor', '"power.factor" < 0 OR "power.factor" > 100', 0, 100)}
  UNION ALL {_range_sql('typed', 'nsm', 'nsm > 86400', 'NULL', 86400)}
  UNION ALL {_range_sql('typed', 'usage', 'usage < 0', 0, 'NULL')}
  UNION ALL SELECT 'kwh', 'column_not_found', 0, 0.0, 0, 0::DOUBLE, NULL, []"""


@query("v5_range_report", f"WITH {TYPED} {_RANGES}")
def _(spark, sf):
    return quality.range_report(dirty(spark, sf), _RULES)


@query("v6_compare_range_reports", f"""WITH {TYPED}, d AS ({_RANGES}),
  c AS (SELECT 'nsm' AS "column", count(*) FILTER (nsm > 86400) AS violations,
      round(count(*) FILTER (nsm > 86400) / count(nsm) * 100, 2) AS violation_pct FROM readings
    UNION ALL SELECT 'dow', count(*) FILTER (dow > 5), round(count(*) FILTER (dow > 5) / count(dow) * 100, 2) FROM readings)
  SELECT coalesce(d."column", c."column") AS "column", coalesce(d.violations, 0) AS dirty_violations,
    coalesce(d.violation_pct, 0) AS dirty_pct, coalesce(c.violations, 0) AS clean_violations, coalesce(c.violation_pct, 0) AS clean_pct,
    coalesce(d.violations, 0) - coalesce(c.violations, 0) AS difference,
    coalesce(c.violations, 0) = 0 AND coalesce(d.violations, 0) > 0 AS issue_introduced
  FROM d FULL JOIN c ON d."column" = c."column" """)
def _(spark, sf):
    d = quality.range_report(dirty(spark, sf), _RULES)
    c = quality.range_report(readings(spark, sf), {"nsm": {"max": 86400}, "dow": {"max": 5}})
    return quality.compare_range_reports(d, c)


@query("v7_row_errors", f"""WITH {TYPED} SELECT event_id, CASE WHEN d.usage IS NULL THEN 'Feature ''usage'' has null value'
    WHEN t.usage IS NULL THEN 'Feature ''usage'' must be numeric'
    WHEN t.usage NOT BETWEEN 0 AND 200 THEN 'Feature ''usage'' out of range [0, 200]'
    WHEN d.nsm IS NULL THEN 'Feature ''nsm'' has null value'
    WHEN t.nsm NOT BETWEEN 0 AND 86400 THEN 'Feature ''nsm'' out of range [0, 86400]'
    WHEN lower(coalesce(d.load_type, '?')) NOT IN ('view_load', 'click_load', 'error_load', 'signup_load') THEN
      'Feature ''kind'' not an allowed class' END AS error FROM dirty d JOIN typed t USING (event_id)""")
def _(spark, sf):
    df = dirty(spark, sf).withColumn("kind", F.lower("load_type"))
    kinds = ["view_load", "click_load", "error_load", "signup_load"]
    ranges = {"usage": (0, 200), "nsm": (0, 86400)}
    return quality.row_errors(df, ["usage", "nsm"], ranges, {"kind": kinds}).select("event_id", "error")


@query("v8_invalid_categories", f"""WITH {DIRTY} SELECT load_type AS invalid_value, count(*) AS invalid_count,
  (SELECT count(*) FROM dirty) AS total_count, round(count(*) / (SELECT count(*) FROM dirty) * 100, 2) AS invalid_pct
  FROM dirty WHERE load_type NOT IN ('view_load', 'click_load', 'error_load') GROUP BY 1""")
def _(spark, sf):
    return quality.invalid_categories(dirty(spark, sf), "load_type", ["view_load", "click_load", "error_load"])


@query("v9_cleaned_report", """WITH c AS (SELECT o_custkey, o_orderstatus, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS p FROM orders)
  SELECT abs((SELECT count(*) FROM c) - (SELECT count(*) FROM customer)) <= 100 AS shape_match,
    (SELECT count(*) FROM c) - (SELECT count(*) FROM customer) AS row_count_diff, TRUE AS schema_match,
    (SELECT count(*) FROM c WHERE p IS NULL) AS null_count,
    (SELECT count(*) FROM c) - (SELECT count(*) FROM (SELECT DISTINCT * FROM c)) AS duplicate_count,
    1::BIGINT AS type_mismatches, FALSE AS all_checks_passed""")
def _(spark, sf):
    c = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("p"))
    ref = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("s"), F.col("c_nationkey").alias("p"))
    return quality.cleaned_report(c, ref)


_PAIR = """ref AS (SELECT o_orderkey, o_totalprice, o_orderstatus, o_custkey FROM orders),
  cln AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1
      ELSE o_totalprice + 0.001 END AS o_totalprice, CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
      o_custkey FROM orders WHERE o_orderkey % 10 <> 3)"""


def _pair(spark, sf):
    k = F.col("o_orderkey")
    ref = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey")
    price = F.when(k % 11 == 0, None).when(k % 4 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice") + 0.001)
    cln = ref.filter(k % 10 != 3).select(
        k, price.alias("o_totalprice"), F.when(k % 6 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_custkey")
    return ref, cln


@query("v10_cell_match", f"WITH {_PAIR}, j AS (SELECT r.*, c.o_totalprice AS tp, c.o_orderstatus AS st, c.o_custkey AS ck FROM ref r JOIN cln c USING (o_orderkey)) "
       + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER ({m}) AS matches, count(*) AS total,
         round(count(*) FILTER ({m}) / count(*) * 100, 6) AS match_pct, round(count(*) / (SELECT count(*) FROM ref) * 100, 6) AS coverage_pct FROM j"""
                            for c, m in (("o_totalprice", "abs(o_totalprice - tp) < 0.01 OR (o_totalprice IS NULL AND tp IS NULL)"),
                                         ("o_orderstatus", "o_orderstatus = st"), ("o_custkey", "o_custkey = ck"))))
def _(spark, sf):
    return rounded(quality.cell_match(*_pair(spark, sf), "o_orderkey"))


@query("v11_statistic_differences", f"WITH {_PAIR} " + " UNION ALL ".join(f"""SELECT 'o_totalprice' AS "column", '{s}' AS statistic,
  round((SELECT {f} FROM ref), 4) AS reference_value, round((SELECT {f} FROM cln), 4) AS cleaned_value,
  round(abs(((SELECT {f} FROM cln) - (SELECT {f} FROM ref)) / (SELECT {f} FROM ref) * 100), 4) AS diff_pct"""
                                                                          for s, f in (("mean", "avg(o_totalprice)"), ("median", "quantile_cont(o_totalprice, 0.5)"),
                                                                                       ("std", "stddev_samp(o_totalprice)"))))
def _(spark, sf):
    return rounded(quality.statistic_differences(*_pair(spark, sf), ["o_totalprice"]), 4)


@query("v12_worst_cells", f"""WITH {_PAIR}, j AS (SELECT r.*, c.o_totalprice AS tp, c.o_orderstatus AS st FROM ref r JOIN cln c USING (o_orderkey)),
  m AS (SELECT o_orderkey, 'o_totalprice' AS "column", CAST(o_totalprice AS VARCHAR) AS reference_value, CAST(tp AS VARCHAR) AS cleaned_value
      FROM j WHERE NOT coalesce(abs(o_totalprice - tp) < 0.01, o_totalprice IS NULL AND tp IS NULL)
    UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus, st FROM j WHERE o_orderstatus <> st),
  t AS (SELECT *, count(*) OVER (PARTITION BY "column") AS mismatches,
    CAST(row_number() OVER (PARTITION BY "column" ORDER BY o_orderkey) AS INTEGER) AS "row" FROM m)
  SELECT "column", o_orderkey, reference_value, cleaned_value, mismatches, "row" FROM t WHERE "row" <= 3""")
def _(spark, sf):
    return quality.worst_cells(*_pair(spark, sf), "o_orderkey")


@query("v13_schema_check", f"""WITH {TYPED} SELECT * FROM (VALUES
  ('date', 'error', 'type mismatch', 'timestamp_ntz', 'string', (SELECT count(*) FROM dirty WHERE date IS NOT NULL)),
  ('event_id', 'ok', 'compatible', 'bigint', 'bigint', 0), ('kwh', 'error', 'missing in production', 'double', NULL, 0),
  ('usage', 'error', 'type mismatch', 'double', 'string', (SELECT count(*) FROM dirty d JOIN typed t USING (event_id) WHERE d.usage IS NOT NULL AND t.usage IS NULL)),
  ('mixed_type_col', 'warning', 'extra in production', NULL, 'string', 0))
  t("column", level, issue, reference_type, production_type, cast_failures)""")
def _(spark, sf):
    ref = table(spark, sf, "events").select(
        F.col("ts").alias("date"), "event_id", F.col("value").alias("usage"), F.col("value").alias("kwh"))
    return quality.schema_check(ref, dirty(spark, sf).select("date", "event_id", "usage", "mixed_type_col"))


@query("v14_temporal_report", f"""WITH {READINGS} SELECT count(*) AS "rows", 0::BIGINT AS null_rows, CAST(min(nsm // 3600) AS INTEGER) AS hour_min,
  CAST(max(nsm // 3600) AS INTEGER) AS hour_max, min(dow) AS day_min, max(dow) AS day_max, 1.0::DOUBLE AS hour_norm, 1.0::DOUBLE AS day_norm,
  TRUE AS hour_ok, TRUE AS day_ok, TRUE AS weekend_is_boolean, TRUE AS cyclical_ok, TRUE AS norm_ok, '' AS missing_features, TRUE AS valid
  FROM readings""")
def _(spark, sf):
    df = readings(spark, sf).select(F.col("nsm").alias("NSM"), F.col("day_of_week").alias("Day_of_week"))
    return rounded(quality.temporal_report(temporal.add_temporal_features(df)))


_SPLIT = """s AS (SELECT l_quantity, l_discount, l_tax, l_extendedprice, CASE WHEN l_orderkey % 10 < 7 THEN 'train'
  WHEN l_orderkey % 10 < 9 THEN 'val' ELSE 'test' END AS split FROM lineitem),
  g AS (SELECT l_quantity, l_discount, l_tax, bool_or(split = 'train') AS tr, bool_or(split = 'val') AS va, bool_or(split = 'test') AS te
    FROM s GROUP BY 1, 2, 3),
  c AS (SELECT count(*) AS total, count(*) FILTER (split = 'train') AS ntr, count(*) FILTER (split = 'val') AS nva,
    count(*) FILTER (split = 'test') AS nte, avg(l_extendedprice) FILTER (split = 'train') AS mtr,
    avg(l_extendedprice) FILTER (split = 'val') AS mva, avg(l_extendedprice) FILTER (split = 'test') AS mte,
    stddev_samp(l_extendedprice) FILTER (split = 'train') AS str, stddev_samp(l_extendedprice) FILTER (split = 'val') AS sva,
    stddev_samp(l_extendedprice) FILTER (split = 'test') AS ste FROM s),
  o AS (SELECT count(*) FILTER (tr AND va) AS tv, count(*) FILTER (tr AND te) AS tt, count(*) FILTER (va AND te) AS vt FROM g),
  k AS (SELECT *, abs(ntr / total - 0.7) <= 0.02 AND abs(nva / total - 0.2) <= 0.02 AND abs(nte / total - 0.1) <= 0.02 AS sz,
    tv = 0 AND tt = 0 AND vt = 0 AS lk, abs(mtr - mva) / mtr < 0.1 AND abs(mtr - mte) / mtr < 0.1 AS sm FROM c, o)"""
_SPLIT_COLS = """total, ntr AS train_count, nva AS val_count, nte AS test_count, round(mtr, 4) AS train_mean, round(mva, 4) AS val_mean,
  round(mte, 4) AS test_mean, round(str, 4) AS train_std, round(sva, 4) AS val_std, round(ste, 4) AS test_std,
  tv AS train_val_overlap, tt AS train_test_overlap, vt AS val_test_overlap, sz AS sizes_ok, lk AS no_leakage, sm AS similar_target,
  sz AND lk AND sm AS valid"""
_SHARES = {"train": 0.7, "val": 0.2, "test": 0.1}
_KEYS = ["l_quantity", "l_discount", "l_tax"]


@query("v15_split_report", f"WITH {_SPLIT} SELECT {_SPLIT_COLS} FROM k")
def _(spark, sf):
    return rounded(quality.split_report(split_items(spark, sf), "split", "l_extendedprice", _SHARES, key_cols=_KEYS), 4)


@query("v17_data_gate", f"WITH {_SPLIT} SELECT {_SPLIT_COLS}, 0::BIGINT AS total_nulls, FALSE AS passed FROM k")
def _(spark, sf):
    return rounded(quality.data_gate(split_items(spark, sf), "split", "l_extendedprice", _SHARES, _KEYS), 4)


@query("v15_stratified_split_is_valid", "SELECT TRUE AS sizes_ok, TRUE AS no_leakage, TRUE AS valid")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    labelled = split.stratified_split(o, "o_totalprice", "o_orderkey")
    shares = {"train": 0.7, "val": 0.15, "test": 0.15}
    out = quality.split_report(labelled, "split", "o_totalprice", shares, key_cols=["o_orderkey"])
    return out.select("sizes_ok", "no_leakage", "valid")


