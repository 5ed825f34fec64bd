import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattspan.functions.columns import qcol
from wattspan.functions.text import title_case
from wattspan.operators import clean, dedup, impute, quality, stats


def col(df, name):
    return [r[0] for r in df.select(qcol(name)).collect()]


def test_lenient_casts(spark):
    texts = ["1.5", " 2 ", "12.7", "1e3", "abc", "", None, "NAN", "12d", "Infinity", "-4"]
    df = spark.createDataFrame([(t, t, "x") for t in texts], "`a.b` string, n string, junk string")
    out = clean.cast_schema(df, {"a.b": "double", "n": "bigint", "absent": "double"}, ["junk"])
    assert col(out, "a.b") == [1.5, 2.0, 12.7, 1000.0, None, None, None, None, None, None, -4.0]
    assert col(out, "n") == [1, 2, 12, 1000, None, None, None, None, None, None, -4]
    assert out.columns == ["a.b", "n"]


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a string, b double")
    assert clean.cast_schema(df, {"a": "double"}).count() == 0
    assert [tuple(r) for r in quality.null_profile(df).collect()] == [("a", 0, 0.0, 0), ("b", 0, 0.0, 0)]
    rep = dedup.duplicate_report(df, "x").first()
    assert (rep["total_count"], rep["duplicate_count"], rep["duplicate_pct"]) == (0, 0, 0.0)


def test_blank_and_sparse(spark):
    df = spark.createDataFrame([("x", 1), (" nan ", 1), ("N/a", 1), ("  ", 1), (None, 1)], "d string, v int")
    assert col(clean.drop_blank(df, "d"), "d") == ["x"]
    wide = spark.createDataFrame([(1, None, None), (1, 2, None), (None, None, None)], "a int, b int, c int")
    assert clean.drop_sparse(wide, max_nulls=1).count() == 1
    assert clean.drop_sparse(wide, max_share=0.67).count() == 2


def test_clamp(spark):
    df = spark.createDataFrame([(-5.0, 120), (50.0, None), (None, -1)], "a double, `CO2(t)` bigint")
    out = clean.clamp(df, {"CO2(t)": {"min": 0, "max": 100}, "gone": {"min": 1}}, ["a"])
    assert col(out, "a") == [5.0, 50.0, None] and col(out, "CO2(t)") == [100, None, 0]
    assert dict(out.dtypes)["CO2(t)"] == "bigint"
    assert col(clean.clamp(df, {"a": {"min": 0}}), "a") == [0.0, 50.0, None]


def test_title_case(spark):
    df = spark.createDataFrame([("lIGHT_lOAD",), ("a b_c",), ("MONDAY",), (None,)], "s string")
    assert col(df.select(title_case(F.col("s")).alias("s")), "s") == ["Light_Load", "A B_C", "Monday", None]


def test_categories(spark):
    df = spark.createDataFrame([(" wEEKDAY ",), ("weekend",), ("WEEKEND",), ("NAN",), (None,)], "s string")
    assert col(clean.clean_categories(df, ["s"]), "s") == ["Weekday", "Weekend", "Weekend", "Weekend", "Weekend"]
    empty = spark.createDataFrame([(None,), ("nan",)], "s string")
    assert col(clean.clean_categories(empty, ["s"]), "s") == ["Unknown", "Unknown"]
    tie = spark.createDataFrame([("b",), ("a",)], "s string")
    assert stats.mode_value(tie, "s").first()[0] == "a"


def test_dates_and_tokens(spark):
    df = spark.createDataFrame([(" 03/01/2018 00:15 ",), ("31/31/2018 00:00",), (None,)], "date string")
    assert col(clean.tidy_strings_and_dates(df, "date"), "date") == [dt.datetime(2018, 1, 3, 0, 15)]
    df = spark.createDataFrame([("nan",), ("None",), ("ok",), (None,)], "s string")
    assert col(clean.null_tokens(df), "s") == [None, None, "ok", None]


def test_select_align_dummies(spark):
    df = spark.createDataFrame([(1, 2.0, "3")], "a int, b double, c string")
    assert clean.select_features(df, ["a", "b"], ["b"]).columns == ["a"]
    with pytest.raises(ValueError):
        clean.select_features(df, ["zz"])
    ref = spark.createDataFrame([(1.0, 1)], "c double, a bigint")
    assert clean.align_schema(ref, df).dtypes == ref.dtypes
    d = spark.createDataFrame([(0, 1), (1, 0), (0, 0)], "x int, y int")
    assert col(clean.labels_from_dummies(d, {"x": "X", "y": "Y"}, "l"), "l") == ["Y", "X", "X"]


def test_dedup_modes(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4), (None, "e", 5)], "k int, v string, id int")
    assert sorted(col(dedup.keep_one(df, ["k"], ["id"]), "v")) == ["a", "c", "d"]
    assert sorted(col(dedup.keep_one(df, ["k"], ["id"], "last"), "v")) == ["b", "c", "e"]
    assert col(dedup.keep_none(df, ["k"]), "v") == ["c"]
    twins = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert col(dedup.keep_none(twins), "k") == [2] and dedup.keep_one(twins, None, []).count() == 2
    rep = dedup.duplicate_report(twins, "t").first()
    assert (rep["duplicate_count"], rep["duplicate_pct"], rep["duplicate_patterns"]) == (2, 66.67, 1)
    with pytest.raises(ValueError):
        dedup.duplicate_report(df, "x", ["nope"])


def test_centre_fill(spark):
    df = spark.createDataFrame([(1.0, "x"), (3.0, "x"), (None, None), (10.0, "y")], "v double, s string")
    out = impute.centre_fill(df, ["v"], ["s"])
    assert col(out, "v")[2] == 3.0 and col(out, "s")[2] == "x"


def test_range_report(spark):
    df = spark.createDataFrame([(float(i), str(-i)) for i in range(10)] + [(None, "bad")], "a double, t string")
    r = {x["column"]: x for x in quality.range_report(df, {"a": {"max": 3}, "t": {"min": -8}, "zz": {"min": 0}}).collect()}
    assert (r["a"]["violations"], r["a"]["total_count"], r["a"]["violation_pct"], r["a"]["examples"]) == (6, 10, 60.0, [4.0, 5.0, 6.0, 7.0, 8.0])
    assert (r["t"]["violations"], r["t"]["total_count"], r["t"]["status"]) == (1, 10, "violations_found")
    assert (r["zz"]["status"], r["zz"]["examples"]) == ("column_not_found", [])


def test_row_errors(spark):
    df = spark.createDataFrame([(1.0, "5"), (None, "5"), (float("nan"), "5"), (99.0, "5"), (1.0, "x")], "a double, b string")
    errors = col(quality.row_errors(df, ["a", "b"], {"a": (0, 10)}), "error")
    assert errors[0] is None and "null value" in errors[1] and "null value" in errors[2]
    assert "out of range" in errors[3] and "must be numeric" in errors[4]
    assert "Missing features: ['c']" in col(quality.row_errors(df, ["a", "c"], {}), "error")[0]
    good, bad = quality.split_valid(quality.row_errors(df, ["a", "b"], {"a": (0, 10)}))
    assert (good.count(), bad.count()) == (1, 4)


def test_cleaned_report(spark):
    a = spark.createDataFrame([(i, "x") for i in range(5)], "k long, s string")
    assert quality.cleaned_report(a, a, 0).first()["all_checks_passed"]
    b = spark.createDataFrame([(1, None), (1, None)], "k int, s string")
    r = quality.cleaned_report(b, a, 1).first()
    assert (r["shape_match"], r["row_count_diff"], r["null_count"], r["duplicate_count"], r["type_mismatches"]) == (False, -3, 2, 1, 1)


def test_sql_stats_literal(spark):
    usage = [10.5, 12.3, 15.7, 11.2, 13.8, 20.1, 18.5, 16.3]
    kinds = ["Light", "Medium", "Maximum", "Light", "Medium", "Maximum", "Maximum", "Medium"]
    df = spark.createDataFrame([(u, k, 3600 * (i + 1)) for i, (u, k) in enumerate(zip(usage, kinds))], "`Usage_kWh` double, Load_Type string, NSM long")
    top = stats.group_stats(df, ["Load_Type"], "Usage_kWh").collect()
    assert [r["Load_Type"] for r in top] == ["Maximum", "Medium", "Light"] and top[0]["avg"] == 18.1
    hourly = stats.time_bucket_stats(df, "NSM", "Usage_kWh").collect()
    assert [r["hour"] for r in hourly] == list(range(1, 9)) and hourly[0]["std_value"] is None
    with pytest.raises(ValueError):
        stats.time_bucket_stats(df, "NSM", "Usage_kWh", "week")
    assert [r["Usage_kWh"] for r in stats.top_rows(df, "Usage_kWh", 2).collect()] == [20.1, 18.5]


def test_histogram_and_power_factor(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double")
    h = stats.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["n"] for r in h] == [2, 0, 0, 0, 1] and h[4]["upper"] == 10.0
    pf = spark.createDataFrame([(0.96, 0.96), (0.9, 0.9), (0.5, 0.5)], "a double, b double")
    out = stats.power_factor_classes(pf, "a", "b").collect()
    assert [(r["efficiency_class"], r["efficiency_score"]) for r in out] == [("Excelente", 100), ("Muy Bueno", 90), ("Mejorable", 40)]
    cost = stats.energy_cost(spark.createDataFrame([(100.0, True), (100.0, False)], "k double, p boolean"), "k", F.col("p")).collect()
    assert cost[0]["total_cost"] == pytest.approx(22.5) and cost[0]["savings_potential"] == pytest.approx(7.5) and cost[1]["surcharge"] == 0


def test_repeated_and_null_corrections(spark):
    """Of several corrections for a key the smallest counts; rows are never multiplied."""
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    table = spark.createDataFrame([("a", "y"), ("a", "x"), (None, "z")], "k string, v string")
    got = sorted((r.id, r.c) for r in clean.map_values_from(df, "c", table, "k", "v").collect())
    assert got == [(1, "x"), (2, "b"), (3, None)]
