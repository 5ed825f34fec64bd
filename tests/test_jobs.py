import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattspan.operators import drift, evaluate, history, models, textlog
from wattspan.plans.monitoring import MonitoringSpec, log_drift, monitoring_job
from wattspan.sources import io, session


@pytest.mark.parametrize("text, want", [
    ("What will be the consumption tomorrow?", "prediction"), ("Why was there a spike last Friday?", "analysis"),
    ("What if we shift the load to save energy?", "what-if"), ("Explain what is power factor", "explanation"),
    ("Hello there", "general"), ("¿Por qué hay un patrón raro?", "analysis"), ("¿Qué será mañana?", "prediction"),
    ("repredicted unforecastable", "general")])
def test_intents(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert textlog.tag_intent(df, "t").first()["intent"] == want


@pytest.mark.parametrize("text, want", [
    ("Forecast at 10am with Medium load", (36000, 0, "Medium", "Weekday")), ("on Saturday at 2pm, high load", (50400, 5, "Maximum", "Weekend")),
    ("el domingo 14:30", (52200, 6, "Medium", "Weekend")), ("tomorrow 12am light", (0, 3, "Light", "Weekday")),
    ("nothing here", (36000, 0, "Medium", "Weekday")), ("hoy", (36000, 2, "Medium", "Weekday"))])
def test_slots(spark, text, want):
    out = textlog.extract_slots(spark.createDataFrame([(text,)], "t string"), "t", dt.date(2024, 1, 17), inputs=True).first()
    assert (out["nsm"], out["day_of_week"], out["load_type"], out["week_status"]) == want and out["co2"] == 0.05


def test_last_turns(spark):
    df = spark.createDataFrame([(1, i) for i in range(12)] + [(2, 0)], "c long, turn long")
    assert sorted(r["turn"] for r in textlog.last_turns(df, ["c"], "turn").filter("c = 1").collect()) == list(range(2, 12))


def _runs(spark, values):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, rmse double")


@pytest.mark.parametrize("values, trend", [([1.0, 2.0, 3.0], "increasing"), ([3.0, 2.0, 1.0], "decreasing"), ([2.0, 2.0, 2.0], "stable"),
                                           ([5.0], None), ([9.0, None, 1.0, 1.0, 1.0, 1.0, 1.0], "stable")])
def test_trend(spark, values, trend):
    out = history.trends(_runs(spark, values), ["rmse"]).first()
    assert out["trend"] == trend


def test_anomaly(spark):
    calm = history.anomalies(_runs(spark, [1.0, 1.0]), ["rmse"]).first()
    assert calm["z_score"] is None and not calm["is_anomalous"]
    assert history.anomalies(_runs(spark, [1.0] * 4), ["rmse"]).first()["z_score"] == 0
    assert history.anomalies(_runs(spark, [1.0, 1.1] * 6 + [9.0]), ["rmse"]).first()["is_anomalous"]


def test_metrics_literal(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 2.1), (3.0, 2.9), (4.0, 4.2), (5.0, 4.8), (0.0, 0.1)], "y double, p double")
    m = evaluate.metrics(df, "y", "p").first()
    assert m["rmse"] == pytest.approx((0.12 / 6) ** 0.5) and m["max_error"] == pytest.approx(0.2)
    assert m["mape"] == pytest.approx(100 / 5 * (0.1 + 0.05 + 0.1 / 3 + 0.05 + 0.04)) and m["r2"] == pytest.approx(1 - 0.12 / 17.5)
    flat = evaluate.metrics(df.withColumn("y", F.lit(0.0)), "y", "p").first()
    assert flat["r2"] is None and flat["mape"] is None
    assert not evaluate.gate(evaluate.metrics(df, "y", "p"), 0.1, 0.9).first()["passed"]


def test_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        io.read_parquet(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        io.read_csv(spark, str(tmp_path / "none.csv"), ["a"])
    with pytest.raises(ValueError):
        io.load_table(spark, str(tmp_path), "t", mode="merge")
    path = str(tmp_path / "h")
    for i in (1, 50, 100):
        io.append_history(spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(days=i), i)], "timestamp timestamp_ntz, v int"), path)
    assert [r["v"] for r in io.read_history(spark, path, 2).collect()] == [100, 50]
    io.rewrite_retained(spark, path, str(tmp_path / "kept"), 90)
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 2
    spark.range(3).createOrReplaceTempView("three_rows")
    tables = session.Tables(spark)
    assert tables.query("SELECT count(*) AS n FROM three_rows WHERE id < :top", top=2).first()["n"] == 2
    assert tables.exists("three_rows") and not tables.exists("no_rows") and tables.schema("three_rows") == [("id", "bigint")]
    assert tables.reference("three_rows", 1).count() == 1
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert session.size_shuffles(spark, 10 << 30) == 40 and session.size_shuffles(spark, 1) == 40
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _history(spark, path, days=(1, 9, 10, 10, 50, 100)):
    start = dt.datetime(2024, 1, 1, 12)
    rows = [(start + dt.timedelta(days=d, hours=(0, 0, 0, 4, 0, 2)[k]), 10 * d + k) for k, d in enumerate(days)]
    io.append_history(spark.createDataFrame(rows, "timestamp timestamp_ntz, v int"), path)


def test_expired_entries_are_removed(spark, tmp_path):
    path = str(tmp_path / "h")
    _history(spark, path)
    # The limit falls between the two entries of day 10.
    assert io.remove_expired(spark, path, 90) == 3 and io.remove_expired(spark, path, 90) == 0
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [103, 504, 1005]
    _history(spark, path, (10, 10))
    spark.sql("SELECT CAST(NULL AS timestamp_ntz) AS timestamp, 7 AS v").createOrReplaceTempView("dateless")
    io.append_history(spark.table("dateless"), path)
    days = sorted(f.name for f in (tmp_path / "h").iterdir() if f.is_dir())
    assert io.remove_expired(spark, path, 51) == 3
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [7, 504, 1005]
    left = sorted(f.name for f in (tmp_path / "h").iterdir() if f.is_dir())
    assert "run_date=2024-01-11" in days and left == ["run_date=2024-02-20", "run_date=2024-04-10", "run_date=__HIVE_DEFAULT_PARTITION__"]


@pytest.mark.parametrize("step", ["written", "aside", "swapped"])
def test_an_interrupted_removal_loses_nothing(spark, tmp_path, step):
    path, root = str(tmp_path / "h"), tmp_path / "h"
    _history(spark, path, (10, 10, 100))
    day = "run_date=2024-01-11"
    spark.read.parquet(path).filter("v = 101").drop("run_date").write.parquet(f"{path}/_kept-{day}")
    if step != "written":
        (root / day).rename(root / f"_aside-{day}")
    if step == "swapped":
        (root / f"_kept-{day}").rename(root / day)
    io.recover_history(spark, path)
    # Before the day is put aside the removal is taken back, later it is finished.
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ([100, 101, 1002] if step == "written" else [101, 1002])
    assert not [f for f in root.iterdir() if f.name.startswith(("_kept", "_aside"))]


def test_monitoring_job(spark, tmp_path):
    ref = spark.range(2000).select((F.col("id") % 100).cast("double").alias("v"), F.concat(F.lit("c"), F.col("id") % 3).alias("c"))
    cur = ref.withColumn("v", F.col("v") + 80).withColumn("y", F.lit(1.0))
    spec = MonitoringSpec(["v"], ["c"])
    out = monitoring_job(ref, cur, spec, "2024-01-01 00:00:00", str(tmp_path / "h"))
    assert [r["drifted"] for r in out["columns"].orderBy("column").collect()] == [False, True]
    assert out["alert"].first()["severity"] == "CRITICAL" and out["run"].first()["number_of_drifted_features"] == 1
    again = monitoring_job(ref, ref, spec, "2024-01-02 00:00:00", str(tmp_path / "h"))
    assert again["alert"].first()["severity"] == "INFO" and spark.read.parquet(str(tmp_path / "h")).count() == 2
    with pytest.raises(ValueError):
        monitoring_job(ref, cur.drop("c"), spec, "2024-01-03 00:00:00", str(tmp_path / "h"))
    with pytest.raises(ValueError):
        monitoring_job(ref, ref.filter("v < 0"), spec, "2024-01-03 00:00:00", str(tmp_path / "h"))
    with pytest.raises(ValueError):
        log_drift(ref, cur, "2024-01-01 00:00:00")
    assert drift.drifted_features(out["columns"], 0.1).count() == 1


def test_models_learn_a_line(spark):
    df = spark.range(600).select("id", (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"))
    df = df.withColumn("y", F.col("x") * 3 + 5).cache()
    fitted = models.stack(df, {"linear": ("linear", {}), "gbt": ("gbt", {"maxIter": 3, "maxDepth": 3})}, ["x", "z"], "y", "id", k=2, penalty=0.01)
    table = {r["model"]: r for r in evaluate.compare_models(fitted.long_predictions(df, "id"), "model", "y", "prediction").collect()}
    assert set(table) == {"linear", "gbt", "ensemble"} and table["linear"]["rmse"] < 1e-6 and table["ensemble"]["r2"] > 0.95
    assert set(fitted.contributions()) == {"linear", "gbt"} and sum(r["is_best"] for r in table.values()) == 1
    imp = models.permutation_importance(fitted.bases["linear"], df, ["x", "z"], "y", "id").collect()
    assert imp[0]["feature"] == "x" and imp[0]["importance"] > 1 and imp[1]["importance"] == pytest.approx(0, abs=1e-6)
    with pytest.raises(ValueError):
        models.train(df, "net", ["x"], "y")


def test_history_keeps_undated_runs(spark, tmp_path):
    path = f"{tmp_path}/undated"
    rows = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-01 00:00:00', 1), (TIMESTAMP_NTZ '2024-01-02 00:00:00', 2), "
                     "(CAST(NULL AS TIMESTAMP_NTZ), 3) AS t(timestamp, v)")
    io.append_history(rows, path)
    assert [r["v"] for r in io.read_history(spark, path, 3).collect()] == [2, 1, 3]
    assert [r["v"] for r in io.read_history(spark, path, 2).collect()] == [2, 1]


@pytest.mark.parametrize("name", ["r11_history_summary", "s10_history_append", "s11_history_scan", "s12_remove_expired", "s12_retention"])
def test_history_of_zero_values(spark, tmp_path, name):
    import __spark_entry__ as entry
    import duckdb
    from check_oracle import run

    # A zero, a missing value and a day of nothing else; the relative error of a zero is infinite.
    values = [0.0, 40.0, None, 55.5, -0.0, 0.0, 61.0]
    rows = [(dt.datetime(2024, 1, 1 + i * 3, i), v) for i, v in enumerate(values)] + [(dt.datetime(2024, 1, 1, 5), 70.0)]
    events = spark.createDataFrame(rows, "ts timestamp_ntz, value double")
    events.write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    count, difference = run(spark, con, str(tmp_path), name, entry.queries(), entry.oracle_sql())
    assert count > 0 and difference is None, difference
