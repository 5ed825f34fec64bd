"""Model scores on closed-form predictions, and trained models."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspan.operators import evaluate, models, search, split, stats, target_stats
from wattspan.plans.features import PreprocessSpec, feature_job, preprocess_job
from wattspan.plans.queries.base import READINGS, query, r, readings, rounded, scratch, table
from wattspan.plans.queries.series import METRICS_SQL
from wattspan.plans.training import TrainingSpec, training_job

_Y = "l_extendedprice"
_LONG = """long AS (SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT),
    CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
    CAST(l_shipdate AS DATE)) AS row_id, l_returnflag AS segment, l_linenumber, l_extendedprice AS y,
  CASE WHEN l_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split, m.model,
  CASE m.model WHEN 'flat' THEN 30000 WHEN 'rate' THEN 1500 * l_quantity ELSE 1400 * l_quantity + 2000 + 100 * l_linenumber END AS p
  FROM lineitem, (VALUES ('flat'), ('rate'), ('line')) m(model))"""


def _item_id():
    """All columns of an item as one text; order and line number alone are not unique."""
    def cents(c):
        # Rounds halves away from zero, as round does, without its decimals.
        v = F.col(c) * 100
        whole = v.cast("bigint")
        return whole + F.when(v - whole >= 0.5, 1).when(v - whole <= -0.5, -1).otherwise(0)

    return F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint"), cents(_Y),
                       cents("l_discount"), cents("l_tax"), F.col("l_shipdate").cast("date"))


def _long(spark, sf):
    """Three closed-form predictions of the item price, in long form."""
    li = table(spark, sf, "lineitem")
    q = F.col("l_quantity")
    forms = {"flat": F.lit(30000.0), "rate": q * 1500, "line": q * 1400 + 2000 + F.col("l_linenumber") * 100}
    structs = [F.struct(F.lit(n).alias("model"), e.alias("p")) for n, e in forms.items()]
    return li.select(
        _item_id().alias("row_id"), F.col("l_returnflag").alias("segment"),
        "l_linenumber", F.col(_Y).alias("y"), F.when(F.col("l_orderkey") % 10 < 7, "train").otherwise("test").alias("split"),
        F.inline(F.array(*structs)),
    )


def _scores(df):
    names = ["rmse", "mae", "r2", "mape", "max_error"]
    keep = [c for c in df.columns if c not in names]
    return df.select(*keep, *[r(c, 6 if c == "r2" else 4).alias(c) for c in names])


@query("m4_regression_metrics", f"WITH {_LONG} SELECT {METRICS_SQL} FROM long WHERE model = 'rate'")
def _(spark, sf):
    return _scores(evaluate.metrics(_long(spark, sf).filter("model = 'rate'"), "y", "p"))


@query("m4_relative_errors", f"""WITH {_LONG}, e AS (SELECT sqrt(avg((y - p) ** 2)) AS rmse, avg(y) AS m, stddev_samp(y) AS s
  FROM long WHERE model = 'rate') SELECT round(rmse / m * 100, 6) AS cv_pct, round(rmse / abs(m), 6) AS rmse_ratio,
  round(rmse / s, 6) AS rmse_normalised, round((30000 - rmse) / 30000 * 100, 6) AS improvement_pct FROM e""")
def _(spark, sf):
    return rounded(evaluate.relative_errors(_long(spark, sf).filter("model = 'rate'"), "y", "p", 30000.0))


@query("m5_metrics_by_segment", f"WITH {_LONG} SELECT model, segment, {METRICS_SQL} FROM long GROUP BY 1, 2")
def _(spark, sf):
    return _scores(evaluate.metrics_by_segment(_long(spark, sf), "model", "segment", "y", "p"))


_EV = """ev AS (SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, value AS y, m.model,
  CASE m.model WHEN 'flat' THEN 50 ELSE 45 + hour(ts) * 0.5 END AS p FROM events, (VALUES ('flat'), ('slope')) m(model))"""


@query("m6_rmse_by_hour", f"""WITH {_EV} SELECT model, hour, count(*) AS n, round(sqrt(avg((y - p) ** 2)), 6) AS rmse FROM ev
  GROUP BY 1, 2 HAVING count(*) > 10""")
def _(spark, sf):
    hour = F.hour("ts")
    forms = F.array(F.struct(F.lit("flat").alias("model"), F.lit(50.0).alias("p")),
                    F.struct(F.lit("slope").alias("model"), (hour * 0.5 + 45).alias("p")))
    long = table(spark, sf, "events").select(hour.alias("hour"), F.col("value").alias("y"), F.inline(forms))
    return rounded(evaluate.rmse_by_hour(long, "model", "hour", "y", "p"))


@query("m7_residual_summary", f"""WITH {_LONG}, s AS (SELECT model, avg(y - p) AS m, stddev_pop(y - p) AS d FROM long GROUP BY 1)
  SELECT model, round(m, 4) AS mean, round(d, 4) AS std, round(m - 2 * d, 4) AS lower, round(m + 2 * d, 4) AS upper FROM s""")
def _(spark, sf):
    return rounded(evaluate.residual_summary(_long(spark, sf), "model", "y", "p"), 4)


_MODELS = ["flat", "rate", "line"]


@query("m8_residual_correlation", """WITH w AS (SELECT l_extendedprice - 30000 AS flat, l_extendedprice - 1500 * l_quantity AS rate,
    l_extendedprice - (1400 * l_quantity + 2000 + 100 * l_linenumber) AS line FROM lineitem) """
       + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM w"
                            for a in _MODELS for b in _MODELS))
def _(spark, sf):
    return rounded(evaluate.residual_correlation(_long(spark, sf), "row_id", "model", _MODELS, "y", "p"))


@query("m11_compare_models", f"""WITH {_LONG}, s AS (SELECT split, model, {METRICS_SQL} FROM long GROUP BY 1, 2)
  SELECT *, model = first_value(model) OVER (PARTITION BY split ORDER BY rmse, model) AS is_best FROM s""")
def _(spark, sf):
    return _scores(evaluate.compare_models(_long(spark, sf), "model", "y", "p", "split"))


@query("m12_summary_by_type", f"""WITH {_LONG}, s AS (SELECT model, CASE WHEN model = 'flat' THEN 'constant' ELSE 'linear' END AS kind,
    sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae FROM long GROUP BY 1)
  SELECT kind, round(avg(rmse), 4) AS rmse_mean, round(min(rmse), 4) AS rmse_min, round(max(rmse), 4) AS rmse_max,
    round(avg(mae), 4) AS mae_mean, round(min(mae), 4) AS mae_min, round(max(mae), 4) AS mae_max FROM s GROUP BY 1""")
def _(spark, sf):
    scores = evaluate.metrics(_long(spark, sf), "y", "p", ["model"])
    typed = scores.withColumn("kind", F.when(F.col("model") == "flat", "constant").otherwise("linear"))
    return rounded(evaluate.summary_by_type(typed, "kind", ["rmse", "mae"]), 4)


@query("m12_improvement", f"""WITH {_LONG}, s AS (SELECT model, sqrt(avg((y - p) ** 2)) AS rmse FROM long GROUP BY 1)
  SELECT model, round(rmse, 4) AS rmse, round(((SELECT rmse FROM s WHERE model = 'flat') - rmse)
    / (SELECT rmse FROM s WHERE model = 'flat') * 100, 6) AS improvement_pct FROM s""")
def _(spark, sf):
    scores = evaluate.metrics(_long(spark, sf), "y", "p", ["model"])
    out = evaluate.improvement_over(scores, "model", "rmse", "flat")
    return out.select("model", r("rmse", 4).alias("rmse"), r("improvement_pct").alias("improvement_pct"))


@query("m15_threshold_gate", f"""WITH {_LONG}, s AS (SELECT sqrt(avg((y - p) ** 2)) AS rmse, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2
    FROM long WHERE model = 'rate') SELECT round(rmse, 4) AS rmse, round(r2, 6) AS r2, rmse < 16000 AS rmse_ok, r2 > 0.99 AS r2_ok,
    rmse < 16000 AND r2 > 0.99 AS passed FROM s""")
def _(spark, sf):
    scores = evaluate.metrics(_long(spark, sf).filter("model = 'rate'"), "y", "p")
    out = evaluate.gate(scores, 16000.0, 0.99)
    return out.select(r("rmse", 4).alias("rmse"), r("r2").alias("r2"), "rmse_ok", "r2_ok", "passed")


@query("m16_worst_predictions", f"""WITH {_LONG} SELECT row_id, y, p, round(abs(y - p), 4) AS abs_error FROM long
  WHERE model = 'rate' ORDER BY abs(y - p) DESC, row_id, y LIMIT 10""")
def _(spark, sf):
    long = _long(spark, sf).filter("model = 'rate'").select("row_id", "y", "p")
    return rounded(evaluate.worst_predictions(long, "y", "p", ["row_id", "y"]), 4)


# ---- trained models ----------------------------------------------------------------

_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]


def frame(spark, sf):
    """Items with their part: an id of all the item's columns, numeric features and the price."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate", _Y)
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    joined = li.join(part, li.l_partkey == part.p_partkey)
    return joined.select(_item_id().alias("id"), *_FEATURES, _Y)


_SMALL = {"maxIter": 5, "maxDepth": 3}


@query("m1_boosted_trees")
def _(spark, sf):
    data = split.random_split(frame(spark, sf), "id")
    model = models.train(data.filter("split = 'train'"), "gbt", _FEATURES, _Y, **_SMALL)
    return evaluate.metrics(models.score(model, data.filter("split = 'test'")), _Y, "prediction")


@query("m1_linear_regression", f"""WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
  f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM d)
  SELECT count(*) AS n, round(sqrt(avg((y - a - b * x) ** 2)), 3) AS rmse FROM d, f""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    model = models.train(li, "linear", ["l_quantity"], _Y, solver="normal")
    out = evaluate.metrics(models.score(model, li), _Y, "prediction")
    return out.select("n", r("rmse", 3).alias("rmse"))


@query("m2_cross_validation")
def _(spark, sf):
    folds, _, _ = models.cross_validate(frame(spark, sf), "gbt", _FEATURES, _Y, "id", 5, **_SMALL)
    return folds


@query("m2_cross_validation_summary")
def _(spark, sf):
    _, summary, _ = models.cross_validate(frame(spark, sf), "forest", _FEATURES, _Y, "id", 3, numTrees=5, maxDepth=3)
    return summary


@query("m3_random_search")
def _(spark, sf):
    data = split.random_split(frame(spark, sf), "id")
    space = {"maxIter": (3, 6), "maxDepth": (2, 4), "stepSize": (0.05, 0.3)}
    trials, _, _ = models.random_search(
        data.filter("split = 'train'"), data.filter("split = 'val'"), _FEATURES, _Y, 3, space=space)
    return trials


@query("m9_batch_scoring")
def _(spark, sf):
    data = split.random_split(frame(spark, sf), "id")
    model = models.train(data.filter("split = 'train'"), "forest", _FEATURES, _Y, numTrees=5, maxDepth=4)
    return stats.prediction_summary(models.score(model, data))


@query("m10_stacking")
def _(spark, sf):
    data = split.random_split(frame(spark, sf), "id")
    bases = {"gbt": ("gbt", _SMALL), "forest": ("forest", {"numTrees": 5, "maxDepth": 3}), "linear": ("linear", {})}
    fitted = models.stack(data.filter("split = 'train'"), bases, _FEATURES, _Y, "id", k=2)
    long = fitted.long_predictions(data.filter("split = 'test'"), "id")
    return evaluate.compare_models(long, "model", "y", "prediction")


@query("m13_permutation_importance")
def _(spark, sf):
    data = frame(spark, sf)
    model = models.train(data, "gbt", _FEATURES, _Y, **_SMALL)
    return models.permutation_importance(model, data, _FEATURES, _Y, "id")


@query("m15_training_job")
def _(spark, sf):
    data = split.stratified_split(frame(spark, sf), _Y, "id")
    spec = TrainingSpec(_FEATURES, _Y, params=_SMALL, key_cols=["id"], max_rmse=20000.0, min_r2=0.5)
    _, gate, scores = training_job(data, spec, scratch(spark, "model"))
    return scores.withColumn("data_passed", gate.select("passed").scalar())


_LINE = """o AS (SELECT o_orderkey, o_custkey * 1.0::DOUBLE AS x, o_totalprice AS y, CAST((row_number() OVER (ORDER BY md5(concat('42|', o_orderkey)))
  - 1) % 3 AS INTEGER) AS fold FROM orders)"""


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("x"), F.col("o_totalprice").alias("y"))


@query("m2_linear_cross_validation", f"""WITH {_LINE}, f AS (SELECT k.k AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
    FROM o, range(3) k(k) WHERE o.fold <> k.k GROUP BY 1)
  SELECT o.fold, count(*) AS n, round(sqrt(avg((y - a - b * x) ** 2)), 3) AS rmse, round(avg(abs(y - a - b * x)), 3) AS mae
  FROM o JOIN f ON o.fold = f.fold GROUP BY 1""")
def _(spark, sf):
    folds, _, _ = models.cross_validate(_orders(spark, sf), "linear", ["x"], "y", "o_orderkey", 3, solver="normal")
    return folds.select("fold", "n", r("rmse", 3).alias("rmse"), r("mae", 3).alias("mae"))


@query("m2_linear_summary", f"""WITH {_LINE}, f AS (SELECT k.k AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
    FROM o, range(3) k(k) WHERE o.fold <> k.k GROUP BY 1),
  m AS (SELECT sqrt(avg((y - a - b * x) ** 2)) AS rmse FROM o JOIN f ON o.fold = f.fold GROUP BY o.fold)
  SELECT round(avg(rmse), 3) AS rmse_mean, round(stddev_pop(rmse), 3) AS rmse_std FROM m""")
def _(spark, sf):
    _, summary, _ = models.cross_validate(_orders(spark, sf), "linear", ["x"], "y", "o_orderkey", 3, solver="normal")
    return summary.select(r("rmse_mean", 3).alias("rmse_mean"), r("rmse_std", 3).alias("rmse_std"))


@query("m9_linear_scoring", """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
  SELECT count(*) AS n, round(avg(a + b * l_quantity), 3) AS "avg", round(min(a + b * l_quantity), 3) AS "min",
    round(max(a + b * l_quantity), 3) AS "max" FROM lineitem, f""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    model = models.train(li, "linear", ["l_quantity"], _Y, solver="normal")
    return rounded(stats.prediction_summary(models.score(model, li)), 3)


@query("m13_linear_importance", """WITH l AS (SELECT o_orderkey, o_custkey + 10.0::DOUBLE * o_totalprice AS y, o_totalprice AS x,
    row_number() OVER (ORDER BY md5(concat('42|', o_orderkey))) AS r1, row_number() OVER (ORDER BY md5(concat('43|', o_orderkey))) AS r2 FROM orders),
  f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM l),
  j AS (SELECT p.y, p.x, q.x AS s FROM l p JOIN l q ON p.r1 = q.r2)
  SELECT 'x' AS feature, round(sqrt(avg((y - a - b * s) ** 2)) - sqrt(avg((y - a - b * x) ** 2)), 1) AS importance FROM j, f""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("x"), (F.col("o_custkey") + F.col("o_totalprice") * 10.0).alias("y"))
    model = models.train(o, "linear", ["x"], "y", solver="normal")
    out = models.permutation_importance(model, o, ["x"], "y", "o_orderkey")
    return out.select("feature", r("importance", 1).alias("importance"))


# One deep tree on the line number has a leaf per number, which predicts that number's mean.
_ONE_TREE = {"maxIter": 1, "maxDepth": 6}
_ITEM = """i AS (SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT),
    CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
    CAST(l_shipdate AS DATE)) AS id, l_orderkey % 10 < 7 AS train, l_linenumber AS x, l_extendedprice AS y FROM lineitem)"""


def _items(spark, sf):
    return table(spark, sf, "lineitem").select(
        _item_id().alias("id"), (F.col("l_orderkey") % 10 < 7).alias("train"), F.col("l_linenumber").cast("double").alias("x"),
        F.col(_Y).alias("y"))


@query("m1_one_tree", f"""WITH {_ITEM}, f AS (SELECT x, avg(y) AS p FROM i WHERE train GROUP BY 1)
  SELECT count(*) AS n, round(sqrt(avg((y - p) ** 2)), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae FROM i JOIN f USING (x) WHERE NOT train""")
def _(spark, sf):
    items = _items(spark, sf)
    model = models.train(items.filter("train"), "gbt", ["x"], "y", **_ONE_TREE)
    out = evaluate.metrics(models.score(model, items.filter("NOT train")), "y", "prediction")
    return out.select("n", r("rmse", 3).alias("rmse"), r("mae", 3).alias("mae"))


@query("m2_one_tree_cross_validation", f"""WITH {_ITEM}, o AS (SELECT x, y, CAST((row_number() OVER (ORDER BY md5(concat('42|', id))) - 1) % 3 AS INTEGER) AS fold FROM i),
  f AS (SELECT k.k AS fold, x, avg(y) AS p FROM o, range(3) k(k) WHERE o.fold <> k.k GROUP BY 1, 2)
  SELECT o.fold, count(*) AS n, round(sqrt(avg((y - p) ** 2)), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae
  FROM o JOIN f ON o.fold = f.fold AND o.x = f.x GROUP BY 1""")
def _(spark, sf):
    folds, _, _ = models.cross_validate(_items(spark, sf), "gbt", ["x"], "y", "id", 3, **_ONE_TREE)
    return folds.select("fold", "n", r("rmse", 3).alias("rmse"), r("mae", 3).alias("mae"))


@query("m3_one_tree_search", f"""WITH {_ITEM}, f AS (SELECT x, avg(y) AS p FROM i WHERE train GROUP BY 1),
  m AS (SELECT sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae FROM i JOIN f USING (x) WHERE NOT train)
  SELECT CAST(t AS INTEGER) AS trial, 'complete' AS state, round(rmse, 3) AS rmse, round(mae, 3) AS mae, TRUE AS in_space, TRUE AS best_is_first
  FROM m, range(4) r(t)""")
def _(spark, sf):
    # Leaves are far larger than these bounds, so every trial has the same tree and the first one is the best.
    items = _items(spark, sf)
    trials, best, _ = search.density_search(
        items.filter("train"), items.filter("NOT train"), "gbt", ["x"], "y", 4, space={"minInstancesPerNode": (1, 9)},
        fixed=_ONE_TREE, startup=2, parallel=2)
    drawn = F.col("params")["minInstancesPerNode"]
    first = trials.filter("trial = 0").select(drawn).scalar()
    return trials.select("trial", "state", r("rmse", 3).alias("rmse"), r("mae", 3).alias("mae"), drawn.between(1, 9).alias("in_space"),
                         (first == F.lit(float(best["minInstancesPerNode"]))).alias("best_is_first"))


@query("m9_one_tree_scoring", f"""WITH {_ITEM}, f AS (SELECT x, avg(y) AS p FROM i WHERE train GROUP BY 1)
  SELECT count(*) AS n, round(avg(p), 3) AS "avg", round(min(p), 3) AS "min", round(max(p), 3) AS "max" FROM i JOIN f USING (x)""")
def _(spark, sf):
    items = _items(spark, sf)
    model = models.train(items.filter("train"), "gbt", ["x"], "y", **_ONE_TREE)
    return rounded(stats.prediction_summary(models.score(model, items)), 3)


_PREP = """e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
  b AS (SELECT readings.*, CAST(least(floor((value - lo) * 10 / (hi - lo)) + 1, 10) AS INTEGER) AS bin, md5(concat('42|', event_id)) AS h FROM readings, e),
  k AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY h) AS rn, count(*) OVER (PARTITION BY bin) AS n FROM b),
  s AS (SELECT *, CASE WHEN rn <= round(n * 0.70::DOUBLE) THEN 'train' WHEN rn <= round(n * (0.70::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM k),
  m AS (SELECT avg(nsm) AS mu, stddev_pop(nsm) AS sd FROM s WHERE split = 'train')"""


@query("feature_and_preprocess_jobs", f"""WITH {READINGS}, {_PREP} SELECT split, count(*) AS n, round(avg((nsm - mu) / sd), 6) + 0 AS nsm,
  round(avg(CASE week_status WHEN 'Weekend' THEN 1 ELSE 0 END), 6) AS weekend FROM s, m GROUP BY 1""")
def _(spark, sf):
    cleaned = readings(spark, sf).select(
        "event_id", "value", "event_type", "week_status", F.col("nsm").alias("NSM"), F.col("day_of_week").alias("Day_of_week"))
    featured = feature_job(cleaned, "NSM", "Day_of_week", "value")["featured"]
    spec = PreprocessSpec("value", "event_id", ["NSM", "cyclical_hour_sin"], ["event_type"],
                          {"week_status": {"Weekday": 0, "Weekend": 1}})
    out, _, _ = preprocess_job(featured, spec)
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), r(F.avg("NSM")).alias("nsm"), r(F.avg("week_status")).alias("weekend"))


@query("m1_ordered_target", """WITH p AS (SELECT avg(o_totalprice) AS p FROM orders)
  SELECT o_orderkey, round((CASE WHEN count(o_totalprice) OVER w > 0 THEN sum(o_totalprice) OVER w ELSE 0 END + p) / (count(o_totalprice) OVER w + 1), 4)
    AS o_orderpriority_target FROM orders, p
  WINDOW w AS (PARTITION BY o_orderpriority ORDER BY md5(concat('42|', o_orderkey)), o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    out = target_stats.encode_training(orders, "o_orderpriority", "o_totalprice", "o_orderkey")
    return out.select("o_orderkey", r("o_orderpriority_target", 4).alias("o_orderpriority_target"))


@query("m1_target_scoring", """WITH t AS (SELECT * FROM orders WHERE o_custkey % 4 <> 0 OR o_orderkey % 2 = 0),
  p AS (SELECT avg(o_totalprice) AS p FROM t), c AS (SELECT o_custkey, sum(o_totalprice) AS s, count(*) AS n FROM t GROUP BY 1)
  SELECT o_orderkey, round((coalesce(s, 0) + 10 * p) / (coalesce(n, 0) + 10), 4) AS customer
  FROM (SELECT * FROM orders WHERE o_orderkey % 2 = 1) LEFT JOIN c USING (o_custkey), p""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    known = target_stats.target_table(orders.filter("o_custkey % 4 <> 0 OR o_orderkey % 2 = 0"), "o_custkey", "o_totalprice")
    out = target_stats.encode_scoring(orders.filter("o_orderkey % 2 = 1"), known, "o_custkey", 10.0, "customer")
    return out.select("o_orderkey", r("customer", 4).alias("customer"))
