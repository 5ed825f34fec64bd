"""Blocked correlations, category tables, target statistics and merged drift states against plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from wattspan.operators import category_tables, drift, drift_state, gramian, prep, target_stats


def _plain_corr(x, y):
    both = [(a, b) for a, b in zip(x, y) if a is not None and b is not None and not math.isnan(a) and not math.isnan(b)]
    if not both or len({a for a, _ in both}) == 1 or len({b for _, b in both}) == 1:
        return len(both), None
    return len(both), float(np.corrcoef(*np.array(both).T)[0, 1])


def _columns(spark, data):
    names = list(data)
    rows = list(zip(*data.values()))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)), names


@pytest.mark.parametrize("block", [2, 512])
def test_correlations_equal_plain_ones(spark, block):
    rng = np.random.default_rng(3)
    base = rng.normal(size=300)
    data = {
        "a.b": (base * 1e-3 + 1e6).tolist(), "b": (base + rng.normal(size=300)).tolist(), "flat": [0.1] * 300,
        "few": [float(v) if i % 7 == 0 else None for i, v in enumerate(base)], "none": [None] * 300,
        "nan": [math.nan if i % 3 else float(v) for i, v in enumerate(-base)],
        "half": [5.25 if i % 7 == 0 else float(i) for i in range(300)],
    }
    df, names = _columns(spark, data)
    got = {(r.a, r.b): (r.n, r.correlation) for r in gramian.pairwise_correlations(df.repartition(5), names, block).collect()}
    assert set(got) == {(a, b) for i, a in enumerate(names) for b in names[i + 1:]}
    for (a, b), (n, c) in got.items():
        want = _plain_corr(data[a], data[b])
        assert n == want[0] and (c is None) == (want[1] is None), (a, b, c, want)
        assert c is None or c == pytest.approx(want[1], abs=1e-9), (a, b)
    # "half" is constant where "few" has values.
    assert got["few", "half"][1] is None


def test_three_hundred_columns(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 300))
    x[rng.random(x.shape) < 0.1] = np.nan
    rows = [[None if math.isnan(v) else float(v) for v in row] for row in x]
    df, names = _columns(spark, {f"v{k}": [row[k] for row in rows] for k in range(300)})
    got = {(r.a, r.b): r.correlation for r in gramian.pairwise_correlations(df, names, 128).collect()}
    assert len(got) == 300 * 299 // 2
    for a, b in [(0, 1), (5, 200), (127, 128), (250, 299), (0, 299)]:
        assert got[f"v{a}", f"v{b}"] == pytest.approx(_plain_corr([r[a] for r in rows], [r[b] for r in rows])[1], abs=1e-9)


def test_correlations_of_odd_tables(spark):
    df, names = _columns(spark, {"x": [1.0, 2.0, math.inf], "y": [2.0, 1.0, 3.0], "z": [1.0, 5.0, None]})
    got = {(r.a, r.b): r.correlation for r in gramian.pairwise_correlations(df, names).collect()}
    assert math.isnan(got["x", "y"]) and got["x", "z"] == pytest.approx(1) and got["y", "z"] == pytest.approx(-1)
    empty = gramian.pairwise_correlations(df.filter("x > 9 AND x < 9"), names).collect()
    assert [(r.n, r.correlation) for r in empty] == [(0, None)] * 3
    assert gramian.pairwise_correlations(df, ["x"]).collect() == []
    with pytest.raises(ValueError):
        gramian.pairwise_correlations(df, ["x", "x"])


def _vector(v):
    return (int(v.size), [int(i) for i in v.indices])


@pytest.mark.parametrize("kinds", [5_000])
def test_table_encoder_is_saved_with_a_pipeline(spark, tmp_path, kinds):
    df = spark.range(kinds * 2).select("id", F.format_string("c%06d", F.col("id") % kinds).alias("c.d"), (F.col("id") % 2).alias("e"))
    df = df.withColumn("c.d", F.when(F.col("id") != 7, F.col("`c.d`")))
    model = Pipeline(stages=[category_tables.TableEncoder(columns=["c.d", "e"])]).fit(df)
    path = str(tmp_path / "model")
    model.write().save(path)
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    probe = spark.createDataFrame([(1, "c000000", 0), (2, "c000009", 1), (3, "other", 5), (4, None, None)], "id long, `c.d` string, e long")
    for m in (model, loaded):
        out = m.transform(probe)
        assert out.columns == ["id", "c.d_index", "e_index", "c.d_vector", "e_vector"]
        rows = {r.id: r for r in out.collect()}
        at = lambda i: (rows[i]["c.d_index"], _vector(rows[i]["c.d_vector"]), rows[i]["e_index"], _vector(rows[i]["e_vector"]))
        assert at(1) == (0, (kinds - 1, []), 0, (1, []))
        assert at(2) == (9, (kinds - 1, [8]), 1, (1, [0]))
        assert at(3) == (None, (kinds - 1, []), None, (1, [])) and at(4) == at(3)


def test_table_encoder_in_the_preprocessing(spark):
    df = spark.range(40).select(F.col("id").cast("double").alias("x"), F.concat(F.lit("k"), F.col("id") % 5).alias("c"))
    stages = prep.preprocessing(["x"], ["c"], encoder=category_tables.TableEncoder)
    out = stages.fit(df).transform(df)
    assert out.columns == ["x", "c_index", "c_vector"] and sorted({r.c_index for r in out.collect()}) == [0, 1, 2, 3, 4]


def test_table_encoder_of_one_or_no_category(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "x string, y string")
    rows = category_tables.TableEncoder(columns=["x", "y"]).fit(df).transform(df).collect()
    assert [(r.x_index, _vector(r.x_vector), r.y_index, _vector(r.y_vector)) for r in rows] == [(0, (1, []), None, (1, []))] * 2


def test_target_statistics(spark, partitions):
    partitions(3)
    # One category holds most rows; one is null, one has no target at all.
    kind = lambda i: None if i % 11 == 0 else "lone" if i == 50 else "hot"
    value = lambda i: None if i % 5 == 0 else math.nan if i % 13 == 0 else float(i)
    rows = [(i, kind(i), value(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, c string, y double")
    import hashlib

    order = sorted(rows, key=lambda r: (hashlib.md5(f"42|{r[0]}".encode()).hexdigest(), r[0]))
    known = lambda y: y is not None and not math.isnan(y)
    prior = np.mean([y for _, _, y in rows if known(y)])
    seen, want = {}, {}
    for i, c, y in order:
        s, n = seen.get(c, (0.0, 0))
        want[i] = (s + prior) / (n + 1)
        if known(y):
            seen[c] = (s + y, n + 1)
    got = {r.id: r.c_target for r in target_stats.encode_training(df, "c", "y", "id").collect()}
    assert got == pytest.approx(want)
    table = target_stats.target_table(df, "c", "y")
    probe = spark.createDataFrame([("hot",), ("lone",), (None,), ("new",)], "c string")
    scored = {r.c: r.c_target for r in target_stats.encode_scoring(probe, table, "c").collect()}
    whole = lambda c: (seen.get(c, (0, 0))[0] + prior) / (seen.get(c, (0, 0))[1] + 1)
    assert scored == pytest.approx({"hot": whole("hot"), "lone": prior, None: whole(None), "new": prior})
    assert target_stats.encode_training(df.filter("id < 0"), "c", "y", "id").count() == 0


def _report(out):
    return {r["column"]: {k: (round(v, 9) if isinstance(v, float) else v) for k, v in r.asDict().items()} for r in out.collect()}


def test_merged_states_equal_the_raw_union(spark, tmp_path):
    df = spark.range(3000).select(
        "id", (F.col("id") % 97 + F.floor(F.col("id") / 1000) * 5).cast("double").alias("v"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("k"), F.col("id") % (3 + F.floor(F.col("id") / 1500)))).alias("c"))
    run = F.format_string("%02d", F.floor(F.col("id") / 300))
    path = str(tmp_path / "states")
    for k in range(10):
        drift_state.store(drift_state.summarise(df.filter(F.floor(F.col("id") / 300) == k), ["v"], ["c"], run), path)
    # A repeated run replaces itself.
    drift_state.store(drift_state.summarise(df.filter("id < 300"), ["v"], ["c"], run), path)
    states = drift_state.stored(spark, path)
    assert drift_state.newest_runs(states, 4) == ("06", "09")
    for first in (3, 6):
        old, new = drift_state.merged(states, last=f"{first - 1:02d}"), drift_state.merged(states, first=f"{first:02d}")
        cut = first * 300
        raw = df.filter(F.col("id") < cut), df.filter(F.col("id") >= cut)
        assert _report(drift.numeric_drift(old, new, ["v"])) == _report(drift.numeric_drift(*raw, ["v"]))
        assert _report(drift.categorical_drift(old, new, ["c"])) == _report(drift.categorical_drift(*raw, ["c"]))
        assert _report(drift.chi_square_test(old, new, ["c"])) == _report(drift.chi_square_test(*raw, ["c"]))
    assert drift_state.newest_runs(states.filter("run > 'x'"), 2) is None
    with pytest.raises(ValueError):
        drift_state.summarise(df, [], [], run)
