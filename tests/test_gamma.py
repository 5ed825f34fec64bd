"""Tail probabilities and the chi-square test."""

from math import erfc, exp, factorial, lgamma, sqrt

import pytest
from pyspark.sql import functions as F

from wattspan.functions.gamma import chi_square_p_value, log_gamma, upper_gamma
from wattspan.operators import drift

# Upper five per cent points of the chi-square distribution.
FIVE_PER_CENT = {1: 3.841458820694124, 2: 5.991464547107979, 3: 7.814727903251179, 5: 11.070497693516351,
                 10: 18.307038053275146, 30: 43.77297182574219, 100: 124.34211340400407, 1000: 1074.679449076428}


def test_tabulated_points(spark):
    df = spark.createDataFrame([(x, d) for d, x in FIVE_PER_CENT.items()], "x double, d bigint")
    for row in df.select("d", chi_square_p_value(F.col("x"), F.col("d")).alias("p")).collect():
        assert row.p == pytest.approx(0.05, abs=1e-9), row.d


def test_closed_forms(spark):
    """Even degrees end after finitely many terms; one degree is the normal tail."""
    cases = [(float(x), d) for d in (1, 2, 4, 20, 60) for x in (1e-6, 0.5, 3, 19, 21, 60, 61, 62, 140, 3000)]
    got = spark.createDataFrame(cases, "x double, d bigint").select("x", "d", chi_square_p_value(F.col("x"), F.col("d")).alias("p")).collect()
    for x, d, p in got:
        h = x / 2
        want = erfc(sqrt(h)) if d == 1 else exp(-h) * sum(h ** k / factorial(k) for k in range(d // 2))
        assert p == pytest.approx(want, abs=1e-9), (x, d)


def test_edges(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 1.0), (1.0, -1.0), (-1.0, 1.0), (1.0, None), (None, 1.0)], "a double, x double")
    assert [r.p for r in df.select(upper_gamma(F.col("a"), F.col("x")).alias("p")).collect()] == [1.0, None, None, None, None, None]
    values = [0.5, 1.0, 2.5, 30.0, 5000.0]
    got = spark.createDataFrame([(v,) for v in values], "a double").select(log_gamma(F.col("a")).alias("g")).collect()
    assert [r.g for r in got] == pytest.approx([lgamma(v) for v in values], abs=1e-9)


def test_cells(spark):
    frame = lambda rows: spark.createDataFrame([(c,) for c, n in rows for _ in range(n)], "c string")
    ref = frame([("x", 50), ("y", 40), ("u", 4), ("v", 6), (None, 9)])
    one = lambda cur: drift.chi_square_test(ref, cur, ["c"]).first()
    got = one(frame([("x", 30), ("y", 15), ("v", 2), ("new", 3)]))
    # Expected 25, 20 and, of u, v and the new one together, 5.
    assert (got.n_pooled, got.degrees, got.n_ref, got.n_cur) == (3, 2, 100, 50)
    assert got.chi_square == pytest.approx(25 / 25 + 25 / 20) and got.p_value == pytest.approx(exp(-2.25 / 2))
    assert not got.drifted
    same = one(frame([("x", 50), ("y", 40), ("u", 4), ("v", 6)]))
    assert same.chi_square == 0 and same.p_value == 1.0
    few = drift.chi_square_test(frame([("x", 50), ("y", 50)]), frame([("x", 20), ("y", 20), ("new", 1)]), ["c"]).first()
    assert few.p_value == 0 and few.chi_square is None and few.drifted
    none = one(frame([(None, 3)]))
    assert none.p_value is None
    single = drift.chi_square_test(frame([("x", 9)]), frame([("x", 20)]), ["c"]).first()
    assert single.degrees == 0 and single.p_value is None
    assert drift.chi_square_test(ref.limit(0), ref.limit(0), ["c"]).count() == 0
