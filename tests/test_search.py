"""The density sampler, median stopping, and a search over real models."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from wattspan.operators import models, search

SPACE = {"depth": (1, 6), "rate": (0.0, 1.0)}


def error(params, share=1.0):
    e = (params["depth"] - 4) ** 2 + 10 * (params["rate"] - 0.3) ** 2 + (1 - share)
    return e, e, -e


def test_densities_are_densities():
    d = search.Density([0.1, 0.12, 0.9])
    step = 1e-4
    assert sum(2.718281828459045 ** d.log((i + 0.5) * step) * step for i in range(10_000)) == pytest.approx(1, abs=1e-3)
    rng = random.Random(1)
    assert all(0 <= d.draw(rng) <= 1 for _ in range(500))


def test_sampler_beats_chance_and_repeats():
    best = lambda startup, seed: min(t.rmse for t in search.run_trials(error, search.Sampler(SPACE, seed, startup), 40))
    learned, chance = ([best(s, seed) for seed in range(12)] for s in (8, 40))
    assert sum(learned) < sum(chance)
    one, two = (search.run_trials(error, search.Sampler(SPACE, 7), 20, parallel=4, stops=(0.5,)) for _ in range(2))
    assert one == two and len({t.trial for t in one}) == 20


def test_same_best_as_trying_all():
    grid = {"depth": (1, 6), "leaf": (1, 4)}
    e = lambda p, share=1.0: (abs(p["depth"] - 5) + abs(p["leaf"] - 2) + 0.0,) * 3
    done = search.run_trials(e, search.Sampler(grid, 3), 60)
    want = min((e({"depth": d, "leaf": f})[0], d, f) for d, f in product(range(1, 7), range(1, 5)))
    best = min(done, key=lambda t: t.rmse)
    assert (best.rmse, best.params["depth"], best.params["leaf"]) == want


def test_median_stopping():
    calls = []

    def e(params, share=1.0):
        calls.append(share)
        return error(params, share)

    done = search.run_trials(e, search.Sampler(SPACE, 5), 30, parallel=3, stops=(0.5,), patience=5)
    stopped = [t for t in done if t.state == "pruned"]
    assert stopped and calls.count(1.0) == 30 - len(stopped) and calls.count(0.5) == 30
    complete = [t for t in done if t.state == "complete"]
    assert min(t.rmse for t in complete) <= min(t.stages[0] for t in stopped)


def test_search_over_models(spark):
    df = spark.range(400).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z"))
    df = df.withColumn("y", F.col("x") * 3 + F.col("z"))
    table, best, model = search.density_search(df, df, "linear", ["x", "z"], "y", 4, startup=2, parallel=2)
    rows = table.orderBy("trial").collect()
    assert [r["trial"] for r in rows] == [0, 1, 2, 3] and {r["state"] for r in rows} == {"complete"}
    assert set(best) == set(search.SPACES["linear"]) and models.score(model, df).count() == 400
    low = min(rows, key=lambda r: (r["rmse"], r["trial"]))
    assert low["params"] == {k: float(v) for k, v in best.items()}
