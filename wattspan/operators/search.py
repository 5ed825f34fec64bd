"""Search over hyper-parameters: a density sampler that learns from past trials, and median stopping.

Each parameter is sampled by itself. Past trials are parted into the best tenth and
the rest; both are smoothed to a density over the parameter's range, values are
drawn from the first, and the one with the highest ratio of the two is tried next.
A trial whose model after a share of its rounds is worse than the median of earlier
trials at that point stops there. Trials run in rounds, side by side; what a round
draws and stops depends on earlier rounds only, so results are repeatable.

Only trial tables live on the driver; every fit and score is a Spark job.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from statistics import NormalDist, median
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.sql import DataFrame

from wattspan.functions.columns import qcols
from wattspan.operators import evaluate, models

# Share and largest number of the trials that count as good.
GOOD_SHARE, MOST_GOOD = 0.1, 25

SPACES = {
    "gbt": models.SEARCH_SPACE,
    "forest": {"numTrees": (5, 60), "maxDepth": (3, 10), "subsamplingRate": (0.6, 1.0), "minInstancesPerNode": (1, 10)},
    "linear": {"regParam": (0.0, 1.0), "elasticNetParam": (0.0, 1.0)},
}
# The parameter that counts a model's rounds.
ROUNDS = {"gbt": "maxIter", "forest": "numTrees"}


class Trial(NamedTuple):
    trial: int
    params: dict
    state: str
    stages: tuple[float, ...]
    rmse: float
    mae: float
    r2: float


class Density:
    """A mixture of normals cut to [0, 1]: one around each value, as wide as the gap to its neighbours, and a wide one."""

    def __init__(self, values: list[float]):
        points = sorted([*values, 0.5])
        ends = [0.0, *points, 1.0]
        narrow = 1 / min(100, len(points) + 1)
        self.parts = []
        for i, m in enumerate(points):
            width = max(ends[i + 1] - ends[i], ends[i + 2] - ends[i + 1])
            self.parts.append(NormalDist(m, min(max(width, narrow), 1.0)))
        self.parts[points.index(0.5)] = NormalDist(0.5, 1.0)
        self.mass = [p.cdf(1) - p.cdf(0) for p in self.parts]

    def draw(self, rng: random.Random) -> float:
        part = rng.choice(self.parts)
        low, high = part.cdf(0), part.cdf(1)
        at = min(max(low + (high - low) * rng.random(), 1e-12), 1 - 1e-12)
        return min(max(part.inv_cdf(at), 0.0), 1.0)

    def log(self, x: float) -> float:
        return math.log(sum(p.pdf(x) / m for p, m in zip(self.parts, self.mass)) / len(self.parts))


class Sampler:
    """Draws parameters: at random for the first ``startup`` trials, then by the ratio of the densities."""

    def __init__(self, space: dict, seed: int, startup: int = 8, candidates: int = 24):
        self.space, self.rng, self.startup, self.candidates = space, random.Random(seed), startup, candidates

    def _value(self, name: str, unit: float):
        lo, hi = self.space[name]
        if isinstance(lo, int) and isinstance(hi, int):
            # Every whole number has an equal share of the range.
            return min(lo + int(unit * (hi - lo + 1)), hi)
        return round(lo + unit * (hi - lo), 4)

    def _unit(self, name: str, value) -> float:
        lo, hi = self.space[name]
        if isinstance(lo, int) and isinstance(hi, int):
            return (value - lo + 0.5) / (hi - lo + 1)
        return (value - lo) / (hi - lo) if hi > lo else 0.5

    def draw(self, done: list[tuple[dict, float]]) -> dict:
        """The next parameters, after trials of (parameters, error)."""
        if len(done) < self.startup:
            return {n: self._value(n, self.rng.random()) for n in self.space}
        ranked = sorted(done, key=lambda t: t[1])
        good = min(math.ceil(GOOD_SHARE * len(done)), MOST_GOOD)
        out = {}
        for name in self.space:
            best, rest = (Density([self._unit(name, p[name]) for p, _ in part]) for part in (ranked[:good], ranked[good:]))
            tried = [best.draw(self.rng) for _ in range(self.candidates)]
            out[name] = self._value(name, max(tried, key=lambda x: best.log(x) - rest.log(x)))
        return out


def run_trials(evaluate_trial: Callable[[dict, float], tuple[float, float, float]], sampler: Sampler, trials: int,
               parallel: int = 4, stops: tuple[float, ...] = (), patience: int = 5) -> list[Trial]:
    """Trials in rounds of ``parallel``. ``evaluate_trial(params, share)`` gives (rmse, mae, r2) after a share of the rounds.

    A trial stops at a share in ``stops`` where it is worse than the median of earlier trials there, once ``patience``
    trials are complete. Stopped trials keep their last scores, and count as such for the sampler.
    """
    done: list[Trial] = []

    def one(job: tuple[int, dict, list[Trial]]) -> Trial:
        number, params, before = job
        complete = [t for t in before if t.state == "complete"]
        seen: list[float] = []
        for i, share in enumerate(stops):
            scores = evaluate_trial(params, share)
            seen.append(scores[0])
            if len(complete) >= patience and scores[0] > median(t.stages[i] for t in complete):
                return Trial(number, params, "pruned", tuple(seen), *scores)
        return Trial(number, params, "complete", tuple(seen), *evaluate_trial(params, 1.0))

    with ThreadPoolExecutor(parallel) as pool:
        while len(done) < trials:
            past = [(t.params, t.rmse) for t in done]
            jobs = [(len(done) + i, sampler.draw(past), list(done)) for i in range(min(parallel, trials - len(done)))]
            done += pool.map(one, jobs)
    return done


def density_search(training: DataFrame, validation: DataFrame, kind: str, features: list[str], label: str, trials: int = 20,
                   seed: int = 42, space: dict | None = None, parallel: int = 4, stops: tuple[float, ...] = (0.3,),
                   startup: int = 8, fixed: dict | None = None) -> tuple[DataFrame, dict, Model]:
    """Trial table, best parameters, and the model refit on both parts. Any estimator of ``models.ESTIMATORS``.

    Kinds without rounds (linear), or with their number among the ``fixed`` parameters, are not stopped early. Equal
    errors go to the earlier trial.
    """
    cols = [*features, label]
    fit_on, check_on = (models.held(d.select(*qcols(cols))) for d in (training, validation))
    rounds, fixed = ROUNDS.get(kind), dict(fixed or {})
    space = SPACES[kind] if space is None else space

    def scored(params: dict, share: float) -> tuple[float, float, float]:
        params = {**params, **fixed}
        if share < 1:
            params[rounds] = max(1, round(params[rounds] * share))
        model = models.fit_held(fit_on, kind, features, label, seed, **params)
        m = evaluate.metrics(models.score(model, check_on), label, "prediction").first()
        return m["rmse"], m["mae"], m["r2"]

    try:
        done = run_trials(scored, Sampler(space, seed, startup), trials, parallel, stops if rounds in space else ())
        best = min((t for t in done if t.state == "complete"), key=lambda t: (t.rmse, t.trial)).params
        final = models.fit_held(fit_on.unionByName(check_on), kind, features, label, seed, **{**best, **fixed})
    finally:
        fit_on.unpersist(), check_on.unpersist()
    rows = [(t.trial, {p: float(v) for p, v in t.params.items()}, t.state, t.rmse, t.mae, t.r2) for t in done]
    table = training.sparkSession.createDataFrame(
        rows, "trial int, params map<string,double>, state string, rmse double, mae double, r2 double")
    return table, best, final
