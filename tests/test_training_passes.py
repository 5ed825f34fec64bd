"""How often the training operators read their input, what they keep of it, and how it is dealt out."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.operators import models, search, split
from wattspan.plans.training import TrainingSpec, training_job

ROWS = 400


@pytest.fixture
def counted(spark):
    """A table that counts how often its rows are made."""
    seen = spark.sparkContext.accumulator(0)

    def tick(v):
        seen.add(1)
        return float(v % 17)

    made = F.udf(tick, "double").asNondeterministic()
    df = spark.range(ROWS).withColumn("x", made("id")).withColumn("z", (F.col("id") % 5).cast("double"))
    return df.withColumn("y", F.col("x") * 2 + F.col("z")), seen


def test_ranks_in_two_passes(counted):
    df, seen = counted
    got = {r["id"]: r["rank"] for r in split.hash_rank(df, "id", 7).filter("x >= 0").collect()}
    order = sorted(range(ROWS), key=lambda i: hashlib.md5(f"7|{i}".encode()).hexdigest())
    assert got == {i: k for k, i in enumerate(order)}
    assert seen.value <= 2 * ROWS


@pytest.mark.parametrize("rows", [0, 1, 3])
def test_ranks_of_few_rows(spark, rows):
    assert sorted(r["rank"] for r in split.hash_rank(spark.range(rows), "id", 7).collect()) == list(range(rows))


def test_longer_prefixes_than_counted(spark, monkeypatch):
    monkeypatch.setattr(split, "PREFIX_ROWS", 1 / 100)
    monkeypatch.setattr(split, "FINE_PREFIX", 2)
    order = sorted(range(ROWS), key=lambda i: hashlib.md5(f"7|{i}".encode()).hexdigest())
    assert {r["id"]: r["rank"] for r in split.hash_rank(spark.range(ROWS), "id", 7).collect()} == {i: k for k, i in enumerate(order)}


def test_folds_are_kept_without_the_id(counted):
    folded = models._folded(counted[0], ["x", "z"], "y", "id", 3, 42)
    assert folded.columns == ["x", "z", "y", "fold"] and folded.is_cached
    folded.unpersist()


def test_partitions_of_a_fit_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 30)
    df = spark.range(0, ROWS, 1, 2)
    kept = models.held(df)
    sizes = [r["n"] for r in kept.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == ROWS and max(sizes) <= 60
    kept.unpersist()
    assert models.held(df.filter("id < 0")).count() == 0


def test_searches_make_their_rows_once(counted):
    df, seen = counted
    train, val = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    trials, best, _ = models.random_search(train, val, ["x", "z"], "y", 2, space={"maxIter": (1, 2), "maxDepth": (1, 2)})
    assert trials.count() == 2 and set(best) == {"maxIter", "maxDepth"}
    # The filters of both parts come after the counting column.
    assert seen.value <= 2 * ROWS
    search.density_search(train, val, "gbt", ["x", "z"], "y", 2, space={"maxDepth": (1, 2)}, fixed={"maxIter": 1}, startup=2)
    assert seen.value <= 4 * ROWS


def test_training_job_makes_its_rows_once(counted):
    df, seen = counted
    data = df.withColumn("split", F.when(F.col("id") % 20 < 14, "train").when(F.col("id") % 20 < 17, "val").otherwise("test"))
    spec = TrainingSpec(["x", "z"], "y", params={"maxIter": 1, "maxDepth": 2}, key_cols=["id"])
    _, gate, scores = training_job(data, spec)
    assert gate.first()["total_nulls"] == 0 and scores.first()["n"] == ROWS * 3 // 20
    assert seen.value <= ROWS


def test_importance_of_shuffled_features(counted):
    df, seen = counted
    model = models.train(df, "linear", ["x", "z"], "y", solver="normal")
    before = seen.value
    got = {r["feature"]: r["importance"] for r in models.permutation_importance(model, df, ["x", "z"], "y", "id").collect()}
    assert seen.value - before <= 2 * ROWS
    by = lambda seed: sorted(range(ROWS), key=lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest())
    pairs = list(zip(by(42), by(43)))
    rise = lambda f, w: np.sqrt(np.mean([(w * (f(a) - f(b))) ** 2 for a, b in pairs]))
    assert got == pytest.approx({"x": rise(lambda i: i % 17, 2), "z": rise(lambda i: i % 5, 1)}, abs=1e-6)
