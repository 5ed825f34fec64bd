"""Training, search, stacking and importance with Spark ML."""

from __future__ import annotations

import math
import random

from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F, types as T

from wattspan.functions.columns import qcol, qcols, require
from wattspan.functions.hashing import seeded_md5
from wattspan.functions.metrics import metric_columns
from wattspan.operators import evaluate
from wattspan.operators.small import checkpointed
from wattspan.operators.split import digest_rank, kfold

# A task of a fit holds about 300 bytes of each of its rows.
TASK_ROWS = 500_000

ESTIMATORS = {"gbt": GBTRegressor, "forest": RandomForestRegressor, "linear": LinearRegression}

# Ranges of the hyper-parameter search, by Spark parameter name.
SEARCH_SPACE = {
    "maxIter": (5, 40),
    "maxDepth": (3, 8),
    "stepSize": (0.01, 0.3),
    "subsamplingRate": (0.6, 1.0),
    "minInstancesPerNode": (1, 10),
}


def estimator(kind: str, features: list[str], label: str, seed: int = 42, **params) -> Pipeline:
    if kind not in ESTIMATORS:
        raise ValueError(f"kind must be one of {sorted(ESTIMATORS)}, got {kind}")
    if kind != "linear":
        params.setdefault("seed", seed)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[assembler, ESTIMATORS[kind](featuresCol="features", labelCol=label, **params)])


def held(df: DataFrame) -> DataFrame:
    """The rows persisted, in partitions of at most about ``TASK_ROWS`` rows."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    per = kept.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    parts, rows, most = per.agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    if not rows or most <= TASK_ROWS:
        return kept
    dealt = kept.repartition(max(parts, math.ceil(rows / TASK_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)
    # The first frame is let go once the second one has its rows.
    dealt.count()
    kept.unpersist()
    return dealt


def train(df: DataFrame, kind: str, features: list[str], label: str, seed: int = 42, **params) -> Model:
    """Fits on the feature and label columns only, kept across the passes of the fit."""
    require(df, [*features, label])
    data = df.select(*qcols(dict.fromkeys([*features, label])))
    if df.storageLevel.useMemory:
        return fit_held(data, kind, features, label, seed, **params)
    kept = held(data)
    try:
        return fit_held(kept, kind, features, label, seed, **params)
    finally:
        kept.unpersist()


def fit_held(df: DataFrame, kind: str, features: list[str], label: str, seed: int = 42, **params) -> Model:
    """Fits on rows of a frame that is persisted already, without a copy of them."""
    return estimator(kind, features, label, seed, **params).fit(df)


def score(model: Model, df: DataFrame, name: str = "prediction") -> DataFrame:
    """Adds the prediction column."""
    out = model.transform(df)
    if name != "prediction":
        out = out.withColumnRenamed("prediction", name)
    return out.drop("features")


def _needed(df: DataFrame, id_col: str, features: list[str], label: str, extra: list[str] = ()) -> DataFrame:
    return df.select(*qcols(dict.fromkeys([id_col, *features, label, *extra])))


def _folded(df: DataFrame, features: list[str], label: str, id_col: str, k: int, seed: int) -> DataFrame:
    """Features, label and fold, persisted. The id, often the widest column, only orders the rows."""
    folded = kfold(_needed(df, id_col, features, label), id_col, k, seed)
    return held(folded.select(*qcols(dict.fromkeys([*features, label, "fold"]))))


def cross_validate(df: DataFrame, kind: str, features: list[str], label: str, id_col: str, k: int = 5,
                   seed: int = 42, **params) -> tuple[DataFrame, DataFrame, Model]:
    """Per-fold metrics, their mean and population deviation, and the model refit on all rows."""
    folded = _folded(df, features, label, id_col, k, seed)
    parts = []
    for i in range(k):
        model = fit_held(folded.filter(F.col("fold") != i), kind, features, label, seed, **params)
        left_out = score(model, folded.filter(F.col("fold") == i))
        parts.append(left_out.select("fold", qcol(label).alias("y"), "prediction"))
    held_out = parts[0]
    for p in parts[1:]:
        held_out = held_out.unionByName(p)
    folds = checkpointed(held_out.groupBy("fold").agg(*metric_columns(F.col("y"), F.col("prediction"))))
    summary = folds.agg(
        *[f(c).alias(f"{c}_{n}") for c in ("rmse", "mae", "r2") for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    )
    final = fit_held(folded, kind, features, label, seed, **params)
    folded.unpersist()
    return folds, summary, final


def _draw(rng: random.Random, space: dict) -> dict:
    return {
        n: rng.randint(lo, hi) if isinstance(lo, int) and isinstance(hi, int) else round(rng.uniform(lo, hi), 4)
        for n, (lo, hi) in space.items()
    }


def random_search(training: DataFrame, validation: DataFrame, features: list[str], label: str, trials: int = 10,
                  seed: int = 42, space: dict | None = None) -> tuple[DataFrame, dict, Model]:
    """Seeded random trials scored on the validation split: trial table, best parameters, refit model."""
    rng = random.Random(seed)
    cols = [*features, label]
    fit_on, check_on = held(training.select(*qcols(cols))), held(validation.select(*qcols(cols)))
    rows, best = [], None
    for trial in range(trials):
        params = _draw(rng, space or SEARCH_SPACE)
        model = fit_held(fit_on, "gbt", features, label, seed, **params)
        m = evaluate.metrics(score(model, check_on), label, "prediction").first()
        rows.append((trial, {p: float(v) for p, v in params.items()}, m["rmse"], m["mae"], m["r2"]))
        if best is None or m["rmse"] < best[0]:
            best = (m["rmse"], params)
    table = training.sparkSession.createDataFrame(
        rows, "trial int, params map<string,double>, rmse double, mae double, r2 double")
    final = fit_held(fit_on.unionByName(check_on), "gbt", features, label, seed, **best[1])
    fit_on.unpersist()
    check_on.unpersist()
    return table, best[1], final


class Stack:
    """Base models and the model over their predictions."""

    def __init__(self, bases: dict[str, Model], meta: Model, label: str):
        self.bases, self.meta, self.label = bases, meta, label

    def base_scores(self, df: DataFrame) -> DataFrame:
        for name, model in self.bases.items():
            df = score(model, df, f"base_{name}")
        return df

    def predict(self, df: DataFrame) -> DataFrame:
        return score(self.meta, self.base_scores(df))

    def contributions(self) -> dict[str, float]:
        return dict(zip(self.bases, self.meta.stages[-1].coefficients.toArray().tolist()))

    def long_predictions(self, df: DataFrame, id_col: str, name: str = "ensemble") -> DataFrame:
        """(id, model, y, prediction) of every base and the ensemble."""
        scored = self.predict(df)
        entries = [F.struct(F.lit(b).alias("model"), F.col(f"base_{b}").alias("prediction")) for b in self.bases]
        entries.append(F.struct(F.lit(name).alias("model"), F.col("prediction")))
        return scored.select(qcol(id_col), qcol(self.label).alias("y"), F.inline(F.array(*entries)))


def stack(df: DataFrame, bases: dict[str, tuple[str, dict]], features: list[str], label: str, id_col: str,
          k: int = 5, seed: int = 42, penalty: float = 1.0) -> Stack:
    """Ridge over out-of-fold base predictions; the bases are then refit on all rows.

    Every row is predicted by models that did not see it: fold by fold the base
    columns are added to the held-out rows, so no join is needed.
    """
    folded = _folded(df, features, label, id_col, k, seed)
    parts = []
    for i in range(k):
        seen, left_out = folded.filter(F.col("fold") != i), folded.filter(F.col("fold") == i)
        for name, (kind, params) in bases.items():
            left_out = score(fit_held(seen, kind, features, label, seed, **params), left_out, f"base_{name}")
        parts.append(left_out)
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    columns = [f"base_{name}" for name in bases]
    meta = train(oof.select(*qcols([*columns, label])), "linear", columns, label, seed, regParam=penalty,
                 elasticNetParam=0.0)
    fitted = {name: fit_held(folded, kind, features, label, seed, **params) for name, (kind, params) in bases.items()}
    folded.unpersist()
    return Stack(fitted, meta, label)


def permutation_importance(model: Model, df: DataFrame, features: list[str], label: str, id_col: str,
                           seed: int = 42) -> DataFrame:
    """Rise of RMSE when one feature is shuffled, per feature, with the model's own importance.

    The shuffle pairs row ranks of two md5 orders: a distributed equi-join.
    """
    kept = _needed(df, id_col, features, label)
    # Both digests are made at once, and the second ranks start from the first ones' checkpoint.
    hashed = kept.withColumn("_d0", seeded_md5(qcol(id_col), seed)).withColumn("_d1", seeded_md5(qcol(id_col), seed + 1))
    names = list(dict.fromkeys([*features, label]))
    receive = checkpointed(digest_rank(hashed.select("_d0", "_d1", *qcols(names)), "_d0", "_rank"))
    give = digest_rank(receive.select("_d1", *[qcol(c).alias(f"_p_{c}") for c in features]), "_d1", "_rank")
    joined = receive.drop("_d1").join(give, "_rank")
    # Every row once as it is, and once per feature with that feature shuffled.
    swapped = lambda c: [qcol(f"_p_{x}" if x == c else x).alias(x) for x in features]
    forms = [F.struct(F.lit(c).alias("_m"), *swapped(c), *qcols([n for n in names if n not in features])) for c in ["", *features]]
    long = joined.select(F.inline(F.array(*forms)))
    per = score(model, long).groupBy("_m").agg(*metric_columns(qcol(label), F.col("prediction")))
    per = checkpointed(per.select("_m", "rmse"))
    base = per.filter("_m = ''").agg(F.max("rmse")).scalar()
    native = getattr(model.stages[-1], "featureImportances", None)
    own = dict(zip(features, native.toArray().tolist())) if native is not None else {}
    out = per.filter("_m <> ''").select(F.col("_m").alias("feature"), (F.col("rmse") - base).alias("importance"))
    pairs = [x for c in features for x in (F.lit(c), F.lit(own.get(c)).cast(T.DoubleType()))]
    out = out.withColumn("native_importance", F.create_map(*pairs)[F.col("feature")])
    return out.orderBy(F.desc("importance"), "feature")


