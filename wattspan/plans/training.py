"""Split table to trained, scored and gated model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import qcols
from wattspan.operators import evaluate, models, quality
from wattspan.operators.small import checkpointed


@dataclass
class TrainingSpec:
    features: list[str]
    target: str
    kind: str = "gbt"
    split: str = "split"
    shares: dict[str, float] = field(default_factory=lambda: {"train": 0.70, "val": 0.15, "test": 0.15})
    key_cols: list[str] | None = None
    params: dict = field(default_factory=dict)
    max_rmse: float = float("inf")
    min_r2: float = 0.0
    seed: int = 42


def training_job(df: DataFrame, spec: TrainingSpec, path: str | None = None) -> tuple[Model, DataFrame, DataFrame]:
    """Data gate, training, test metrics with the threshold checks; saves the model if asked."""
    needed = [spec.split, spec.target, *spec.features, *(spec.key_cols or [])]
    # Written once: the gate, the fit and the test scores each read the split rows.
    data = checkpointed(df.select(*qcols(dict.fromkeys(needed))))
    gate = quality.data_gate(data, spec.split, spec.target, spec.shares, spec.key_cols)
    part = lambda name: data.filter(F.col(spec.split) == name)
    model = models.train(part("train"), spec.kind, spec.features, spec.target, spec.seed, **spec.params)
    scores = evaluate.metrics(models.score(model, part("test")), spec.target, "prediction")
    if path:
        model.write().overwrite().save(path)
    return model, gate, evaluate.gate(scores, spec.max_rmse, spec.min_r2)
