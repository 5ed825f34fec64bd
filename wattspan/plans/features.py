"""Clean readings to featured, split and preprocessed tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from wattspan.operators import prep, quality, split, stats, temporal
from wattspan.operators.corr import correlations
from wattspan.operators.small import checkpointed


def feature_job(cleaned: DataFrame, nsm: str, day: str, target: str) -> dict[str, DataFrame]:
    """Temporal features with their validation, statistics and target correlations."""
    featured = temporal.add_temporal_features(cleaned, nsm, day)
    return {
        "featured": featured,
        "validation": quality.temporal_report(featured),
        "statistics": stats.feature_statistics(featured, quality.TEMPORAL_FEATURES),
        "correlations": correlations(featured, target, [c for c in quality.TEMPORAL_FEATURES if c != "is_weekend"]),
    }


@dataclass
class PreprocessSpec:
    target: str
    id_col: str
    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    binary: dict[str, dict[str, int]] = field(default_factory=dict)
    seed: int = 42


def preprocess_job(featured: DataFrame, spec: PreprocessSpec) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Stratified split, its report, and all rows transformed by stages fitted on the training rows."""
    labelled = checkpointed(split.stratified_split(featured, spec.target, spec.id_col, seed=spec.seed))
    shares = {"train": 0.70, "val": 0.15, "test": 0.15}
    report = quality.split_report(labelled, "split", spec.target, shares, key_cols=[spec.id_col])
    keep = [spec.id_col, spec.target, "split"]
    stages = prep.preprocessing(spec.numeric, spec.categorical, spec.binary, keep=keep)
    model = stages.fit(labelled.filter(F.col("split") == "train"))
    return model.transform(labelled), report, model
