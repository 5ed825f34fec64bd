"""Dirty text readings to a clean typed table, as one lazy plan per stage."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from wattspan.operators import clean, dedup, impute, outliers, quality
from wattspan.operators.small import checkpointed


@dataclass
class CleaningSpec:
    schema: dict[str, str]
    critical: str
    order_by: list[str]
    drop: list[str] = field(default_factory=list)
    interpolated: list[str] = field(default_factory=list)
    carried: list[str] = field(default_factory=list)
    categories: list[str] = field(default_factory=list)
    ranges: dict[str, dict] = field(default_factory=dict)
    absolute: list[str] = field(default_factory=list)
    capped: list[str] = field(default_factory=list)
    subset: list[str] | None = None
    max_nulls: int = 3


def clean_readings(raw: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Cast, fill, tidy categories, clamp, cap percentiles, drop duplicates.

    The filled rows are checkpointed: modes and percentiles read them several
    times, and the fill has two shuffles behind it.
    """
    typed = clean.cast_schema(raw, spec.schema, spec.drop)
    filled = impute.staged_fill(
        typed, spec.critical, spec.interpolated, spec.carried, spec.order_by, max_nulls=spec.max_nulls
    )
    tidy = clean.clean_categories(checkpointed(filled), spec.categories)
    bounded = clean.clamp(tidy, spec.ranges, spec.absolute)
    capped = outliers.treat_outliers(bounded, spec.capped)
    return dedup.keep_one(capped, spec.subset, spec.order_by)


def validate(cleaned: DataFrame, reference: DataFrame, tolerance: int = 120) -> DataFrame:
    return quality.cleaned_report(cleaned, reference, tolerance)
