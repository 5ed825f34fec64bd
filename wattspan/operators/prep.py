"""Scaling and encoding as Spark ML stages that save and load with a pipeline."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import map_lookup, qcol, qcols, require, rows_of, set_columns
from wattspan.operators.order import with_position
from wattspan.operators.small import join_small


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    pass


class _HasColumns(Params):
    columns = Param(Params._dummy(), "columns", "columns to work on", typeConverter=TypeConverters.toListString)
    exclude = Param(Params._dummy(), "exclude", "columns to leave alone", typeConverter=TypeConverters.toListString)

    def used(self) -> list[str]:
        skip = set(self.getOrDefault("exclude"))
        return [c for c in self.getOrDefault("columns") if c not in skip]


class NumericScalerModel(Model, _HasColumns, _Saved):
    """(x - mean) / scale with the stored training statistics."""

    statistics = Param(Params._dummy(), "statistics", "mean and scale per column, JSON",
                       typeConverter=TypeConverters.toString)

    def __init__(self, columns=None, statistics=None):
        super().__init__()
        self._setDefault(columns=[], exclude=[], statistics="{}")
        if columns is not None:
            self._set(columns=columns, statistics=json.dumps(statistics))

    def stats(self) -> dict[str, dict[str, float]]:
        return json.loads(self.getOrDefault("statistics"))

    def scaled(self, c: str) -> Column:
        s = self.stats()[c]
        return (qcol(c).cast("double") - F.lit(s["mean"])) / F.lit(s["scale"])

    def unscaled(self, scaled: Column, c: str) -> Column:
        """Back to the units of column ``c``; for targets and predictions."""
        s = self.stats()[c]
        return scaled * F.lit(s["scale"]) + F.lit(s["mean"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return set_columns(df, {c: self.scaled(c) for c in self.used()})


class NumericScaler(Estimator, _HasColumns, _Saved):
    """Standard scaling by population deviation; a constant column keeps scale 1."""

    @keyword_only
    def __init__(self, columns=None, exclude=None):
        super().__init__()
        self._setDefault(columns=[], exclude=[])
        self._set(columns=columns or [], exclude=exclude or [])

    def _fit(self, df: DataFrame) -> NumericScalerModel:
        cols = self.used()
        require(df, cols)
        # Two numbers per column reach the driver.
        row = df.agg(
            *[F.avg(qcol(c)).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(qcol(c)).alias(f"s{i}") for i, c in enumerate(cols)],
        ).first()
        stats = {c: {"mean": row[f"m{i}"] or 0.0, "scale": row[f"s{i}"] or 1.0} for i, c in enumerate(cols)}
        return NumericScalerModel(cols, stats)


def encoded_name(feature: str, category: str, sep: str = "_") -> str:
    return f"{feature}{sep}{category.replace(' ', '_')}"


class CategoryEncoderModel(Model, _HasColumns, _Saved):
    """0/1 columns for every category but the first; unknown values give zeros."""

    categories = Param(Params._dummy(), "categories", "sorted categories per column, JSON",
                       typeConverter=TypeConverters.toString)

    def __init__(self, columns=None, categories=None):
        super().__init__()
        self._setDefault(columns=[], exclude=[], categories="{}")
        if columns is not None:
            self._set(columns=columns, categories=json.dumps(categories))

    def known(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault("categories"))

    def feature_names(self) -> list[str]:
        return [encoded_name(c, v) for c in self.used() for v in self.known()[c][1:]]

    def _transform(self, df: DataFrame) -> DataFrame:
        known = self.known()
        new = [
            qcol(c).eqNullSafe(F.lit(v)).cast("int").alias(encoded_name(c, v))
            for c in self.used() for v in known[c][1:]
        ]
        return df.select(*qcols(c for c in df.columns if c not in known), *new)


class CategoryEncoder(Estimator, _HasColumns, _Saved):
    """One-hot encoding that drops the first category in sorted order.

    Each category becomes a column, so a fit fails beyond ``maxCategories``;
    ``category_tables.TableEncoder`` is the stage without a limit.
    """

    maxCategories = Param(Params._dummy(), "maxCategories", "largest number of categories",
                          typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, columns=None, exclude=None, maxCategories=1000):
        super().__init__()
        self._setDefault(columns=[], exclude=[], maxCategories=1000)
        self._set(columns=columns or [], exclude=exclude or [], maxCategories=maxCategories)

    def _fit(self, df: DataFrame) -> CategoryEncoderModel:
        cols, limit = self.used(), self.getOrDefault("maxCategories")
        require(df, cols)
        if not cols:
            return CategoryEncoderModel([], {})
        long = df.select(*[qcol(c).cast("string").alias(c) for c in cols]).unpivot([], qcols(cols), "c", "v")
        pairs = long.filter(F.col("v").isNotNull()).distinct().limit(limit * len(cols) + 1).collect()
        found = {c: sorted(p["v"] for p in pairs if p["c"] == c) for c in cols}
        for c, values in found.items():
            if len(values) > limit:
                raise ValueError(f"column {c} has more than {limit} categories")
        if len(pairs) > limit * len(cols):
            raise ValueError(f"more than {limit} categories per column")
        return CategoryEncoderModel(cols, found)


def category_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column``, ``category`` and its 0-based ``index`` in sorted order, for any number of categories."""
    require(df, columns)
    long = df.select(*[qcol(c).cast("string").alias(c) for c in columns]).unpivot([], qcols(columns), "column", "category")
    distinct = long.filter("category IS NOT NULL").distinct()
    return with_position(distinct, ["category"], ["column"], "index").select("column", "category", "index")


def index_categories(df: DataFrame, table: DataFrame, columns: list[str], suffix: str = "_index") -> DataFrame:
    """Adds each column's category index by a join with the table; unknown and null values become null.

    The index feeds tree models as it is, and sparse one-hot vectors through ``pyspark.ml.feature.OneHotEncoder``.
    """
    out = df
    for c in columns:
        side = table.filter(F.col("column") == c).select(F.col("category").alias("_category"), F.col("index").alias(c + suffix))
        out = join_small(out.withColumn("_category", qcol(c).cast("string")), side, ["_category"], "left").drop("_category")
    return out


def map_binary(df: DataFrame, feature: str, mapping: dict[str, int]) -> DataFrame:
    """Explicit value map to int; unmatched values become null."""
    require(df, [feature])
    return set_columns(df, {feature: map_lookup(mapping, qcol(feature)).cast("int")})


class BinaryMapper(Transformer, _Saved):
    """:func:`map_binary` as a stage, for several features."""

    mappings = Param(Params._dummy(), "mappings", "value map per feature, JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, mappings="{}"):
        super().__init__()
        self._setDefault(mappings="{}")
        self._set(mappings=mappings)

    def _transform(self, df: DataFrame) -> DataFrame:
        for feature, mapping in json.loads(self.getOrDefault("mappings")).items():
            df = map_binary(df, feature, mapping)
        return df


def ordinal(df: DataFrame, column: str, order: list[str], name: str | None = None) -> DataFrame:
    """Index of the value in ``order``; unknown values become null."""
    at = map_lookup({v: i for i, v in enumerate(order)}, qcol(column))
    return df.withColumn(name or column, at)


def sorted_order(df: DataFrame, column: str, limit: int = 1000) -> list[str]:
    """Sorted distinct values of a low-cardinality column, for :func:`ordinal`."""
    values = df.select(qcol(column).alias("v")).na.drop().distinct().limit(limit + 1).collect()
    if len(values) > limit:
        raise ValueError(f"column {column} has more than {limit} values")
    return sorted(v["v"] for v in values)


class FeatureSelector(Transformer, _HasColumns, _Saved):
    """Keeps the named columns; a missing one is an error."""

    @keyword_only
    def __init__(self, columns=None, exclude=None):
        super().__init__()
        self._setDefault(columns=[], exclude=[])
        self._set(columns=columns or [], exclude=exclude or [])

    def _transform(self, df: DataFrame) -> DataFrame:
        require(df, self.used())
        return df.select(*qcols(self.used()))


def preprocessing(numeric: list[str], categorical: list[str], binary: dict[str, dict[str, int]] | None = None,
                  keep: list[str] = (), passthrough: bool = False, unscaled: list[str] = (),
                  encoder: type[Estimator] = CategoryEncoder) -> Pipeline:
    """Select, scale, map binaries, one-hot. ``passthrough`` keeps all other columns.

    ``encoder`` is the stage for categories; ``category_tables.TableEncoder`` has no limit on them.
    """
    binary = binary or {}
    overlap = set(numeric) & set(categorical)
    if overlap or not (numeric or categorical or binary):
        raise ValueError(f"each column needs one role; in two: {sorted(overlap)}")
    stages: list = []
    if not passthrough:
        stages.append(FeatureSelector(columns=[*keep, *numeric, *categorical, *binary]))
    stages.append(NumericScaler(columns=list(numeric), exclude=list(unscaled)))
    if binary:
        stages.append(BinaryMapper(mappings=json.dumps(binary)))
    if categorical:
        stages.append(encoder(columns=list(categorical)))
    return Pipeline(stages=stages)


def scaler_summary(model: NumericScalerModel, df: DataFrame) -> DataFrame:
    """The stored statistics as rows."""
    one = df.sparkSession.range(1)
    return rows_of(
        one,
        [
            [("column", F.lit(c)), ("mean", F.lit(s["mean"])), ("scale", F.lit(s["scale"]))]
            for c, s in model.stats().items()
        ],
    )
