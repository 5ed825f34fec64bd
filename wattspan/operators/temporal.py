"""Temporal feature columns, as functions and as pipeline stages."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from wattspan.functions import temporal as t
from wattspan.functions.columns import qcol, require


def add_hour(df: DataFrame, nsm: str = "NSM", out: str = "hour", clamp: bool = True) -> DataFrame:
    require(df, [nsm])
    return df.withColumn(out, t.hour_of(qcol(nsm), clamp))


def nsm_range(df: DataFrame, nsm: str = "NSM") -> DataFrame:
    """One row: seconds outside [0, 86400] and nulls."""
    c = qcol(nsm)
    return df.agg(F.count_if((c < 0) | (c > 86400)).alias("out_of_range"), F.count_if(c.isNull()).alias("null_values"))


def add_day_of_week(df: DataFrame, day: str = "Day_of_week", out: str = "day_of_week") -> DataFrame:
    require(df, [day])
    return df.withColumn(out, t.day_number(qcol(day)))


def unknown_days(df: DataFrame, day: str = "Day_of_week") -> DataFrame:
    """One row: names outside the seven days; a null name counts as invalid."""
    return df.agg(F.count_if(t.day_number(qcol(day)).isNull()).alias("invalid_days"))


def add_is_weekend(df: DataFrame, day: str = "day_of_week", out: str = "is_weekend",
                   weekend: list[int] | None = None) -> DataFrame:
    c = qcol(day)
    return df.withColumn(out, c.isin(*weekend) if weekend else t.weekend_flag(c))


def add_cyclical(df: DataFrame, column: str, period: float, prefix: str | None = None) -> DataFrame:
    """Adds ``<prefix>_sin`` and ``<prefix>_cos``; the default prefix is ``cyclical_<column>``."""
    require(df, [column])
    sin, cos = t.cyclical(qcol(column), period)
    name = prefix or f"cyclical_{column}"
    return df.withColumns({f"{name}_sin": sin, f"{name}_cos": cos})


def add_temporal_features(df: DataFrame, nsm: str = "NSM", day: str = "Day_of_week", hour: bool = True,
                          day_of_week: bool = True, weekend: bool = True, cyclical: bool = True) -> DataFrame:
    """Hour, day number, weekend flag and the two cyclical pairs."""
    require(df, [nsm, day])
    h, d = t.hour_of(qcol(nsm)), t.day_number(qcol(day))
    new = {}
    if hour:
        new["hour"] = h
    if weekend:
        new["is_weekend"] = t.weekend_flag(d)
    if cyclical:
        new["cyclical_hour_sin"], new["cyclical_hour_cos"] = t.cyclical(h, 24)
        new["cyclical_day_sin"], new["cyclical_day_cos"] = t.cyclical(d, 7)
    out = df.withColumns(new)
    if not day_of_week:
        return out
    if day.lower() == "day_of_week":
        # Spark resolves names without case, so the text column moves to day_name.
        out = out.withColumnRenamed(day, "day_name")
        d = t.day_number(F.col("day_name"))
    return out.withColumn("day_of_week", d)


def add_day_parts(df: DataFrame, nsm: str = "NSM", drop_original: bool = False) -> DataFrame:
    """Hour, minute, night and peak flags, and the part of the day."""
    h = t.hour_of(qcol(nsm), clamp=False)
    out = df.withColumns(
        {
            "hour": h, "minute": t.minute_of(qcol(nsm)), "is_night": t.is_night(h),
            "is_peak_hour": t.is_peak(h), "time_of_day": t.part_of_day(h),
        }
    )
    return out.drop(nsm) if drop_original else out


def add_day_name_features(df: DataFrame, day: str = "Day_of_week") -> DataFrame:
    """Day number with its sin/cos pair and the weekend flag, from the name."""
    d = t.day_number(qcol(day))
    sin, cos = t.cyclical(d, 7)
    return df.withColumns(
        {"day_num": d, "day_sin": sin, "day_cos": cos, "is_weekend": t.weekend_flag_of_name(qcol(day))}
    )


def add_calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    """Hour, day, month and year with sin/cos pairs over 24, 31 and 12."""
    c = qcol(ts)
    parts = {"hour": F.hour(c), "day": F.dayofmonth(c), "month": F.month(c), "year": F.year(c)}
    new = dict(parts)
    for name, period in (("hour", 24), ("day", 31), ("month", 12)):
        new[f"{name}_sin"], new[f"{name}_cos"] = t.cyclical(parts[name], period)
    return df.withColumns(new)


def request_features(df: DataFrame, day_number: str = "day_of_week", nsm: str = "nsm") -> DataFrame:
    """Request rows with a day number to model features: day name, week status, temporal features."""
    d = qcol(day_number)
    sin_h, cos_h = t.cyclical(t.hour_of(qcol(nsm)), 24)
    sin_d, cos_d = t.cyclical(d, 7)
    return df.withColumns(
        {
            "day_name": t.day_name(d), "week_status": t.week_status(d), "hour": t.hour_of(qcol(nsm)),
            "is_weekend": t.weekend_flag(d), "cyclical_hour_sin": sin_h, "cyclical_hour_cos": cos_h,
            "cyclical_day_sin": sin_d, "cyclical_day_cos": cos_d,
        }
    )


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    inputCol = Param(Params._dummy(), "inputCol", "input column", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", typeConverter=TypeConverters.toString)

    def feature_names(self) -> list[str]:
        return [self.getOrDefault("outputCol")]


class HourStage(_Stage):
    """Hour from seconds since midnight."""

    clamp = Param(Params._dummy(), "clamp", "count 86400 as hour 23", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol="NSM", outputCol="hour", clamp=True):
        super().__init__()
        self._setDefault(inputCol="NSM", outputCol="hour", clamp=True)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_hour(df, self.getOrDefault("inputCol"), self.getOrDefault("outputCol"), self.getOrDefault("clamp"))


class WeekendNameStage(_Stage):
    """0/1 weekend flag from a day name."""

    @keyword_only
    def __init__(self, inputCol="Day_of_week", outputCol="is_weekend"):
        super().__init__()
        self._setDefault(inputCol="Day_of_week", outputCol="is_weekend")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        flag = t.weekend_flag_of_name(qcol(self.getOrDefault("inputCol")))
        return df.withColumn(self.getOrDefault("outputCol"), flag)


class CyclicalStage(_Stage):
    """Sin/cos pair named after ``outputCol``."""

    period = Param(Params._dummy(), "period", "length of one cycle", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCol="hour", outputCol="hour", period=24.0):
        super().__init__()
        self._setDefault(inputCol="hour", outputCol="hour", period=24.0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_cyclical(
            df, self.getOrDefault("inputCol"), self.getOrDefault("period"), self.getOrDefault("outputCol")
        )

    def feature_names(self) -> list[str]:
        name = self.getOrDefault("outputCol")
        return [f"{name}_sin", f"{name}_cos"]


def feature_stages(*stages: _Stage) -> tuple[Pipeline, list[str]]:
    """Stages in order, and the names of the columns they add."""
    return Pipeline(stages=list(stages)), [n for s in stages for n in s.feature_names()]
