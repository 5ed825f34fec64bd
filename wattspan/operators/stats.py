"""Grouped statistics, profiles, histograms and cost rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wattspan.functions import temporal as t
from wattspan.functions.columns import number, numeric_columns, qcol, qcols, require, rows_of
from wattspan.operators.clean import modes
from wattspan.operators.quantiles import exact_quantiles, quantile_row
from wattspan.operators.small import scalar_row


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def group_stats(df: DataFrame, by: list[str], value: str, digits: int | None = 2) -> DataFrame:
    """Count, mean, min, max and sample deviation per group, highest mean first."""
    v = qcol(value)
    return df.groupBy(*qcols(by)).agg(
        F.count(F.lit(1)).alias("count"),
        _round(F.avg(v), digits).alias("avg"),
        _round(F.min(v), digits).alias("min"),
        _round(F.max(v), digits).alias("max"),
        _round(F.stddev_samp(v), digits).alias("std"),
    ).orderBy(F.desc("avg"), *by)


def time_bucket_stats(df: DataFrame, seconds: str, value: str, unit: str = "hour", digits: int | None = 2) -> DataFrame:
    """Statistics per hour, minute or day of a seconds column."""
    if unit not in t.SECONDS_PER:
        raise ValueError(f"unit must be one of {sorted(t.SECONDS_PER)}, got {unit}")
    bucket = F.floor(qcol(seconds) / F.lit(t.SECONDS_PER[unit])).alias(unit)
    return df.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("records"),
        _round(F.avg(qcol(value)), digits).alias("avg_value"),
        _round(F.stddev_samp(qcol(value)), digits).alias("std_value"),
    ).orderBy(unit)


def week_status_stats(df: DataFrame, status: str, value: str, digits: int | None = 2) -> DataFrame:
    return group_stats(df, [status], value, digits)


def day_of_week_stats(df: DataFrame, day: str, value: str, digits: int | None = 2) -> DataFrame:
    """Mean per day name in calendar order."""
    return df.groupBy(qcol(day)).agg(
        F.count(F.lit(1)).alias("count"), _round(F.avg(qcol(value)), digits).alias("avg")
    ).orderBy(F.coalesce(t.day_number(qcol(day)), F.lit(7)))


def mode_value(df: DataFrame, column: str, default: str = "Unknown") -> DataFrame:
    return modes(df, [column]).select(F.coalesce(qcol(column), F.lit(default)).alias("mode"))


def cardinality(df: DataFrame, column: str) -> DataFrame:
    """One row per category: count, share, and the facts of the whole column."""
    require(df, [column])
    counts = df.groupBy(qcol(column).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    top = F.struct((-F.col("n")).alias("n"), F.col("category").alias("c"))
    facts = scalar_row(
        counts.agg(
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("n_categories"),
            F.min(top).getField("c").alias("most_common"),
            # Among equal counts the last name is the least common.
            F.max(top).getField("c").alias("least_common"),
        )
    )
    out = counts.withColumn("_f", facts)
    f = lambda n: F.col("_f").getField(n)
    return out.select(
        "category", "n", (F.col("n") / f("total")).alias("share"),
        f("n_categories").alias("n_categories"), (f("n_categories") - 1).alias("encoding_size"),
        f("most_common").alias("most_common"), f("least_common").alias("least_common"),
    )


def numeric_summary(df: DataFrame, cols: list[str] | None = None, quartiles: bool = True) -> DataFrame:
    """Mean, sample deviation, min, max, median and quartiles, one row per column.

    The median interpolates, the quartiles take the nearest rank.
    """
    names = numeric_columns(df) if cols is None else cols
    probs = [(0.5, "linear")] + ([(0.25, "nearest"), (0.75, "nearest")] if quartiles else [])
    q = scalar_row(quantile_row(df, names, probs))
    one = df.agg(
        *[F.avg(number(c)).alias(f"{c}|mean") for c in names],
        *[F.stddev_samp(number(c)).alias(f"{c}|std") for c in names],
        *[F.min(number(c)).cast("double").alias(f"{c}|min") for c in names],
        *[F.max(number(c)).cast("double").alias(f"{c}|max") for c in names],
    ).withColumn("_q", q)
    rows = []
    for c in names:
        row = [("column", F.lit(c))] + [(s, qcol(f"{c}|{s}")) for s in ("mean", "std", "min", "max")]
        row += [(n, F.col("_q").getField(f"{c}_q{i}")) for i, n in enumerate(["median", "q25", "q75"][: len(probs)])]
        rows.append(row)
    return rows_of(one, rows)


def feature_statistics(df: DataFrame, features: list[str]) -> DataFrame:
    """Numeric features get a summary, boolean ones true/false counts."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    flags = [c for c in features if isinstance(kinds.get(c), T.BooleanType)]
    nums = [c for c in features if isinstance(kinds.get(c), T.NumericType)]
    parts = []
    if nums:
        s = numeric_summary(df, nums, quartiles=False)
        parts.append(s.select(F.lit("numeric").alias("type"), "*"))
    if flags:
        one = df.agg(
            F.count(F.lit(1)).alias("_n"), *[F.count_if(qcol(c)).alias(f"t{i}") for i, c in enumerate(flags)]
        )
        parts.append(
            rows_of(
                one,
                [
                    [
                        ("type", F.lit("boolean")), ("column", F.lit(c)), ("true_count", F.col(f"t{i}")),
                        ("false_count", F.col("_n") - F.col(f"t{i}")),
                        ("true_pct", F.try_divide(F.col(f"t{i}"), F.col("_n")) * 100),
                    ]
                    for i, c in enumerate(flags)
                ],
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def split_statistics(df: DataFrame, split: str, numeric: list[str]) -> DataFrame:
    """Mean, deviation, min, max and median per split and column."""
    med = exact_quantiles(df, numeric, [0.5], [split]).select(qcol(split), "column", F.col("q0").alias("median"))
    per = df.groupBy(qcol(split)).agg(
        *[f(qcol(c)).cast("double").alias(f"{c}|{n}") for c in numeric
          for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    )
    rows = rows_of(per, [
        [("column", F.lit(c))] + [(s, qcol(f"{c}|{s}")) for s in ("mean", "std", "min", "max")] for c in numeric
    ], [split])
    # Splits times columns rows on both sides.
    return rows.join(F.broadcast(med), [split, "column"])


def split_category_counts(df: DataFrame, split: str, categorical: list[str]) -> DataFrame:
    long = df.select(qcol(split), *[qcol(c).cast("string").alias(c) for c in categorical]).unpivot(
        [qcol(split)], qcols(categorical), "column", "category")
    return long.groupBy(qcol(split), "column", "category").agg(F.count(F.lit(1)).alias("n"))


def feature_types(df: DataFrame, exclude: list[str] = (), share: float = 0.10, approximate: bool = False) -> DataFrame:
    """numeric / boolean / datetime, and text as categorical below a distinct share."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    # One shuffle on (column, value) counts the distinct values of all text columns; null is a value.
    if approximate or not texts:
        one = df.agg(
            F.count(F.lit(1)).alias("_n"),
            *[(F.approx_count_distinct(qcol(c)) + F.max(qcol(c).isNull().cast("int"))).alias(f"d{i}")
              for i, c in enumerate(texts)],
        )
    else:
        long = df.select(*qcols(texts)).unpivot([], qcols(texts), "_c", "_v")
        pairs = long.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_k"))
        one = pairs.agg(
            F.sum(F.when(F.col("_c") == texts[0], F.col("_k"))).alias("_n"),
            *[F.count_if(F.col("_c") == c).alias(f"d{i}") for i, c in enumerate(texts)],
        )
    rows = []
    for f in fields:
        if f.name in texts:
            d = F.col(f"d{texts.index(f.name)}")
            kind = F.when(F.try_divide(d, F.col("_n")) < share, "categorical").otherwise("excluded")
        elif isinstance(f.dataType, T.BooleanType):
            kind = F.lit("boolean")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            kind = F.lit("datetime")
        elif isinstance(f.dataType, T.NumericType):
            kind = F.lit("numeric")
        else:
            kind = F.lit("excluded")
        rows.append([("column", F.lit(f.name)), ("kind", kind)])
    return rows_of(one, rows)


def hour_weekday_matrix(df: DataFrame, hour: str, day: str, value: str) -> DataFrame:
    """Mean by hour (rows) and day number (columns ``d0``..``d6``)."""
    p = df.groupBy(qcol(hour).alias("hour")).pivot(day, list(range(7))).agg(F.avg(qcol(value)))
    return p.select("hour", *[qcol(str(d)).alias(f"d{d}") for d in range(7)])


def usage_profile(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean, deviation and count per hour or day, with the group of the highest mean flagged."""
    per = df.groupBy(qcol(by).alias("bucket")).agg(
        F.avg(qcol(value)).alias("mean"), F.stddev_samp(qcol(value)).alias("std"), F.count(F.lit(1)).alias("n")
    )
    peak = per.agg(F.max_by("bucket", F.struct(F.col("mean"), -F.col("bucket")))).scalar()
    return per.withColumn("is_peak", F.col("bucket") == peak)


def weekend_effect(df: DataFrame, weekend: Column, value: str) -> DataFrame:
    """Weekend and weekday means, their difference in percent and the savings it suggests."""
    v = qcol(value)
    one = df.agg(F.avg(F.when(weekend, v)).alias("weekend_avg"), F.avg(F.when(~weekend, v)).alias("weekday_avg"))
    saving = F.col("weekday_avg") - F.col("weekend_avg")
    return one.select(
        "weekend_avg", "weekday_avg",
        (F.try_divide(F.col("weekend_avg") - F.col("weekday_avg"), F.col("weekday_avg")) * 100).alias("difference_pct"),
        saving.alias("saving_per_hour"), (saving * 24).alias("saving_per_day"),
        # 104 weekend days a year.
        (saving * 24 * 104).alias("saving_per_year"),
    )


def series_by_time(df: DataFrame, time: Column, value: str, how: str = "mean") -> DataFrame:
    """One value per time key: mean, sum or median."""
    keyed = df.select(time.alias("time"), qcol(value).alias("value"))
    if how == "median":
        q = exact_quantiles(keyed, ["value"], [0.5], ["time"])
        return q.select("time", F.col("q0").alias("value")).orderBy("time")
    if how not in ("mean", "sum"):
        raise ValueError(f"how must be mean, sum or median, got {how}")
    agg = F.avg if how == "mean" else F.sum
    return keyed.groupBy("time").agg(agg("value").alias("value")).orderBy("time")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins with counts, empty bins included; the last bin is closed. Null, NaN and infinite values are
    not counted."""
    v = qcol(column).cast("double")
    finite = F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
    ends = scalar_row(df.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi")))
    placed = df.select(finite.alias("v"), ends.alias("_e")).filter("v IS NOT NULL")
    lo, hi = F.col("_e").getField("lo"), F.col("_e").getField("hi")
    index = F.when(hi > lo, F.least(F.floor((F.col("v") - lo) / ((hi - lo) / bins)), F.lit(bins - 1))).otherwise(0)
    counts = placed.groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), ends.alias("_g"))
    # Both sides have at most ``bins`` rows.
    glo = F.col("_g").getField("lo")
    width = (F.col("_g").getField("hi") - glo) / bins
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin", (glo + width * F.col("bin")).alias("lower"), (glo + width * (F.col("bin") + 1)).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_summary(df: DataFrame, category: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum per category."""
    q = exact_quantiles(df, [value], [0.0, 0.25, 0.5, 0.75, 1.0], [category])
    names = ["minimum", "q1", "median", "q3", "maximum"]
    return q.select(qcol(category), "n", *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])


def prediction_summary(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    p = qcol(prediction)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("avg"), F.min(p).alias("min"), F.max(p).alias("max")
    )


def energy_cost(df: DataFrame, kwh: str, peak: Column, rate: float = 0.15, multiplier: float = 1.5) -> DataFrame:
    """Adds base cost, peak surcharge, total cost and the saving if peak use moved."""
    k = qcol(kwh)
    effective = F.when(peak, F.lit(rate * multiplier)).otherwise(F.lit(rate))
    return (
        df.withColumn("effective_rate", effective)
        .withColumn("base_cost", k * rate)
        .withColumn("total_cost", k * F.col("effective_rate"))
        .withColumn("surcharge", F.col("total_cost") - F.col("base_cost"))
        .withColumn("savings_potential", F.when(peak, F.col("surcharge")).otherwise(F.lit(0.0)))
    )


COSTS = ["base_cost", "surcharge", "total_cost", "savings_potential"]


def cost_by_day(costed: DataFrame, day: Column) -> DataFrame:
    return costed.groupBy(day.alias("day")).agg(*[F.sum(c).alias(c) for c in COSTS])


# Class, lower bound of the mean power factor, score.
POWER_FACTOR_CLASSES = [
    ("Excelente", 0.95, 100),
    ("Muy Bueno", 0.90, 90),
    ("Bueno", 0.85, 75),
    ("Aceptable", 0.75, 60),
    ("Mejorable", None, 40),
]
POWER_FACTOR_GOAL = 0.95


def power_factor_classes(df: DataFrame, lagging: str, leading: str) -> DataFrame:
    """Adds the mean power factor, its class and score, and the gap to the goal in points."""
    mean = (qcol(lagging) + qcol(leading)) / 2
    name = score = None
    for label, bound, points in POWER_FACTOR_CLASSES:
        if bound is None:
            name, score = name.otherwise(label), score.otherwise(points)
        elif name is None:
            name, score = F.when(mean >= bound, label), F.when(mean >= bound, points)
        else:
            name, score = name.when(mean >= bound, label), score.when(mean >= bound, points)
    gap = (F.lit(POWER_FACTOR_GOAL) - mean) * 100
    return df.select(
        "*", mean.alias("average_pf"), name.alias("efficiency_class"), score.alias("efficiency_score"),
        F.when(gap > 0, gap).otherwise(F.lit(0.0)).alias("improvement_potential"),
    )


# Class, largest tCO2 per kWh, score.
EMISSION_CLASSES = [
    ("Bajo Impacto", 0.0008, 100),
    ("Impacto Moderado Bajo", 0.0015, 80),
    ("Impacto Moderado", 0.0025, 60),
    ("Alto Impacto", None, 40),
]
LEAST_KWH = 0.001
TREES_PER_TON = 50
CAR_KM_PER_TON = 4500


def emission_impact(df: DataFrame, kwh: str, co2: str) -> DataFrame:
    """Adds tCO2 per kWh, its class and score, and what the emissions compare to. Null and NaN readings stay unclassed."""
    rate = number(co2) / F.greatest(number(kwh), F.lit(LEAST_KWH))
    rate = F.when(number(kwh).isNotNull(), rate)
    pick = lambda k: F.coalesce(*[F.when(rate <= c[1] if c[1] is not None else rate.isNotNull(), F.lit(c[k])) for c in EMISSION_CLASSES])
    return df.select(
        "*", rate.alias("co2_per_kwh"), pick(0).alias("impact_class"), pick(2).alias("impact_score"),
        (number(co2) * TREES_PER_TON).alias("trees_equivalent"), (number(co2) * CAR_KM_PER_TON).alias("car_km_equivalent"),
    )


def top_rows(df: DataFrame, order: str, n: int = 10, ascending: bool = False, columns: list[str] | None = None,
             tiebreak: list[str] = ()) -> DataFrame:
    """The n rows with the largest (or smallest) values; nulls come last."""
    first = qcol(order).asc_nulls_last() if ascending else qcol(order).desc_nulls_last()
    out = df.orderBy(first, *qcols(tiebreak)).limit(n)
    return out.select(*qcols(columns)) if columns else out


def best_by(df: DataFrame, label: str, metric: str) -> DataFrame:
    """The label of the smallest metric; ties give the smallest label."""
    return df.agg(
        F.min_by(qcol(label), F.struct(qcol(metric), qcol(label))).alias("best"), F.min(qcol(metric)).alias(metric)
    )
