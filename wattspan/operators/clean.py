"""Casting, filtering and value repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import map_lookup, numeric_columns, qcol, qcols, require, set_columns, string_columns
from wattspan.functions.text import NULL_TOKENS, is_blank, lenient_double, lenient_long, title_case
from wattspan.operators.small import join_small, scalar_row


def cast_schema(df: DataFrame, schema: dict[str, str], drop: list[str] = ()) -> DataFrame:
    """Casts the columns named in ``schema``; values that do not parse become null."""
    out = df.drop(*drop)
    types = dict(out.dtypes)
    exprs = {}
    for name, target in schema.items():
        if name not in types:
            continue
        c = qcol(name)
        if types[name] == "string" and target == "double":
            exprs[name] = lenient_double(c)
        elif types[name] == "string" and target in ("bigint", "int"):
            exprs[name] = lenient_long(c).try_cast(target)
        elif types[name] != target:
            exprs[name] = c.try_cast(target)
    return set_columns(out, exprs)


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Keeps rows whose critical column holds a value."""
    return df.filter(~is_blank(qcol(column)))


def null_count(df: DataFrame):
    total = F.lit(0)
    for c in df.columns:
        total = total + qcol(c).isNull().cast("int")
    return total


def drop_sparse(df: DataFrame, max_nulls: int | None = None, max_share: float | None = None) -> DataFrame:
    """Keeps rows with at most ``max_nulls`` nulls, or at most that share of the columns."""
    limit = max_nulls if max_nulls is not None else len(df.columns) * max_share
    return df.filter(null_count(df) <= F.lit(limit))


def clamp(df: DataFrame, rules: dict[str, dict], absolute: list[str] = ()) -> DataFrame:
    """Absolute values first, then range limits. Nulls stay null."""
    out = set_columns(df, {c: F.abs(qcol(c)) for c in absolute if c in df.columns})
    exprs = {}
    for name, rule in rules.items():
        if name not in df.columns:
            continue
        c, lo, hi = qcol(name), rule.get("min"), rule.get("max")
        kind = dict(df.dtypes)[name]
        e = c
        if hi is not None:
            e = F.when(c > hi, F.lit(hi).cast(kind)).otherwise(e)
        if lo is not None:
            e = F.when(c < lo, F.lit(lo).cast(kind)).otherwise(e)
        exprs[name] = e
    return set_columns(out, exprs)


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent non-null value per column as one row; ties give the smallest value.

    Counted by a shuffle on (column, value), so no task holds all values.
    """
    require(df, columns)
    long = df.select(*[qcol(c).cast("string").alias(c) for c in columns]).unpivot(
        [], qcols(columns), "_column", "_value"
    )
    counts = long.filter(F.col("_value").isNotNull()).groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct((-F.col("_n")).alias("n"), F.col("_value").alias("v"))
    return counts.agg(*[F.min(F.when(F.col("_column") == c, rank)).getField("v").alias(c) for c in columns])


def clean_categories(df: DataFrame, columns: list[str], default: str = "Unknown") -> DataFrame:
    """Trim, blank tokens to null, title case, then fill with the mode."""
    tidy = set_columns(
        df, {c: F.when(~is_blank(qcol(c)), title_case(F.trim(qcol(c)))) for c in columns if c in df.columns}
    )
    present = [c for c in columns if c in df.columns]
    mode_row = scalar_row(modes(tidy, present))
    return set_columns(
        tidy, {c: F.coalesce(qcol(c), mode_row.getField(c), F.lit(default)) for c in present}
    )


def map_values(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Replaces listed values, keeps the others."""
    return set_columns(df, {column: F.coalesce(map_lookup(mapping, qcol(column)), qcol(column))})


def map_values_from(df: DataFrame, column: str, table: DataFrame, key: str, value: str) -> DataFrame:
    """As :func:`map_values` with the corrections in a table of any size.

    Of several corrections for one key the smallest counts; a null key corrects nothing.
    """
    side = table.filter(qcol(key).isNotNull()).groupBy(qcol(key).alias(column)).agg(F.min(qcol(value)).alias("_to"))
    out = join_small(df, side, [column], "left")
    return set_columns(out, {column: F.coalesce(F.col("_to"), qcol(column))}).drop("_to")


def tidy_strings_and_dates(df: DataFrame, date_column: str, fmt: str = "dd/MM/yyyy HH:mm",
                           sort: bool = False) -> DataFrame:
    """Trims every text column, parses a day-first date and drops rows without one."""
    out = set_columns(df, {c: F.trim(qcol(c)) for c in string_columns(df)})
    parsed = F.try_to_timestamp(qcol(date_column), F.lit(fmt)).cast("timestamp_ntz")
    out = set_columns(out, {date_column: parsed}).filter(qcol(date_column).isNotNull())
    return out.orderBy(qcol(date_column)) if sort else out


def to_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns to double, non-numeric to null."""
    return set_columns(df, {c: lenient_double(qcol(c)) for c in columns})


def select_features(df: DataFrame, features: list[str], exclude: list[str] = ()) -> DataFrame:
    require(df, features)
    return df.select(*qcols(c for c in features if c not in exclude))


def align_schema(reference: DataFrame, other: DataFrame) -> DataFrame:
    """Reference column order and types; columns the reference lacks are dropped."""
    require(other, reference.columns)
    return other.select(*[qcol(f.name).try_cast(f.dataType).alias(f.name) for f in reference.schema.fields])


def subset(df: DataFrame, column: str, values: list, columns: list[str] | None = None) -> DataFrame:
    """Rows of the listed classes, with only the columns an analysis needs."""
    out = df.filter(qcol(column).isin(*values))
    return out.select(*qcols(columns)) if columns else out


def labels_from_dummies(df: DataFrame, labels: dict[str, str], name: str) -> DataFrame:
    """The label whose one-hot column is largest; the first one on ties."""
    cols = F.array(*[qcol(c).cast("double") for c in labels])
    names = F.array(*[F.lit(v) for v in labels.values()])
    at = F.array_position(cols, F.array_max(cols)).cast("int")
    return df.withColumn(name, F.try_element_at(names, at))


def null_tokens(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Text tokens that stand for a missing value become null in every text column."""
    words = NULL_TOKENS if tokens is None else tokens
    return set_columns(df, {c: F.when(~qcol(c).isin(*words), qcol(c)) for c in string_columns(df)})


def numeric_or(df: DataFrame, columns: list[str] | None) -> list[str]:
    return numeric_columns(df) if columns is None else list(columns)
