"""Column naming and small schema helpers.

Meter files carry names such as ``CO2(tCO2)`` or ``Reactive.Power``, so every
name is back-ticked through :func:`qcol`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(quoted(name))


def number(name: str) -> Column:
    """The column with NaN as null. Numeric operators leave NaN out as they do null; infinite values are values."""
    return F.when(~F.isnan(qcol(name)), qcol(name))


def qcols(names: Iterable[str]) -> list[Column]:
    return [qcol(n) for n in names]


def require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Columns not found: {missing}")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def set_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Replaces or adds columns, keeping the column order."""
    kept = [exprs.get(n, qcol(n)).alias(n) for n in df.columns]
    added = [e.alias(n) for n, e in exprs.items() if n not in df.columns]
    return df.select(*kept, *added)


def map_lookup(mapping: dict, key: Column) -> Column:
    """Literal map lookup; null for unknown keys."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def rows_of(df: DataFrame, rows: list[list[tuple[str, Column]]], keep: list[str] = ()) -> DataFrame:
    """Turns each input row into one output row per entry of ``rows``, repeating ``keep``."""
    structs = [F.struct(*[c.alias(n) for n, c in row]) for row in rows]
    return df.select(*qcols(keep), F.inline(F.array(*structs)))


def unpivot(df: DataFrame, ids: list[str], cols: list[str], name: str, value: str) -> DataFrame:
    """Long form of ``cols`` as doubles."""
    wide = df.select(*qcols(ids), *[qcol(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(qcols(ids), qcols(cols), name, value)
