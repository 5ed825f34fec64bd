"""Joins against side tables whose size is measured first, and reliable checkpoints."""

from __future__ import annotations

import tempfile
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wattspan.functions.columns import qcol

BROADCAST_BYTES = 32 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is
    used only for a local master where the setting is absent.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="wattspan-checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes the rows to the checkpoint folder, so a lost executor cannot change them."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scalar_row(one_row: DataFrame) -> Column:
    """A one-row frame (a global aggregate) as a struct-valued scalar subquery."""
    return one_row.select(F.struct("*")).scalar()


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; keeps the left key columns."""
    renamed = right.select(
        *[qcol(c).alias(f"_r_{c}") if c in on else qcol(c) for c in right.columns]
    )
    cond = None
    for c in on:
        eq = left[c_ref(c)].eqNullSafe(renamed[c_ref(f"_r_{c}")])
        cond = eq if cond is None else cond & eq
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])


def c_ref(name: str) -> str:
    return "`" + name + "`"


class Size(NamedTuple):
    rows: int
    bytes: int


def _width(field: T.StructField) -> Column:
    """Estimated bytes of one value."""
    c = qcol(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 24
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 24
    return F.lit(16)


def settled(side: DataFrame) -> tuple[DataFrame, Size]:
    """The frame checkpointed, with its rows and estimated bytes."""
    side = checkpointed(side)
    width = F.lit(16)
    for field in side.schema.fields:
        width = width + _width(field)
    rows, size = side.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return side, Size(rows, size)


def join_settled(big: DataFrame, side: DataFrame, size: Size, on: list[str], how: str = "inner",
                 limit: int | None = None) -> DataFrame:
    """Broadcasts a checkpointed side of known size, or shuffles beyond ``limit`` bytes."""
    bound = BROADCAST_BYTES if limit is None else limit
    return null_safe_join(big, F.broadcast(side) if size.bytes <= bound else side, on, how)


def join_small(big: DataFrame, side: DataFrame, on: list[str], how: str = "inner",
               limit: int | None = None) -> DataFrame:
    """Joins an aggregate that is usually small.

    The side is checkpointed and measured; up to ``limit`` bytes it is broadcast,
    beyond that the join shuffles and adaptive execution splits skewed keys.
    """
    side, size = settled(side)
    return join_settled(big, side, size, on, how, limit)
