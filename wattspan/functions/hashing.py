"""Seeded md5 order: the same on any partitioning, and replayable in other engines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def seeded_md5(id_col: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), id_col.cast("string")))


def unit_interval(digest: Column) -> Column:
    """First 8 hex digits as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
