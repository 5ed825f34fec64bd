"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tokens that mean "no value".
BLANK_TOKENS = ["NAN", "N/A", ""]
NULL_TOKENS = ["nan", "NaN", "None", "NULL", "null"]


def is_blank(c: Column) -> Column:
    """True for null and for blank tokens in any case."""
    return c.isNull() | F.upper(F.trim(c)).isin(*BLANK_TOKENS)


def title_case(c: Column) -> Column:
    """Title case with both spaces and underscores as word breaks."""
    words = F.split(F.initcap(F.lower(c)), "_")
    capped = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.array_join(capped, "_")


def lenient_double(c: Column) -> Column:
    """Text to double; anything that is not a plain number gives null.

    The Java parser allows one type suffix. Adding it here rejects text that
    already has one, and the literals NaN and Infinity, in a single evaluation.
    """
    return F.concat(F.trim(c), F.lit("D")).try_cast("double")


def lenient_long(c: Column) -> Column:
    """Text to integer through double, so ``12.0`` and ``12.7`` give 12."""
    return lenient_double(c).try_cast("bigint")
