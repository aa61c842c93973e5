"""Numeric coercion with the reference's missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the text forms a float parser of the reference accepts -----
NUMERIC_TEXT = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?|nan)\s*$"
# -------------------------------------------------------------------------------


def to_number(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Coerce to double; text that is not a plain number becomes null (never an error).

    ``try_cast`` alone would accept ``5d`` and hex floats, so the text is checked first.
    """
    col = F.col(c) if isinstance(c, str) else c
    if dtype is not None and isinstance(dtype, T.NumericType):
        return col.cast("double")
    text = col.cast("string")
    return F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))


def favourable(measure: Column, threshold: float = 0.0) -> Column:
    """measure <= threshold; a missing measure is not favourable."""
    return F.coalesce(measure <= F.lit(threshold), F.lit(False))
