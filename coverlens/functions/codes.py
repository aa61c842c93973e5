"""Code keys: catalogue codes are strings with leading zeros."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE_WIDTH = 11


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_text(c: Column | str) -> Column:
    """A code as text, trimmed; numbers are rendered without a fractional part."""
    return F.trim(_c(c).cast("string"))


def stripped_code(c: Column | str) -> Column:
    """Display key: the code as a number would print it (leading zeros dropped, ``0`` kept).

    Comparing stripped keys equals the reference's comparison of codes read as numbers.
    Non-numeric codes stay as they are.
    """
    t = code_text(c)
    return F.when(t.rlike(r"^[0-9]+$"), F.regexp_replace(t, r"^0+(?=.)", "")).otherwise(t)


def padded_code(c: Column | str, width: int = CODE_WIDTH) -> Column:
    """Canonical key of the collector: all-digit codes left-padded to ``width`` digits."""
    s = stripped_code(c)
    return F.when(s.rlike(r"^[0-9]+$") & (F.length(s) < width), F.lpad(s, width, "0")).otherwise(s)
