"""Text helpers: Python-style strip, line splitting, substring filters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) ---------------------
# Characters removed by Python's argument-less str.strip(): the characters for
# which str.isspace() is true, in code-point order.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Line boundaries of Python's text-mode file iteration (universal newlines).
LINE_BREAK = r"\r\n|\r|\n"
# -----------------------------------------------------------------------------


def py_strip(c: Column | str) -> Column:
    """``str.strip()`` of the reference: trim both ends, keep inner spaces."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(PY_WHITESPACE))


def split_lines(c: Column | str) -> Column:
    """Array of the lines of a text, split as a text-mode file read splits them."""
    col = F.col(c) if isinstance(c, str) else c
    # A final line break does not start another line.
    body = F.regexp_replace(col, r"(\r\n|\r|\n)$", "")
    return F.split(body, LINE_BREAK)


def clean_lines(c: Column | str) -> Column:
    """The lines of a text without white space around them, blank ones left out."""
    return F.filter(F.transform(split_lines(c), py_strip), lambda l: l != F.lit(""))


def contains_all(c: Column | str, needles: list[str]) -> Column:
    """Cheap substring prefilter: every needle occurs in the value."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.lit(True)
    for n in needles:
        out = out & col.contains(n)
    return out
