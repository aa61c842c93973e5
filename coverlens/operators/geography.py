"""Locations: state filter, batch slicing, previews, geocode join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.functions.location import city_or_fallback
from coverlens.operators.ordered import ntile_of, ntile_start, running_scan, slice_by_rank

# --- fixed values: the reference's state order --------------------------------
STATES = ["FL", "GA", "OH"]
# -------------------------------------------------------------------------------


def filter_states(df: DataFrame, states: Sequence[str] | None, col: str = "state") -> DataFrame:
    """Keep the chosen states; none chosen keeps all (P6).  Pushed to the scan / partition filter."""
    return df if not states else df.filter(F.col(col).isin(list(states)))


def validate_batch(batch_num: int | None, total_batches: int | None) -> None:
    if (batch_num is None) != (total_batches is None):
        raise ValueError("batch_num and total_batches must be given together")
    if batch_num is not None and not (1 <= batch_num <= total_batches):
        raise ValueError(f"no batch {batch_num} among {total_batches}")


def assign_batches(df: DataFrame, by: Sequence[str], order: Sequence[str], total_batches: int,
                   out: str = "batch_num") -> DataFrame:
    """Contiguous balanced batches per group (W1): sizes n div k, the first n mod k one larger.

    The ordinal and group size come from ``running_scan``, so a state holding most
    of the rows is still spread over many tasks; the batch is then a closed form.
    """
    if total_batches < 1:
        raise ValueError("total_batches must be >= 1")
    s = running_scan(df, by, order, ordinal="__i", group_size="__n")
    return s.withColumn(out, ntile_of(F.col("__i"), F.col("__n"), total_batches)).drop("__i", "__n")


def batch_slice(df: DataFrame, by: Sequence[str], order: Sequence[str], batch_num: int,
                total_batches: int, preview: int | None = None) -> DataFrame:
    """Rows of one batch; with ``preview`` only its first ``preview`` rows per group.

    One batch needs the order keys at its two ends only, so the list is neither sorted nor numbered.
    """
    validate_batch(batch_num, total_batches)
    n = F.col("n")
    start, stop = ntile_start(batch_num, n, total_batches), ntile_start(batch_num + 1, n, total_batches)
    return slice_by_rank(df, by, order, start, stop if preview is None else F.least(stop, start + preview))


def locate(zips: DataFrame, geocodes: DataFrame, on: Sequence[str], state: str = "state",
           city: str = "city") -> DataFrame:
    """Zips with coordinates; an empty city becomes ``{state}_City``."""
    rest = [c for c in geocodes.columns if c not in on]
    once = geocodes.groupBy(*on).agg(F.max(F.struct(*rest)).alias("__g")).select(*on, "__g.*")  # a key given twice is one place
    out = zips.join(once, list(on), "inner")
    return out.withColumn(city, city_or_fallback(F.col(city), F.col(state)))


def locate_rejects(zips: DataFrame, geocodes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Zips without a geocode, reported instead of silently dropped (J3 rejects)."""
    return zips.join(geocodes.select(*on), list(on), "left_anti")
