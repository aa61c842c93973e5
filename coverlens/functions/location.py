"""Location helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def city_from_display(display: Column, zip_code: Column) -> Column:
    """City from a comma-separated place name: second part, unless it equals the zip, then third."""
    parts = F.split(display, ", ")
    p1, p2 = F.get(parts, 1), F.get(parts, 2)
    return (F.when(F.size(parts) > 1,
                   F.when(~p1.eqNullSafe(zip_code), p1).otherwise(F.coalesce(p2, F.lit(""))))
            .otherwise(F.lit("")))


def city_or_fallback(city: Column, state: Column) -> Column:
    """Empty or missing city -> ``{state}_City``."""
    return F.coalesce(F.nullif(city, F.lit("")), F.concat(state, F.lit("_City")))
