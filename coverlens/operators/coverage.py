"""Coverage analysis on the price fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlens.functions.numeric import favourable, to_number


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail before any job runs when columns are missing; list missing and available ones."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks {missing}; it has {list(df.columns)}")
    return df


def no_favorable(prices: DataFrame, keys: Sequence[str], measure: str, carry: Sequence[str],
                 order: str | Sequence[str], threshold: float = 0.0,
                 missing_is_favorable: bool = False) -> DataFrame:
    """Groups of ``keys`` in which no row is favourable (measure <= threshold).

    The carried columns are those of the first row of the group in ``order`` (D12).
    Groups with a null key are dropped (D11).  ``bool_or`` and ``min_by`` are both
    mergeable, so a hot group is reduced map-side before the one shuffle on ``keys``.
    """
    require_columns(prices, [*keys, measure, *carry])
    order = [order] if isinstance(order, str) else list(order)
    m = to_number(F.col(measure), prices.schema[measure].dataType)
    fav = favourable(m, threshold)
    if missing_is_favorable:
        fav = fav | m.isNull()
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if len(carry) == 1 and len(order) == 1:
        # No struct wrapping: a fixed-width value and order keep the hash aggregate.
        first, pick = F.min_by(F.col(carry[0]), F.col(order[0])), [F.col("__first").alias(carry[0])]
    else:
        first = F.min_by(F.struct(*[F.col(c) for c in carry]), F.struct(*[F.col(c) for c in order]))
        pick = [F.col("__first")[c].alias(c) for c in carry]
    out = (prices.filter(not_null)
           .groupBy(*keys)
           .agg(F.bool_or(fav).alias("__any"), first.alias("__first"))
           .filter(~F.col("__any")))
    return out.select(*keys, *pick)


def no_favorable_summary(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and distinct values of each key among the reported groups (A2)."""
    return groups.agg(F.count(F.lit(1)).cast("long").alias("n"),
                      *[F.count_distinct(k).cast("long").alias(f"n_{k}") for k in keys])


def pair_coverage_by_source(df: DataFrame, cols: Sequence[str], source: str) -> DataFrame:
    """Distinct ``cols`` tuples per source (A3); null values count as a value, as in drop_duplicates."""
    return (df.select(source, *cols).distinct()
            .groupBy(source).agg(F.count(F.lit(1)).cast("long").alias("n_pairs")))


def pair_coverage(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Union of frames, distinct tuples, then totals: tuples and distinct non-null values per column."""
    union = reduce(lambda a, b: a.unionByName(b), [f.select(*cols) for f in frames]).distinct()
    return union.agg(F.count(F.lit(1)).cast("long").alias("pairs"),
                     *[F.count_distinct(c).cast("long").alias(f"n_{c}") for c in cols])
