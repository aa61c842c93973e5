"""Code matching between a price list and the catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.functions.codes import stripped_code


def _keyed(df: DataFrame, code: str) -> DataFrame:
    # Null codes would break every match in the reference (D23); they never match here.
    return df.withColumn("__key", stripped_code(code)).filter(F.col("__key").isNotNull())


def code_intersection(left: DataFrame, left_code: str, right: DataFrame, right_code: str) -> DataFrame:
    """Distinct codes present on both sides, in stripped form as A11 and J7 compare them."""
    l = _keyed(left, left_code).select(F.col("__key").alias("code"))
    r = _keyed(right, right_code).select(F.col("__key").alias("code"))
    return l.intersect(r)


def match_codes(left: DataFrame, left_code: str, left_carry: dict[str, str], left_order: Sequence[str],
                right: DataFrame, right_code: str, right_carry: dict[str, str], right_order: Sequence[str]) -> DataFrame:
    """For every code on both sides, the first row of each side joined.

    Codes compare in stripped form (P5), as the reference compares numeric readings;
    the output ``code`` is that display form and sorts as text (L2) when the caller
    orders by it.  ``*_carry`` maps output name -> source column.  The first row per
    code is a ``min_by`` aggregate (mergeable, deterministic, D12), so repeated codes
    are reduced map-side; the two reduced sides then join on the key.
    """
    def first(df, code, carry, order):
        k = _keyed(df, code)
        if len(carry) == 1 and len(order) == 1:
            # No struct wrapping: a fixed-width value and order keep the hash aggregate.
            (out, src), = carry.items()
            return k.groupBy("__key").agg(F.min_by(F.col(src), F.col(order[0])).alias(out))
        pick = F.min_by(F.struct(*[F.col(src).alias(out) for out, src in carry.items()]),
                        F.struct(*[F.col(c) for c in order]))
        return k.groupBy("__key").agg(pick.alias("__v")).select("__key", "__v.*")

    l = first(left, left_code, left_carry, left_order)
    r = first(right, right_code, right_carry, right_order)
    return l.join(r, "__key", "inner").withColumnRenamed("__key", "code")


def code_match_summary(left: DataFrame, left_code: str, right: DataFrame, right_code: str) -> DataFrame:
    """Distinct codes on each side and on both (A11), as one aggregate over side-tagged keys."""
    l = _keyed(left, left_code).select("__key", F.lit(1).alias("__l"), F.lit(0).alias("__r"))
    r = _keyed(right, right_code).select("__key", F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    per_key = l.unionByName(r).groupBy("__key").agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
    return per_key.agg(F.sum("__l").cast("long").alias("n_left"), F.sum("__r").cast("long").alias("n_right"),
                       F.count_if((F.col("__l") == 1) & (F.col("__r") == 1)).cast("long").alias("n_both"))
