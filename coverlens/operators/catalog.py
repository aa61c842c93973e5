"""Catalogue resolution and enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.operators.ordered import running_scan


def _present(c: Column) -> Column:
    """Truthiness of the reference: a missing or empty identifier counts as absent."""
    return F.coalesce(c.cast("string"), F.lit("")) != F.lit("")


def _one_per_key(mapping: DataFrame, map_code: str, map_value: str, out: str) -> DataFrame:
    """The map with each key once: its greatest value, so an identifier wins over an empty entry."""
    return (mapping.groupBy(F.col(map_code).alias("__k")).agg(F.max(map_value).alias(out))
            .filter(F.col("__k").isNotNull()))


def resolve(catalog: DataFrame, code: str, mapping: DataFrame, map_code: str, map_value: str) -> DataFrame:
    """Catalogue rows whose code has a non-empty identifier in ``mapping`` (J1, inner)."""
    m = _one_per_key(mapping.filter(_present(F.col(map_value))), map_code, map_value, map_value)
    return catalog.join(m, catalog[code] == m["__k"], "inner").drop("__k")


def rejects(catalog: DataFrame, code: str, mapping: DataFrame, map_code: str, map_value: str) -> DataFrame:
    """Catalogue rows left out by ``resolve`` (J1 rejects, anti join)."""
    m = mapping.filter(_present(F.col(map_value))).select(F.col(map_code).alias("__k"))
    return catalog.join(m, catalog[code] == m["__k"], "left_anti")


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """1-based numbering in ``order`` within ``by`` (A12), without a one-group task."""
    return running_scan(df, by, order, ordinal=name)


def enrich(catalog: DataFrame, code: str, mapping: DataFrame, map_code: str, map_value: str,
           out: str | None = None) -> DataFrame:
    """Every catalogue row plus its identifier, null when absent (J2, left join)."""
    m = _one_per_key(mapping, map_code, map_value, out or map_value)
    return catalog.join(m, catalog[code] == m["__k"], "left").drop("__k")


def lookup_metrics(enriched: DataFrame, value: str) -> DataFrame:
    """Total, resolved, failed and the success rate in percent to one decimal (A5).

    An empty input gives a null rate instead of the reference's division by zero.
    """
    ok = F.count_if(_present(F.col(value)))
    total = F.count(F.lit(1))
    return enriched.agg(total.cast("long").alias("total"), ok.cast("long").alias("ok"),
                        (total - ok).cast("long").alias("failed"),
                        F.round(ok * 100.0 / F.nullif(total, F.lit(0)), 1).alias("success_rate"),
                        # Exact integer form of the rate, half-up, in tenths of a percent.
                        F.floor((ok * 2000 + total) / F.nullif(total * 2, F.lit(0))).cast("long")
                        .alias("success_tenths"))


def lookup_progress(enriched: DataFrame, by: Sequence[str], order: Sequence[str], ok: Column,
                    every: int = 10) -> DataFrame:
    """Running success/failure totals reported every ``every`` rows."""
    good = F.coalesce(ok, F.lit(False))  # an unknown outcome counts as a failure
    scanned = running_scan(enriched, by, order, ordinal="i",
                           sums={"ok": good.cast("long"), "failed": (~good).cast("long")})
    return scanned.filter(F.col("i") % every == 0)


def new_entries(fetched: DataFrame, existing: DataFrame, key: str, value: str) -> DataFrame:
    """Keys found now that the stored map lacks, with their identifier (K6); append these to the map table.

    A key found more than once takes its greatest identifier.
    """
    found = fetched.groupBy(key).agg(F.max(value).alias(value))
    return found.join(existing.select(key), key, "left_anti")


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in ``order`` (W6); the limit is the feature, planned as a top-k."""
    return df.orderBy(*order).limit(n)


def first_hit(hits: DataFrame, key: Sequence[str] | str, rank: Sequence[str] | str, value: str,
              out: str = "hit") -> DataFrame:
    """The best-ranked hit per key (L4), a mergeable ``min_by`` aggregate."""
    key = [key] if isinstance(key, str) else list(key)
    rank = [rank] if isinstance(rank, str) else list(rank)
    order = F.col(rank[0]) if len(rank) == 1 else F.struct(*rank)
    return hits.groupBy(*key).agg(F.min_by(F.col(value), order).alias(out))
