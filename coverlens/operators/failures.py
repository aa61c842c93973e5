"""Failure mining and run control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.functions.attempts import MAX_CONSECUTIVE_FAILURES, MAX_RETRIES, attempt_kind, chain_sql
from coverlens.functions.text import contains_all, py_strip, split_lines
from coverlens.operators.ordered import running_scan, top_k_per_group

# --- fixed values: the collector's failure line and the wrapper's auth check ------
FAILURE_MARKERS = ("❌ Failed to get data for", "Total failures:")
FAILURE_PATTERN = r"❌ Failed to get data for (.+?) in (\d+) \(Total failures: \d+, Consecutive: \d+\)"
AUTH_PATTERN = r"401|unauthorized|token.*expired|authentication.*failed"
# ------------------------------------------------------------------------------------
# Java flags for Python/grep semantics: (?d) '.' excludes only '\n'; (?U) '\d' is any
# Unicode digit as in Python 3; (?iu) Unicode case folding as in grep -i.
_PY_FLAGS = "(?dU)"


def scan_failure_lines(lines: DataFrame, value: str = "value", line_no: str = "line_no") -> DataFrame:
    """Lines that carry both failure markers, stripped, with the parse attempt.

    The substring test runs first (cheap), the regex only on its survivors.
    Columns: line_no, line, parsed, drug_name, zipcode.
    """
    pat = _PY_FLAGS + FAILURE_PATTERN
    hit = lines.filter(contains_all(value, list(FAILURE_MARKERS)))
    v = F.col(value)
    return hit.select(
        F.col(line_no).alias("line_no"),
        py_strip(v).alias("line"),
        v.rlike(pat).alias("parsed"),
        F.when(v.rlike(pat), py_strip(F.regexp_extract(v, pat, 1))).alias("drug_name"),
        F.when(v.rlike(pat), py_strip(F.regexp_extract(v, pat, 2))).alias("zipcode"),
    )


def failures(scanned: DataFrame) -> DataFrame:
    """Parsed (zip, drug) failures with their line numbers."""
    return scanned.filter("parsed").select("line_no", "zipcode", "drug_name")


def unparsed(scanned: DataFrame) -> DataFrame:
    """Dead letters: lines with the markers whose tail does not parse."""
    return scanned.filter(~F.col("parsed")).select("line_no", "line")


def failures_distinct(fails: DataFrame) -> DataFrame:
    """Distinct (zip, drug) pairs with the first line they occur on (T3); sort by it at the sink."""
    return fails.groupBy("zipcode", "drug_name").agg(F.min("line_no").alias("first_seen"))


def log_summary(scanned: DataFrame) -> DataFrame:
    """Matched lines, distinct pairs, zips and drugs (A10): per-pair counts, then one global aggregate."""
    per_pair = scanned.groupBy("parsed", "zipcode", "drug_name").agg(F.count(F.lit(1)).alias("__c"))
    p = F.col("parsed")
    return per_pair.agg(F.coalesce(F.sum("__c"), F.lit(0)).cast("long").alias("n_lines"),
                        F.count_if(p).cast("long").alias("n_pairs"),
                        F.count_distinct(F.when(p, F.col("zipcode"))).cast("long").alias("n_zip"),
                        F.count_distinct(F.when(p, F.col("drug_name"))).cast("long").alias("n_drug"))


def auth_line_hits(docs: DataFrame, text: str, by: Sequence[str], pattern: str = AUTH_PATTERN) -> DataFrame:
    """Lines matching the wrapper's case-insensitive auth check, counted per group (T4)."""
    line_pat = "(?iud)" + pattern
    docs = docs.select(*by, text)
    lines = docs.select(*by, F.explode(split_lines(F.col(text))).alias("__l"))
    return (lines.filter(F.col("__l").rlike(line_pat))
            .groupBy(*by).agg(F.count(F.lit(1)).cast("long").alias("n")))


def failure_streak(attempts: DataFrame, run: Sequence[str], order: Sequence[str], failed: Column,
                   out: str = "streak") -> DataFrame:
    """Consecutive failures up to each attempt, reset by any non-failure.

    streak = ordinal - ordinal of the last non-failure so far, both from one
    two-level ``running_scan`` (no single-run task).
    """
    s = running_scan(attempts, run, order, ordinal="__i", last_pos_where={"__g": ~F.coalesce(failed, F.lit(False))})
    return s.withColumn(out, (F.col("__i") - F.coalesce(F.col("__g"), F.lit(0))).cast("long")).drop("__g", "__i")


def auto_stop(attempts: DataFrame, run: Sequence[str], order: Sequence[str], failed: Column,
              limit: int = MAX_CONSECUTIVE_FAILURES) -> DataFrame:
    """Attempts that are made: up to and including the first one whose streak reaches ``limit``.

    The trip point is a per-run ``min`` (mergeable) joined back on the run key.
    """
    s = running_scan(attempts, run, order, ordinal="__i", last_pos_where={"__g": ~F.coalesce(failed, F.lit(False))})
    s = s.withColumn("__streak", F.col("__i") - F.coalesce(F.col("__g"), F.lit(0)))
    trip = s.filter(F.col("__streak") >= limit).groupBy(*run).agg(F.min("__i").alias("__trip"))
    t = trip.select(*[F.col(c).alias(f"__t_{c}") for c in run], "__trip")
    cond = None
    for c in run:
        e = F.col(c).eqNullSafe(F.col(f"__t_{c}"))
        cond = e if cond is None else cond & e
    joined = s.join(t, cond, "left")
    kept = joined.filter(F.col("__trip").isNull() | (F.col("__i") <= F.col("__trip")))
    return kept.drop("__g", "__i", "__streak", "__trip", *[f"__t_{c}" for c in run])


def recent_failures(attempts: DataFrame, run: Sequence[str], order: Sequence[str], failed: Column,
                    n: int = MAX_CONSECUTIVE_FAILURES) -> DataFrame:
    """The last ``n`` failures of each run (W4); a top-k in descending order."""
    return top_k_per_group(attempts.filter(F.coalesce(failed, F.lit(False))), run, order, n, descending=True)


def request_outcomes(attempts: DataFrame, request: Sequence[str], order: Sequence[str], status: str = "status", body: str = "body",
                     error: str = "error", refresh_ok: str = "refresh_ok", max_retries: int = MAX_RETRIES) -> DataFrame:
    """How each request went, from its recorded attempts in order (T5): outcome, attempts, refreshes, waited, actions.

    Only a request's first ``max_retries`` attempts can be made, so no more are gathered
    (``top_k_per_group``), however many are recorded under one key; they are folded by ``chain_sql``.
    """
    kinds = attempts.select(*request, *[c for c in order if c not in request],
                            attempt_kind(F.col(status), F.col(body), F.col(error)).alias("kind"), F.col(refresh_ok).alias("refresh_ok"))
    first = top_k_per_group(kinds, request, order, max_retries, rank_col="n")
    chains = first.groupBy(*request).agg(F.sort_array(F.collect_list(F.struct("n", "kind", "refresh_ok"))).alias("__a"))
    return chains.select(*request, F.expr(chain_sql("__a", max_retries)).alias("__s")).select(
        *request, *[F.col(f"__s.{c}").alias(c) for c in ("outcome", "attempts", "refreshes", "waited", "actions")])


def run_summary(attempts: DataFrame, run: Sequence[str], failed: Column) -> DataFrame:
    """Attempts and failures per run."""
    return attempts.groupBy(*run).agg(F.count(F.lit(1)).cast("long").alias("processed"),
                                      F.count_if(F.coalesce(failed, F.lit(False))).cast("long").alias("failed"))
