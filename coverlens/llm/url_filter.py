"""URL filters: host-suffix / path-prefix expressions matched on short hash prefixes.

A rule (host, path, verdict) fits the urls of its host and of all subdomains whose path
starts with the rule's path.  Every url is expanded into expressions ``host suffix + path
prefix``; an expression meets the rules by the first 4 bytes of its SHA-256 (a small join
key), the whole digest confirms the meeting, and the longest fitting rule decides.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.common import free_prefix, quoted

RULES: tuple[tuple[str, str, str], ...] = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Verdict of a url that no rule fits.
DEFAULT_VERDICT = "allow"
PREFIX_HEX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _digest(host: Column, path: Column) -> Column:
    # A host holds no "/", so the blank between host and path cannot move.
    return F.sha2(F.concat(host, F.lit(" "), path).cast("binary"), 256)


def filter_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """Every row of ``df`` with host, path, the deciding rule (null if none) and the verdict.

    Result columns are ``host, path, rule, verdict``; an input column of one of these names
    (whatever its case) is replaced, all others stay.  A null url, or one without ``://``,
    has an empty host and path and meets only a rule that has both empty.  Repeated rows
    stay repeated.  Of the rules that fit, the longest ``host + path`` wins; among equally
    long ones that with the longer host, then ``block``.  Rules with a null host, path or
    verdict fit nothing.  Rule hosts are folded like url hosts.  Empty tables give empty
    results (or, without rules, the default everywhere).

    Expansion takes the path lengths that occur among the rules of a host suffix, so an
    expression exists only where a rule could.  Distinct (host, path) pairs are judged once,
    which takes a hot url out of the matching; the rules are small next to the urls, but
    nothing depends on it: Spark broadcasts them when they are small and sorts both sides
    otherwise, splitting hot keys.
    """
    out = ("host", "path", "rule", "verdict")
    url = quoted(url_col)
    key = free_prefix(df.columns, "url_key_")
    rest = [quoted(c) for c in df.columns if c.lower() not in out]
    rows = df.select(*rest, url_host(url).alias("host"), url_path(url).alias("path"))
    known = (rules.select(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"),
                          F.col("verdict").alias("r_verdict"))
             .dropna().distinct())
    # One row per rule host: the path lengths to cut expressions at.
    hosts = (known.groupBy("r_host").agg(F.sort_array(F.collect_set(F.length("r_path"))).alias("cuts"))
             .withColumn("h_digest", F.sha2(F.col("r_host").cast("binary"), 256))
             .withColumn("h_prefix", F.substring("h_digest", 1, PREFIX_HEX)))
    ruled = (known.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
             .withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_HEX)))

    pairs = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_host = (pairs.select("host", "path", F.explode(F.array_distinct(suffixes)).alias("suffix"))
               .withColumn("digest", F.sha2(F.col("suffix").cast("binary"), 256))
               .withColumn("h_prefix", F.substring("digest", 1, PREFIX_HEX))
               .join(hosts, "h_prefix").filter("digest = h_digest"))
    expressions = (by_host.select("host", "path", "suffix", F.explode("cuts").alias("cut"))
                   .filter(F.col("cut") <= F.length("path"))
                   .withColumn("digest", _digest(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("cut"))))
                   .withColumn("r_prefix", F.substring("digest", 1, PREFIX_HEX)))
    rule_text = F.concat("r_host", "r_path")
    rank = F.struct(F.length(rule_text).alias("a"), F.length("r_host").alias("b"),
                    (F.col("r_verdict") == "block").alias("c"), rule_text.alias("rule"), F.col("r_verdict").alias("v"))
    best = (expressions.join(ruled, "r_prefix").filter("digest = r_digest")
            .groupBy("host", "path").agg(F.max(rank).alias(key))
            .select(F.col("host").alias(f"{key}host"), F.col("path").alias(f"{key}path"), key))
    joined = rows.join(best, (rows["host"] == best[f"{key}host"]) & (rows["path"] == best[f"{key}path"]), "left")
    return joined.select(*rest, rows["host"], rows["path"], F.col(f"{key}.rule").alias("rule"),
                         F.coalesce(F.col(f"{key}.v"), F.lit(default)).alias("verdict"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, rules_frame(spark)).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path, row_number() OVER () AS n
  FROM pages),
r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                      ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (
  SELECT p.n, r.h || r.p AS rule, r.v,
         row_number() OVER (PARTITION BY p.n ORDER BY length(r.h || r.p) DESC, length(r.h) DESC, r.v DESC) AS k
  FROM p JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM p LEFT JOIN m ON m.n = p.n AND m.k = 1
"""
