"""Bindings of the operators to the driver's tables, each with its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them); limits appear only
where they are the feature (previews, last-N reports).  Counters are BIGINT on both
sides; computed columns carry the same alias in Spark and SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.functions.attempts import attempt_action
from coverlens.functions.codes import padded_code
from coverlens.functions.keys import combination_key, source_tag
from coverlens.functions.location import city_from_display
from coverlens.functions.numeric import to_number
from coverlens.functions.text import PY_WHITESPACE, clean_lines
from coverlens.operators import catalog as cat
from coverlens.operators import coverage as cov
from coverlens.operators import failures as fl
from coverlens.operators import geography as geo
from coverlens.operators import matching as mt
from coverlens.operators import planning as pl
from coverlens.operators import responses as rs
from coverlens.plans import typed
from coverlens.plans.tables import Tables, attempts, failure_log, landed_responses, line_plan, line_responses, order_plan, request_attempts
from coverlens.schemas import OPTION_FIELDS
from coverlens.session import work_dir
from coverlens.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


_WS_SQL = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)
_LINES_SQL = r"regexp_split_to_array(regexp_replace({t}, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')"

# ---------------------------------------------------------------- S1 list reading
@register("list_clean", f"""
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines
FROM (SELECT doc_id, unnest({_LINES_SQL.format(t='text')}) AS line FROM documents)
WHERE trim(line, {_WS_SQL}) <> '' GROUP BY doc_id""")
def q_list_clean(spark, sf):
    d = Tables(spark, sf)("documents").select("doc_id", "text")
    return (d.select("doc_id", F.size(clean_lines("text")).cast("long").alias("n_lines"))
            .filter(F.col("n_lines") > 0))


# ---------------------------------------------------------------- W1, W5, P6
@register("batch_slice", """
SELECT c_mktsegment, c_custkey, CAST(ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS BIGINT) AS batch_num
FROM customer""")
def q_batch_slice(spark, sf):
    c = Tables(spark, sf)("customer").select("c_mktsegment", "c_custkey")
    return geo.assign_batches(c, ["c_mktsegment"], ["c_custkey"], 4)


@register("batch_one", """
SELECT c_mktsegment, c_custkey, c_acctbal FROM (
  SELECT *, ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal NULLS FIRST, c_custkey) AS b FROM customer) WHERE b = 3""")
def q_batch_one(spark, sf):
    """One batch of each segment by balance: its two end keys are selected, the rest is a filter."""
    c = Tables(spark, sf)("customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return geo.batch_slice(c, ["c_mktsegment"], ["c_acctbal", "c_custkey"], batch_num=3, total_batches=4)


@register("batch_preview", """
SELECT c_mktsegment, c_custkey FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS rn FROM (
    SELECT c_mktsegment, c_custkey, ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS b FROM customer)
  WHERE b = 2) WHERE rn <= 2""")
def q_batch_preview(spark, sf):
    c = Tables(spark, sf)("customer").select("c_mktsegment", "c_custkey")
    return geo.batch_slice(c, ["c_mktsegment"], ["c_custkey"], batch_num=2, total_batches=4, preview=2)


@register("state_filter", """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer
WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') GROUP BY 1""")
def q_state_filter(spark, sf):
    c = Tables(spark, sf)("customer")
    return (geo.filter_states(c, ["HOUSEHOLD", "MACHINERY"], "c_mktsegment")
            .groupBy("c_mktsegment").agg(F.count(F.lit(1)).cast("long").alias("n")))


# ---------------------------------------------------------------- catalogue: W6, J1, J2, A5, A6, A12, K6, L4
_MAP_SQL = """WITH m AS (SELECT l_partkey AS k,
  CASE WHEN min(l_suppkey) % 7 = 0 THEN '' ELSE CAST(min(l_suppkey) AS VARCHAR) END AS ref
  FROM lineitem WHERE l_quantity >= 49 GROUP BY 1)"""


def _uuid_map(t: Tables) -> DataFrame:
    """A code -> identifier map derived from lineitem; some identifiers are empty."""
    li = t("lineitem").filter(F.col("l_quantity") >= 49)
    m = li.groupBy(F.col("l_partkey").alias("k")).agg(F.min("l_suppkey").alias("s"))
    return m.select("k", F.when(F.col("s") % 7 == 0, F.lit("")).otherwise(F.col("s").cast("string")).alias("ref"))


@register("catalog_preview", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 10")
def q_catalog_preview(spark, sf):
    return cat.preview(Tables(spark, sf)("part").select("p_partkey", "p_name"), ["p_partkey"], 10)


@register("catalog_resolved", _MAP_SQL + """
SELECT p_partkey, p_name, ref FROM part JOIN m ON p_partkey = k WHERE ref <> ''""")
def q_catalog_resolved(spark, sf):
    t = Tables(spark, sf)
    return cat.resolve(t("part").select("p_partkey", "p_name"), "p_partkey", _uuid_map(t), "k", "ref")


@register("catalog_rejects", _MAP_SQL + """
SELECT p_partkey, p_brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS BIGINT) AS n
FROM part WHERE NOT EXISTS (SELECT 1 FROM m WHERE k = p_partkey AND ref <> '')""")
def q_catalog_rejects(spark, sf):
    t = Tables(spark, sf)
    rej = cat.rejects(t("part").select("p_partkey", "p_brand"), "p_partkey", _uuid_map(t), "k", "ref")
    return cat.number_rows(rej, ["p_brand"], ["p_partkey"], "n")


@register("catalog_enriched", _MAP_SQL + """
SELECT p_partkey, p_name, ref FROM part LEFT JOIN m ON p_partkey = k""")
def q_catalog_enriched(spark, sf):
    t = Tables(spark, sf)
    return cat.enrich(t("part").select("p_partkey", "p_name"), "p_partkey", _uuid_map(t), "k", "ref")


@register("lookup_metrics", _MAP_SQL + """
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE ref <> '') AS BIGINT) AS ok,
  CAST(count(*) - count(*) FILTER (WHERE ref <> '') AS BIGINT) AS failed,
  CAST((2000 * count(*) FILTER (WHERE ref <> '') + count(*)) // (2 * count(*)) AS BIGINT) AS success_tenths
FROM part LEFT JOIN m ON p_partkey = k""")
def q_lookup_metrics(spark, sf):
    t = Tables(spark, sf)
    e = cat.enrich(t("part").select("p_partkey"), "p_partkey", _uuid_map(t), "k", "ref")
    return cat.lookup_metrics(e, "ref").select("total", "ok", "failed", "success_tenths")


@register("lookup_progress", """
SELECT * FROM (SELECT p_brand, CAST(row_number() OVER w AS BIGINT) AS i,
  CAST(sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS ok,
  CAST(sum(CASE WHEN p_size > 25 THEN 0 ELSE 1 END) OVER w AS BIGINT) AS failed FROM part
  WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING)) WHERE i % 10 = 0""")
def q_lookup_progress(spark, sf):
    p = Tables(spark, sf)("part").select("p_brand", "p_partkey", "p_size")
    return (cat.lookup_progress(p, ["p_brand"], ["p_partkey"], F.col("p_size") > 25, every=10)
            .select("p_brand", "i", "ok", "failed"))


@register("map_upsert", """
SELECT l_partkey, max(l_suppkey) AS ref FROM lineitem a
WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_quantity < 5 AND b.l_partkey = a.l_partkey) GROUP BY 1""")
def q_map_upsert(spark, sf):
    li = Tables(spark, sf)("lineitem")
    found = li.select("l_partkey", F.col("l_suppkey").alias("ref"))
    return cat.new_entries(found, li.filter(F.col("l_quantity") < 5), "l_partkey", "ref")


@register("map_persist", """
WITH a AS (SELECT l_partkey AS k, max(l_suppkey) AS ref FROM lineitem WHERE l_quantity < 10 GROUP BY 1),
b AS (SELECT l_partkey AS k, max(l_suppkey) AS ref FROM lineitem GROUP BY 1),
m AS (SELECT b.k, CASE WHEN coalesce(a.ref, 0) % 3 > 0 THEN a.ref ELSE b.ref END AS ref FROM b LEFT JOIN a USING (k))
SELECT p_partkey, p_name, CAST(ref AS VARCHAR) AS ref FROM part JOIN m ON k = p_partkey WHERE ref % 3 > 0""")
def q_map_persist(spark, sf):
    """Found identifiers are kept over runs, the second run repeated, and resolve the catalogue from the stored map."""
    t = Tables(spark, sf)
    li = t("lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    path = work_dir(spark, "map")
    for rows in (li.filter("l_quantity < 10"), li, li):
        ref = rows.groupBy(F.col("l_partkey").alias("k")).agg(F.max("l_suppkey").alias("s"))
        found = ref.select("k", F.when(F.col("s") % 3 == 0, F.lit("")).otherwise(F.col("s").cast("string")).alias("ref"))
        sinks.upsert_map(found, path, "k", "ref")
    return cat.resolve(t("part").select("p_partkey", "p_name"), "p_partkey", readers.read_map(spark, path), "k", "ref")


@register("first_hit", "SELECT user_id, arg_min(event_type, event_id) AS hit FROM events GROUP BY user_id")
def q_first_hit(spark, sf):
    return cat.first_hit(Tables(spark, sf)("events"), "user_id", "event_id", "event_type", "hit")


# ---------------------------------------------------------------- locations: J3, P7, P8
_GEO_SQL = """WITH g AS (SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN '' ELSE n_name END AS city,
  'R' || n_regionkey AS state FROM nation WHERE n_nationkey <> 3)"""


def _geocodes(t: Tables) -> DataFrame:
    n = t("nation").filter(F.col("n_nationkey") != 3)
    return n.select(F.col("n_nationkey").alias("nk"),
                    F.when(F.col("n_regionkey") == 0, F.lit("")).otherwise(F.col("n_name")).alias("city"),
                    F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("state"))


@register("locate", _GEO_SQL + """
SELECT s_suppkey, coalesce(nullif(city, ''), state || '_City') AS city FROM supplier JOIN g ON s_nationkey = n_nationkey""")
def q_locate(spark, sf):
    t = Tables(spark, sf)
    s = t("supplier").select("s_suppkey", F.col("s_nationkey").alias("nk"))
    return geo.locate(s, _geocodes(t), ["nk"]).select("s_suppkey", "city")


@register("locate_rejects", _GEO_SQL + """
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM g WHERE n_nationkey = c_nationkey)""")
def q_locate_rejects(spark, sf):
    t = Tables(spark, sf)
    c = t("customer").select("c_custkey", F.col("c_nationkey").alias("nk"))
    return geo.locate_rejects(c, _geocodes(t), ["nk"]).select("c_custkey")


_DISPLAY_SQL = """CASE p_size % 5 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || ', ' || p_type
  WHEN 2 THEN p_brand || ', ' || p_brand || ', ' || p_name WHEN 3 THEN p_brand || ', ' || p_brand
  ELSE p_name || ', ' || p_type || ', ' || p_brand END"""


@register("city_parse", f"""
SELECT p_partkey, CASE WHEN len(a) > 1 THEN CASE WHEN a[2] <> p_brand THEN a[2] WHEN len(a) > 2 THEN a[3] ELSE '' END
  ELSE '' END AS city FROM (SELECT p_partkey, p_brand, string_split({_DISPLAY_SQL}, ', ') AS a FROM part)""")
def q_city_parse(spark, sf):
    p = Tables(spark, sf)("part")
    b, ty, nm = F.col("p_brand"), F.col("p_type"), F.col("p_name")
    sep = F.lit(", ")
    m = F.col("p_size") % 5
    display = (F.when(m == 0, b).when(m == 1, F.concat(b, sep, ty)).when(m == 2, F.concat(b, sep, b, sep, nm))
               .when(m == 3, F.concat(b, sep, b)).otherwise(F.concat(nm, sep, ty, sep, b)))
    return p.select("p_partkey", city_from_display(display, b).alias("city"))


# ---------------------------------------------------------------- planning: J4, J5, W7, W8, A7, P9, P10
def _grid(t: Tables) -> DataFrame:
    parts = t("part").select("p_partkey")
    nations = t("nation").select("n_nationkey")
    return pl.plan_grid(parts, ["p_partkey"], nations, ["n_nationkey"])


@register("plan_combinations", """
SELECT p_partkey, n_nationkey, p_partkey || '_' || n_nationkey AS combination_key FROM part CROSS JOIN nation""")
def q_plan_combinations(spark, sf):
    g = _grid(Tables(spark, sf))
    return g.select("p_partkey", "n_nationkey",
                    combination_key(F.col("p_partkey"), F.col("n_nationkey")).alias("combination_key"))


@register("plan_remaining", """
SELECT p_partkey, n_nationkey FROM part CROSS JOIN nation WHERE NOT EXISTS (
  SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_partkey = p_partkey AND s_nationkey = n_nationkey)""")
def q_plan_remaining(spark, sf):
    t = Tables(spark, sf)
    ledger = (t("lineitem").select("l_partkey", "l_suppkey")
              .join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
              .select(F.col("l_partkey").alias("p_partkey"), F.col("s_nationkey").cast("int").alias("n_nationkey")))
    grid = pl.plan_grid(t("part").select("p_partkey"), ["p_partkey"], t("nation").select("n_nationkey"), ["n_nationkey"],
                        done=ledger, done_on=("p_partkey", "n_nationkey"))
    return grid.select("p_partkey", "n_nationkey")


@register("plan_order", """
SELECT p_partkey, n_nationkey, CAST(row_number() OVER (ORDER BY p_partkey, n_nationkey) AS BIGINT) AS pos
FROM part CROSS JOIN nation""")
def q_plan_order(spark, sf):
    return _grid(Tables(spark, sf)).select("p_partkey", "n_nationkey", F.col("position").alias("pos"))


@register("plan_first_wins", """
SELECT CAST(user_id AS VARCHAR) || '_' || event_type AS combination_key, min(event_id) AS event_id FROM events GROUP BY 1""")
def q_plan_first_wins(spark, sf):
    e = Tables(spark, sf)("events").select(
        combination_key(F.col("user_id"), F.col("event_type")).alias("combination_key"), "event_id")
    return pl.first_wins(e, "combination_key", "event_id")


@register("plan_summary", """
SELECT s_nationkey, CAST(count(*) * (SELECT count(*) FROM part) AS BIGINT) AS combinations,
  CAST(count(*) * (SELECT count(*) FROM part) * 4 AS BIGINT) AS est_tenths FROM supplier GROUP BY 1""")
def q_plan_summary(spark, sf):
    t = Tables(spark, sf)
    n_catalog = t("part").count()
    return pl.plan_summary(t("supplier"), ["s_nationkey"], n_catalog)


@register("request_manifest", """
SELECT p_partkey AS uuid, CAST(p_size AS VARCHAR) AS zipCode, CAST(p_size AS VARCHAR) AS locationLat, CAST(-p_partkey AS VARCHAR) AS locationLong,
  coalesce(nullif(lower(CASE WHEN p_size = 1 THEN '' ELSE p_name END), ''), 'prescription') AS searchedQuery,
  substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-'
    || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS intentCallId
FROM (SELECT *, sha256('run7' || chr(1) || p_partkey) AS h FROM part)""")
def q_request_manifest(spark, sf):
    p = Tables(spark, sf)("part").select("p_partkey", "p_size", (-F.col("p_partkey")).alias("lng"),
                                         F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.col("p_name")).alias("name"))
    return pl.request_rows(p, uuid="p_partkey", zip_code="p_size", lat="p_size", lng="lng", name="name",
                           call=pl.call_id(F.lit("run7"), F.col("p_partkey").cast("string")))


# ---------------------------------------------------------------- responses: X1-X5, P4, P13, A8
_RESP_SQL = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS zip_code, o_orderstatus AS api_drug_title,
  'S' || l_suppkey AS pharmacy_name, CAST(l_linenumber AS VARCHAR) AS pharmacy_gsn, l_quantity AS pharmacy_qty,
  l_extendedprice AS provider_price, l_discount AS estimated_member_responsibility
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, 'P' || l_partkey, '', l_quantity, 0.0, 0.0
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""

_RESP_COLS = ["zip_code", "api_drug_title", "pharmacy_name", "pharmacy_gsn", "pharmacy_qty", "provider_price",
              "estimated_member_responsibility"]


def response_rows_df(spark: SparkSession, sf: str, responses: DataFrame | None = None) -> DataFrame:
    t = Tables(spark, sf)
    resp = responses if responses is not None else landed_responses(t)
    fact = rs.extract_prices(resp, order_plan(t), key="o_orderkey", ingest_ts=F.lit("2024-01-01 00:00:00"))
    return fact.select(F.col("procedure_code").cast("long").alias("o_orderkey"), *_RESP_COLS)


@register("response_rows", _RESP_SQL)
def q_response_rows(spark, sf):
    return response_rows_df(spark, sf)


@register("response_defaults", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(0 AS BIGINT) AS z FROM events""")
def q_response_defaults(spark, sf):
    e = rs.parsed_once(Tables(spark, sf)("events"), ["event_id"], "props")
    return e.selectExpr("event_id", *[f"CAST({rs.leaf_sql('dbl', rs.field_sql('r', k))} AS BIGINT) AS {k}" for k in ("k", "z")])


@register("response_nulls", """
SELECT CAST(l_suppkey AS VARCHAR) AS zip_code, CAST(l_partkey AS VARCHAR) AS procedure_code,
  CAST(l_partkey AS VARCHAR) AS drug_name FROM lineitem GROUP BY l_suppkey, l_partkey
HAVING NOT bool_or(CASE l_linenumber % 3 WHEN 0 THEN false WHEN 1 THEN true ELSE l_discount <= 0 END)""")
def q_response_nulls(spark, sf):
    """Groups without a favourable offer, where every third estimate is an explicit null and every third is absent."""
    fact = rs.extract_prices(line_responses(Tables(spark, sf)), line_plan(Tables(spark, sf)), key="line_key",
                             ingest_ts=F.lit("2024-01-01 00:00:00"))
    return cov.no_favorable(fact, ["zip_code", "procedure_code"], "estimated_member_responsibility", ["drug_name"], "pharmacy_gsn")


@register("response_yield", """
SELECT o_orderkey, CAST(2 * count(l_orderkey) AS BIGINT) AS n_rows FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY 1""")
def q_response_yield(spark, sf):
    return rs.response_yield(landed_responses(Tables(spark, sf)), key="o_orderkey")


@register("option_values", """
SELECT l_orderkey AS o_orderkey, CAST(l_linenumber AS VARCHAR) AS qty, l_returnflag AS label,
  l_linestatus = 'F' AS selected, CAST(l_partkey AS VARCHAR) AS gsn FROM lineitem""")
def q_option_values(spark, sf):
    o = rs.option_rows(landed_responses(Tables(spark, sf)), "form", key="o_orderkey")
    return o.select("o_orderkey", "qty", "label", "selected", "gsn")


@register("option_json", """
SELECT l_orderkey AS o_orderkey, '[{"label":"' || l_returnflag || '","selected":' || CASE WHEN l_linestatus = 'F'
  THEN 'true' ELSE 'false' END || ',"gsn":"' || l_partkey || '","strength":"","qty":"' || l_linenumber
  || '","branded_or_generic_id":""}]' AS form_options FROM lineitem""")
def q_option_json(spark, sf):
    parsed = rs.parsed_once(landed_responses(Tables(spark, sf)), ["o_orderkey"], "body")
    return (parsed.filter(F.expr(f"size({rs.elements_sql('r', 'pharmacies')}) > 0"))
            .selectExpr("o_orderkey", f"{rs.json_sql(rs.options_sql('r', 'form'))} AS form_options"))


@register("response_columns", typed.fact_sql())
def q_response_columns(spark, sf):
    """All 85 columns where every field comes as text, another type, null and not at all."""
    t = Tables(spark, sf)
    fact = rs.extract_prices(typed.typed_responses(t), order_plan(t), key="o_orderkey", ingest_ts=F.lit("2024-01-01 00:00:00"),
                             position="pharmacy_pos")
    return fact.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@register("option_typed", typed.option_values_sql())
def q_option_typed(spark, sf):
    """Values of all four option arrays with the type that they came with."""
    rows = rs.option_rows(typed.typed_responses(Tables(spark, sf)), list(OPTION_FIELDS), key="o_orderkey", typed=True)
    return rows.select("o_orderkey", "kind", "option_pos", *[typed.variant_text(c) for c in ("label", "selected", "branded_or_generic_id")])


# ---------------------------------------------------------------- coverage: P2, P3, A1-A4
@register("coerce_numeric", """
SELECT event_id, CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'purchase' THEN NULL
  ELSE value END AS v FROM events""")
def q_coerce_numeric(spark, sf):
    e = Tables(spark, sf)("events")
    txt = (F.when(F.col("event_type") == "click", F.col("props"))
           .when(F.col("event_type") == "purchase", F.concat(F.col("value").cast("string"), F.lit("d")))
           .when(F.col("event_type") == "signup", F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
           .otherwise(F.col("value").cast("string")))
    return e.select("event_id", to_number(txt).alias("v"))


@register("unfavorable_groups", """
SELECT user_id, event_type, arg_min(props, event_id) AS props FROM events GROUP BY 1, 2
HAVING NOT bool_or(coalesce(value <= 1, false))""")
def q_unfavorable_groups(spark, sf):
    e = Tables(spark, sf)("events")
    return cov.no_favorable(e, ["user_id", "event_type"], "value", ["props"], "event_id", threshold=1.0)


_UNFAV_LI = """SELECT l_suppkey, l_partkey, arg_min(l_returnflag, (l_orderkey, l_linenumber, l_returnflag)) AS l_returnflag
FROM lineitem GROUP BY 1, 2 HAVING NOT bool_or(coalesce(l_discount <= 0, false))"""


def unfavorable_lineitem_df(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf)("lineitem")
    return cov.no_favorable(li, ["l_suppkey", "l_partkey"], "l_discount", ["l_returnflag"],
                            ["l_orderkey", "l_linenumber", "l_returnflag"])


@register("unfavorable_lineitem", _UNFAV_LI)
def q_unfavorable_lineitem(spark, sf):
    return unfavorable_lineitem_df(spark, sf)


@register("unfavorable_summary", f"""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS n_l_suppkey,
  CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_l_partkey FROM ({_UNFAV_LI})""")
def q_unfavorable_summary(spark, sf):
    return cov.no_favorable_summary(unfavorable_lineitem_df(spark, sf), ["l_suppkey", "l_partkey"])


@register("required_columns", "SELECT l_suppkey, l_partkey, l_discount, l_returnflag FROM lineitem")
def q_required_columns(spark, sf):
    li = Tables(spark, sf)("lineitem")
    cols = ["l_suppkey", "l_partkey", "l_discount", "l_returnflag"]
    return cov.require_columns(li, cols).select(*cols)


@register("pair_coverage_by_source", """
SELECT l_returnflag AS source, CAST(count(*) AS BIGINT) AS n_pairs
FROM (SELECT DISTINCT l_returnflag, l_suppkey, l_partkey FROM lineitem) GROUP BY 1""")
def q_pair_coverage_by_source(spark, sf):
    li = Tables(spark, sf)("lineitem").withColumnRenamed("l_returnflag", "source")
    return cov.pair_coverage_by_source(li, ["l_suppkey", "l_partkey"], "source")


@register("pair_coverage", """
SELECT CAST(count(*) AS BIGINT) AS pairs, CAST(count(DISTINCT a) AS BIGINT) AS n_a, CAST(count(DISTINCT b) AS BIGINT) AS n_b
FROM (SELECT l_suppkey AS a, l_returnflag AS b FROM lineitem UNION SELECT s_suppkey, 'X' FROM supplier)""")
def q_pair_coverage(spark, sf):
    t = Tables(spark, sf)
    a = t("lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_returnflag").alias("b"))
    b = t("supplier").select(F.col("s_suppkey").alias("a"), F.lit("X").alias("b"))
    return cov.pair_coverage([a, b], ["a", "b"])


# ---------------------------------------------------------------- matching: U3, J6, J7, A11, P5
@register("code_intersection", """
SELECT CAST(l_partkey AS VARCHAR) AS code FROM lineitem WHERE l_quantity >= 49
INTERSECT SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 25""")
def q_code_intersection(spark, sf):
    t = Tables(spark, sf)
    return mt.code_intersection(t("lineitem").filter(F.col("l_quantity") >= 49), "l_partkey",
                                t("part").filter(F.col("p_size") > 25), "p_partkey")


@register("code_match", """
SELECT CAST(user_id AS VARCHAR) AS code, value, price FROM (SELECT user_id, arg_min(value, event_id) AS value FROM events GROUP BY 1)
JOIN (SELECT o_custkey, arg_min(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1) ON o_custkey = user_id""")
def q_code_match(spark, sf):
    t = Tables(spark, sf)
    # The right side carries codes zero-padded to 11 digits, the left side stripped (P5).
    orders = t("orders").withColumn("code11", padded_code("o_custkey"))
    return mt.match_codes(t("events"), "user_id", {"value": "value"}, ["event_id"],
                          orders, "code11", {"price": "o_totalprice"}, ["o_orderkey"])


@register("code_match_summary", """
SELECT CAST((SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_quantity >= 49) AS BIGINT) AS n_left,
  CAST((SELECT count(DISTINCT p_partkey) FROM part WHERE p_size > 25) AS BIGINT) AS n_right,
  CAST((SELECT count(DISTINCT p_partkey) FROM part WHERE p_size > 25
        AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)) AS BIGINT) AS n_both""")
def q_code_match_summary(spark, sf):
    t = Tables(spark, sf)
    return mt.code_match_summary(t("lineitem").filter(F.col("l_quantity") >= 49), "l_partkey",
                                 t("part").filter(F.col("p_size") > 25), "p_partkey")


# ---------------------------------------------------------------- failure log: T1-T4, A10
_NAME_SQL = """CASE event_type WHEN 'click' THEN 'click (' || props || ')' WHEN 'purchase' THEN 'purchase in store'
  ELSE event_type END"""
_LINE_SQL = f"""CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) || ' - ERROR - {fl.FAILURE_MARKERS[0]} '
  || event_type || ' in ' || CAST(user_id AS VARCHAR) || ' ({fl.FAILURE_MARKERS[1]} ' || CAST(event_id AS VARCHAR) || ')'
  ELSE CAST(event_id AS VARCHAR) || ' - ERROR - {fl.FAILURE_MARKERS[0]} ' || CASE event_type WHEN 'click'
  THEN 'click (' || props || ')' WHEN 'purchase' THEN 'purchase in store' ELSE '  ' || event_type || '  ' END
  || ' in ' || CAST(user_id AS VARCHAR) || ' ({fl.FAILURE_MARKERS[1]} ' || CAST(event_id AS VARCHAR) || ', Consecutive: '
  || CAST(event_id % 10 AS VARCHAR) || ')' END"""


def _scanned(spark, sf):
    return fl.scan_failure_lines(failure_log(Tables(spark, sf)), "value", "line_no")


@register("log_failures", f"""
SELECT event_id AS line_no, CAST(user_id AS VARCHAR) AS zipcode, {_NAME_SQL} AS drug_name
FROM events WHERE event_type NOT IN ('signup', 'view')""")
def q_log_failures(spark, sf):
    return fl.failures(_scanned(spark, sf))


@register("log_raw_matches", f"SELECT event_id AS line_no, {_LINE_SQL} AS line FROM events WHERE event_type <> 'view'")
def q_log_raw_matches(spark, sf):
    return _scanned(spark, sf).select("line_no", "line")


@register("log_unparsed", f"SELECT event_id AS line_no, {_LINE_SQL} AS line FROM events WHERE event_type = 'signup'")
def q_log_unparsed(spark, sf):
    return fl.unparsed(_scanned(spark, sf))


@register("log_failures_distinct", f"""
SELECT CAST(user_id AS VARCHAR) AS zipcode, {_NAME_SQL} AS drug_name, min(event_id) AS first_seen
FROM events WHERE event_type NOT IN ('signup', 'view') GROUP BY 1, 2""")
def q_log_failures_distinct(spark, sf):
    return fl.failures_distinct(fl.failures(_scanned(spark, sf)))


@register("log_summary", f"""
SELECT CAST((SELECT count(*) FROM events WHERE event_type <> 'view') AS BIGINT) AS n_lines,
  CAST(count(*) AS BIGINT) AS n_pairs, CAST(count(DISTINCT z) AS BIGINT) AS n_zip, CAST(count(DISTINCT d) AS BIGINT) AS n_drug
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS z, {_NAME_SQL} AS d FROM events WHERE event_type NOT IN ('signup', 'view'))""")
def q_log_summary(spark, sf):
    return fl.log_summary(_scanned(spark, sf))


_ATTEMPT_LOG_SQL = """SELECT user_id, CAST(event_id AS VARCHAR) || ' - HTTP ' || coalesce(CAST(CASE event_type WHEN 'view' THEN 200
  WHEN 'signup' THEN 401 WHEN 'error' THEN 429 WHEN 'click' THEN 500 END AS VARCHAR), 'timeout') || ' - '
  || CASE WHEN value > 25 THEN 'Token expired: ' || props ELSE props END AS line FROM events"""


@register("log_auth_hits", f"""
SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM ({_ATTEMPT_LOG_SQL})
WHERE regexp_matches(line, '(?i){fl.AUTH_PATTERN}') GROUP BY 1""")
def q_log_auth_hits(spark, sf):
    a = attempts(Tables(spark, sf))
    line = F.concat(F.col("event_id").cast("string"), F.lit(" - HTTP "),
                    F.coalesce(F.col("status").cast("string"), F.lit("timeout")), F.lit(" - "), F.col("body"))
    return fl.auth_line_hits(a.select("user_id", line.alias("line")), "line", ["user_id"])


@register("attempt_action", """
WITH a AS (SELECT event_id,
  CASE event_type WHEN 'view' THEN 200 WHEN 'signup' THEN 401 WHEN 'error' THEN 429 WHEN 'click' THEN 500 END AS status,
  CASE WHEN value > 25 THEN 'Token expired: ' || props ELSE props END AS body,
  event_id % 3 + 1 AS attempt_no, value < 10 AS refreshed FROM events),
b AS (SELECT event_id, attempt_no, CASE
  WHEN status = 200 THEN 'ok'
  WHEN status IN (401, 403) THEN CASE WHEN refreshed THEN 'fail' ELSE 'refresh_retry' END
  WHEN status = 429 THEN 'backoff_retry'
  WHEN status IS NOT NULL THEN CASE WHEN (contains(lower(body), 'token') OR contains(lower(body), 'unauthorized'))
    AND NOT refreshed THEN 'refresh_retry' ELSE 'retry' END
  ELSE CASE WHEN attempt_no = 1 AND NOT refreshed THEN 'refresh_retry' ELSE 'retry' END END AS action FROM a)
SELECT event_id, CASE WHEN suffix(action, 'retry') AND attempt_no >= 3 THEN 'give_up' ELSE action END AS action FROM b""")
def q_attempt_action(spark, sf):
    a = attempts(Tables(spark, sf))
    return a.select("event_id", attempt_action(F.col("status"), F.col("body"), F.col("error"),
                                               F.col("attempt_no"), F.col("refreshed")).alias("action"))


@register("attempt_chain", """
WITH RECURSIVE a AS (SELECT event_id // 4 AS request_id, row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id) AS n,
  CASE event_type WHEN 'view' THEN 'ok' WHEN 'signup' THEN 'auth' WHEN 'error' THEN 'limit'
    WHEN 'click' THEN CASE WHEN value > 25 OR contains(lower(props), 'token') OR contains(lower(props), 'unauthorized') THEN 'token' ELSE 'other' END
    ELSE CASE event_id % 3 WHEN 0 THEN 'denied' WHEN 1 THEN 'timeout' ELSE 'broken' END END AS kind,
  CASE WHEN event_id % 7 < 4 OR event_id % 7 = 6 THEN true ELSE false END AS works FROM events),
st AS (
  SELECT request_id, 0 AS n, 'open' AS outcome, false AS refreshed, CAST(0 AS BIGINT) AS attempts, CAST(0 AS BIGINT) AS refreshes,
         CAST(0 AS BIGINT) AS waited, '' AS actions FROM a GROUP BY 1
  UNION ALL
  SELECT request_id, n,
    CASE WHEN kind = 'ok' THEN 'ok' WHEN kind = 'auth' AND NOT fresh THEN 'failed' WHEN n = 3 THEN 'failed' ELSE 'open' END,
    refreshed OR fresh, attempts + 1, refreshes + CASE WHEN fresh THEN 1 ELSE 0 END,
    waited + CASE WHEN kind = 'ok' OR fresh OR kind = 'auth' THEN 0 WHEN kind = 'limit' THEN 40 WHEN n < 3 THEN 20 ELSE 0 END,
    actions || CASE WHEN n = 1 THEN '' ELSE ' ' END || CASE WHEN kind = 'ok' THEN 'ok' WHEN fresh THEN 'refresh_retry'
      WHEN kind = 'auth' THEN CASE WHEN refreshed THEN 'fail' ELSE 'refresh_failed' END WHEN kind = 'limit' THEN 'backoff_retry' ELSE 'retry' END
  FROM (SELECT st.request_id, a.n, a.kind, st.refreshed, st.attempts, st.refreshes, st.waited, st.actions,
               NOT st.refreshed AND a.works AND (a.kind IN ('auth', 'token', 'denied') OR (a.kind = 'timeout' AND a.n = 1)) AS fresh
        FROM st JOIN a ON a.request_id = st.request_id AND a.n = st.n + 1 WHERE st.outcome = 'open' AND st.n < 3))
SELECT request_id, arg_max(outcome, n) AS outcome, max(attempts) AS attempts, max(refreshes) AS refreshes, max(waited) AS waited,
  arg_max(actions, n) AS actions FROM st GROUP BY request_id""")
def q_attempt_chain(spark, sf):
    """Whole requests: what came of each, over its attempts, refreshes and waits (T5)."""
    done = fl.request_outcomes(request_attempts(Tables(spark, sf)), ["request_id"], ["event_id"])
    return done.withColumn("actions", F.array_join("actions", " "))


# ---------------------------------------------------------------- run control: W2-W4, A9
_STREAK_SQL = """WITH a AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id
  ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events),
s AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id
  ROWS UNBOUNDED PRECEDING) AS streak FROM a)"""

def _failed():
    return F.col("event_type") == "error"


@register("failure_streak", _STREAK_SQL + " SELECT event_id, CAST(streak AS BIGINT) AS streak FROM s")
def q_failure_streak(spark, sf):
    e = Tables(spark, sf)("events").select("event_id", "user_id", "ts", "event_type")
    return fl.failure_streak(e, ["user_id"], ["ts", "event_id"], _failed()).select("event_id", "streak")


@register("auto_stop_ledger", _STREAK_SQL + """,
t AS (SELECT *, max(CASE WHEN streak >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS tripped FROM s)
SELECT user_id, event_id FROM t WHERE coalesce(tripped, 0) = 0""")
def q_auto_stop_ledger(spark, sf):
    e = Tables(spark, sf)("events").select("event_id", "user_id", "ts", "event_type")
    return fl.auto_stop(e, ["user_id"], ["ts", "event_id"], _failed(), limit=3).select("user_id", "event_id")


@register("recent_failures", """
SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
FROM events WHERE event_type = 'error') WHERE rn <= 10""")
def q_recent_failures(spark, sf):
    e = Tables(spark, sf)("events").select("event_id", "user_id", "ts", "event_type")
    return fl.recent_failures(e, ["user_id"], ["ts", "event_id"], _failed(), 10).select("user_id", "event_id")


@register("run_summary", """
SELECT user_id, CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed
FROM events GROUP BY 1""")
def q_run_summary(spark, sf):
    return fl.run_summary(Tables(spark, sf)("events"), ["user_id"], _failed())


# ---------------------------------------------------------------- P11, K5
# Marker order matters: 'src10' also contains 'src1', and the first rule wins.
_TAG_RULES = [("src1", "A"), ("src10", "B"), ("src2", "C")]


@register("source_tag", """
SELECT doc_id, CASE WHEN contains(source, 'src1') THEN 'A' WHEN contains(source, 'src10') THEN 'B'
  WHEN contains(source, 'src2') THEN 'C' ELSE 'UNKNOWN' END AS tag FROM documents""")
def q_source_tag(spark, sf):
    d = Tables(spark, sf)("documents")
    return d.select("doc_id", source_tag(F.col("source"), _TAG_RULES).alias("tag"))


@register("reconcile_copy", """
SELECT CAST(count(*) AS BIGINT) AS n_src, CAST(count(*) AS BIGINT) AS n_dst, CAST(6 AS BIGINT) AS n_cols_src,
  CAST(6 AS BIGINT) AS n_cols_dst, true AS ok FROM part""")
def q_reconcile_copy(spark, sf):
    p = Tables(spark, sf)("part")
    return sinks.reconcile_copy(p, work_dir(spark, "reconcile"), "csv")


# ---------------------------------------------------------------- the collector's plan, end to end (3.1)
_SEGMENT_ORDER = ["AUTOMOBILE", "BUILDING", "MACHINERY"]


def _domain_inputs(t: Tables):
    """Catalogue, uuid map, zip lists and geocodes of the collector, derived from the driver's tables."""
    from coverlens.operators.ordered import running_scan

    n, r, c = t("nation"), t("region"), t("customer")
    code = F.lpad(F.col("n_nationkey").cast("string"), 11, "0")
    catalog = n.select(code.alias("PROCEDURE_CODE"), F.col("n_name").alias("DRUG_NAME_WITH_FORM_STRENGTH"),
                       F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("DOSAGE_FORM"),
                       F.lit("").alias("TOTAL_BENEFIT_AMOUNT"), F.col("n_regionkey").cast("long").alias("CLAIM_COUNT"),
                       F.col("n_nationkey").cast("long").alias("ordinal"))
    uuids = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        code.alias("procedure_code"),
        F.when(F.col("n_regionkey") == 4, F.lit("")).otherwise(F.concat(F.lit("care_"), F.col("r_name"))).alias("care_uuid"))
    zip_of = F.expr("c_custkey div 2").cast("string")
    raw = c.select(F.col("c_mktsegment").alias("state"), zip_of.alias("zip"), "c_custkey")
    zips = (running_scan(raw, ["state"], ["c_custkey"], ordinal="__o")
            .select("state", (F.col("__o") - 1).alias("ordinal"), "zip"))
    geo = (c.groupBy(zip_of.alias("zip"), F.col("c_mktsegment").alias("state"))
           .agg(F.min("c_acctbal").alias("lat"), F.min("c_nationkey").alias("__n"), F.min("c_name").alias("__name"))
           .filter(F.col("__n") != 7)
           .select("zip", "state", "lat", F.col("__n").cast("double").alias("lng"),
                   F.when(F.col("__n") % 4 == 0, F.lit("")).otherwise(F.col("__name")).alias("city")))
    return catalog, uuids, zips, geo


@register("plan_requests", """
WITH drugs AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 11, '0') AS procedure_code, n_name AS drug_name, 'care_' || r_name AS uuid,
         row_number() OVER (ORDER BY n_nationkey) AS d_ord
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 4),
z AS (
  SELECT c_mktsegment AS state, CAST(c_custkey // 2 AS VARCHAR) AS zip, c_custkey,
         ntile(3) OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS b
  FROM customer WHERE c_mktsegment IN ('MACHINERY', 'AUTOMOBILE', 'BUILDING')),
geo AS (
  SELECT CAST(c_custkey // 2 AS VARCHAR) AS zip, c_mktsegment AS state, min(c_acctbal) AS lat,
         CASE WHEN min(c_nationkey) % 4 = 0 THEN '' ELSE min(c_name) END AS city
  FROM customer GROUP BY 1, 2 HAVING min(c_nationkey) <> 7),
loc AS (
  SELECT z.state, z.zip, geo.lat, coalesce(nullif(geo.city, ''), z.state || '_City') AS city,
         row_number() OVER (ORDER BY CASE z.state WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 3 END,
                                     z.c_custkey) AS l_ord
  FROM z JOIN geo ON z.zip = geo.zip AND z.state = geo.state WHERE z.b = 2),
nl AS (SELECT count(*) AS n FROM loc),
grid AS (
  SELECT procedure_code || '_' || zip AS combination_key, (d_ord - 1) * n + l_ord AS position, state,
         zip AS zip_code, city, procedure_code, uuid, coalesce(nullif(lower(drug_name), ''), 'prescription') AS searchedQuery,
         CAST(lat AS VARCHAR) AS locationLat
  FROM drugs CROSS JOIN loc CROSS JOIN nl)
SELECT combination_key, CAST(min(position) AS BIGINT) AS position, arg_min(state, position) AS state,
       arg_min(zip_code, position) AS zip_code, arg_min(city, position) AS city,
       arg_min(procedure_code, position) AS procedure_code, arg_min(uuid, position) AS uuid,
       arg_min(searchedQuery, position) AS searchedQuery, arg_min(locationLat, position) AS locationLat
FROM grid GROUP BY combination_key""")
def q_plan_requests(spark, sf):
    from coverlens.plans.collection import plan_requests

    catalog, uuids, zips, geo = _domain_inputs(Tables(spark, sf))
    plan = plan_requests(catalog, uuids, zips, geo, states=["MACHINERY", "AUTOMOBILE", "BUILDING"],
                         batch_num=2, total_batches=3, state_order=_SEGMENT_ORDER)
    return plan.select("combination_key", "position", "state", "zip_code", "city", "procedure_code", "uuid",
                       "searchedQuery", "locationLat")
