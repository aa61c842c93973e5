"""Driver-table access and data derived from it for the bindings (landed responses, logs, attempts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.operators.failures import FAILURE_MARKERS

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


class Tables:
    """Lazy parquet readers for one scale-factor folder; column pruning reaches the scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt by ``key`` over all shuffle partitions, before they grow into JSON.

    A small file is one split, and adaptive execution takes few bytes for little work; with a
    number of its own the shuffle is not coalesced.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _j(*pairs: tuple[str, Column]) -> Column:
    return F.struct(*[c.alias(k) for k, c in pairs])


def landed_responses(t: Tables) -> DataFrame:
    """One landed response per lineitem row of an order (two pharmacies each), and an
    empty response (no ``pharmacies`` key) for an order without lineitems.

    Built row by row from orders LEFT JOIN lineitem, so no group is collected.
    Columns: o_orderkey, body.
    """
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    li = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                              "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    # lineitem is the fact side: a sort-merge join keeps the JSON building spread over
    # the join's partitions instead of one probe task per orders file.
    rows = o.join(li.hint("merge"), o.o_orderkey == li.l_orderkey, "left")
    has_line = F.col("l_orderkey").isNotNull()
    pharmacies = F.array(
        _j(("name", F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))),
           ("gsn", F.col("l_linenumber").cast("string")),
           ("qty", F.col("l_quantity")),
           ("careEstimateResult", _j(("providerPrice", F.col("l_extendedprice")),
                                     ("estimatedMemberResponsibility", F.col("l_discount"))))),
        _j(("name", F.concat(F.lit("P"), F.col("l_partkey").cast("string"))),
           ("gsn", F.lit(None).cast("string")),
           ("qty", F.col("l_quantity")),
           ("careEstimateResult", F.lit(None).cast("struct<providerPrice: double, estimatedMemberResponsibility: double>"))),
    )
    form = F.array(_j(("label", F.col("l_returnflag")),
                      ("selected", F.col("l_linestatus") == F.lit("F")),
                      ("queryMap", _j(("qty", F.col("l_linenumber").cast("string")),
                                      ("gsn", F.col("l_partkey").cast("string"))))))
    full = _j(("title", F.col("o_orderstatus")), ("name", F.col("o_orderpriority")),
              ("facilityBenefitAmount", F.col("o_totalprice")),
              ("memberInfo", _j(("zipCode", F.col("o_custkey").cast("string")))),
              ("form", form), ("pharmacies", pharmacies))
    empty = _j(("title", F.col("o_orderstatus")), ("name", F.col("o_orderpriority")))
    body = F.when(has_line, F.to_json(full)).otherwise(F.to_json(empty))
    return rows.select("o_orderkey", body.alias("body"))


def order_plan(t: Tables) -> DataFrame:
    """Plan rows keyed like the responses: location and catalogue columns of each order."""
    o = t("orders")
    return o.select(
        "o_orderkey",
        F.col("o_orderpriority").alias("state"),
        F.col("o_custkey").cast("string").alias("zip_code"),
        F.lit("").alias("city"),
        F.col("o_totalprice").alias("lat"),
        F.lit(0.0).alias("lng"),
        F.col("o_orderkey").cast("string").alias("procedure_code"),
        F.col("o_orderstatus").alias("drug_name"),
        F.lit("").alias("dosage_form"),
        F.col("o_custkey").alias("claim_count"),
    )


def _line_key() -> Column:
    return F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_responses(t: Tables) -> DataFrame:
    """One response for each order line; its estimate is an explicit null, absent, or the discount, by line number."""
    care = F.when(F.col("l_linenumber") % 3 == 0, F.lit('{"estimatedMemberResponsibility": null}')).when(
        F.col("l_linenumber") % 3 == 1, F.lit("{}")).otherwise(
        F.concat(F.lit('{"estimatedMemberResponsibility": '), F.col("l_discount").cast("string"), F.lit("}")))
    body = F.concat(F.lit('{"pharmacies": [{"gsn": "'), _line_key(), F.lit('", "careEstimateResult": '), care, F.lit("}]}"))
    return t("lineitem").select(_line_key().alias("line_key"), body.alias("body"))


def line_plan(t: Tables) -> DataFrame:
    """Plan rows keyed like ``line_responses``: supplier as location, part as catalogue code."""
    part = F.col("l_partkey").cast("string")
    return t("lineitem").select(
        _line_key().alias("line_key"), F.lit("").alias("state"), F.col("l_suppkey").cast("string").alias("zip_code"), F.lit("").alias("city"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"), part.alias("procedure_code"), part.alias("drug_name"),
        F.lit("").alias("dosage_form"), F.lit(0).cast("long").alias("claim_count"))


def failure_log(t: Tables) -> DataFrame:
    """A collector log derived from events: one line per event, line number = event_id.

    view -> an INFO line; signup -> failure markers with a malformed tail; click ->
    a name with parentheses and braces; purchase -> a name containing " in "; error ->
    a name padded with spaces.
    """
    e = t("events")
    eid = F.col("event_id").cast("string")
    uid = F.col("user_id").cast("string")
    name = (F.when(F.col("event_type") == "click", F.concat(F.col("event_type"), F.lit(" ("), F.col("props"), F.lit(")")))
            .when(F.col("event_type") == "purchase", F.lit("purchase in store"))
            .otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit("  "))))
    fail = F.concat(eid, F.lit(f" - ERROR - {FAILURE_MARKERS[0]} "), name, F.lit(" in "), uid,
                    F.lit(f" ({FAILURE_MARKERS[1]} "), eid, F.lit(", Consecutive: "), (F.col("event_id") % 10).cast("string"),
                    F.lit(")"))
    bad_tail = F.concat(eid, F.lit(f" - ERROR - {FAILURE_MARKERS[0]} "), F.col("event_type"), F.lit(" in "), uid,
                        F.lit(f" ({FAILURE_MARKERS[1]} "), eid, F.lit(")"))
    info = F.concat(eid, F.lit(" - INFO - Processing "), F.col("event_type"), F.lit(" for "), uid)
    value = (F.when(F.col("event_type") == "view", info)
             .when(F.col("event_type") == "signup", bad_tail)
             .otherwise(fail))
    return e.select(F.col("event_id").alias("line_no"), value.alias("value"))


def attempts(t: Tables) -> DataFrame:
    """Request attempts derived from events: status, body, error, attempt number, refresh flag."""
    e = t("events")
    status = (F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "signup", 401)
              .when(F.col("event_type") == "error", 429).when(F.col("event_type") == "click", 500))
    body = F.when(F.col("value") > 25, F.concat(F.lit("Token expired: "), F.col("props"))).otherwise(F.col("props"))
    error = F.when(status.isNull(), F.lit("Read timeout"))
    return e.select("event_id", "user_id", status.alias("status"), body.alias("body"), error.alias("error"),
                    (F.col("event_id") % 3 + 1).cast("int").alias("attempt_no"),
                    (F.col("value") < 10).alias("refreshed"))


def request_attempts(t: Tables) -> DataFrame:
    """Attempts of requests derived from events: four recorded for each request, one more than are ever made; some refreshes fail."""
    e = t("events")
    status = (F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "signup", F.when(F.col("event_id") % 2 == 0, 401).otherwise(403))
              .when(F.col("event_type") == "error", 429).when(F.col("event_type") == "click", 500))
    body = F.when(F.col("value") > 25, F.concat(F.lit("Unauthorized call: "), F.col("props"))).otherwise(F.col("props"))
    error = F.when(status.isNull(), F.when(F.col("event_id") % 3 == 0, F.lit("401 Unauthorized for url")).when(
        F.col("event_id") % 3 == 1, F.lit("Read timeout")).otherwise(F.lit("Connection reset")))
    return e.select(F.floor(F.col("event_id") / 4).cast("long").alias("request_id"), "event_id", status.alias("status"), body.alias("body"),
                    error.alias("error"), F.when(F.col("event_id") % 7 < 6, F.col("event_id") % 7 < 4).alias("refresh_ok"))
