"""The reference's jobs as Spark plans over its own domain tables.

``plan_requests``  catalogue + uuid map + zip lists + geocodes + ledger -> request manifest
``analyze_prices`` price fact -> no-favourable groups and their summary
Fetching is outside the engine: the manifest goes out, landed responses come back in
and are flattened by ``coverlens.operators.responses.extract_prices``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.functions.codes import code_text
from coverlens.functions.keys import combination_key
from coverlens.operators import catalog as cat
from coverlens.operators import coverage as cov
from coverlens.operators import geography as geo
from coverlens.operators import planning as pl
from coverlens.operators.ordered import top_k_per_group


def resolved_catalog(catalog: DataFrame, uuid_map: DataFrame, preview: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(drugs with a uuid, numbered rejects).  ``catalog`` has the S2 columns plus ``ordinal``."""
    c = catalog
    if preview is not None:
        c = cat.preview(c, ["ordinal"], preview)
    c = c.withColumn("procedure_code", code_text("PROCEDURE_CODE"))
    drugs = cat.resolve(c, "procedure_code", uuid_map, "procedure_code", "care_uuid").select(
        "procedure_code", F.col("care_uuid").alias("uuid"),
        F.col("DRUG_NAME_WITH_FORM_STRENGTH").alias("drug_name"), F.col("DOSAGE_FORM").alias("dosage_form"),
        F.col("TOTAL_BENEFIT_AMOUNT").alias("total_benefit_amount"), F.col("CLAIM_COUNT").alias("claim_count"),
        "ordinal")
    rejected = cat.rejects(c, "procedure_code", uuid_map, "procedure_code", "care_uuid")
    rejected = cat.number_rows(rejected, [], ["ordinal"], "n")
    return drugs, rejected.select("n", "procedure_code", F.col("DRUG_NAME_WITH_FORM_STRENGTH").alias("drug_name"))


def located_zips(zips: DataFrame, geocodes: DataFrame, states: Sequence[str] | None = None,
                 batch_num: int | None = None, total_batches: int | None = None,
                 preview: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(zips with coordinates, zips without a geocode).

    State filter, then batch slice, then preview per state, then geocode, in the
    reference's order (the slice and preview precede the lookup).
    """
    geo.validate_batch(batch_num, total_batches)
    z = geo.filter_states(zips, states)
    if batch_num is not None:
        z = geo.batch_slice(z, ["state"], ["ordinal"], batch_num, total_batches)
    if preview is not None:
        z = top_k_per_group(z, ["state"], ["ordinal"], preview)
    located = geo.locate(z, geocodes, ["zip", "state"])
    return located, geo.locate_rejects(z, geocodes, ["zip", "state"])


def plan_requests(catalog: DataFrame, uuid_map: DataFrame, zips: DataFrame, geocodes: DataFrame,
                  ledger: DataFrame | None = None, states: Sequence[str] | None = None,
                  batch_num: int | None = None, total_batches: int | None = None,
                  zip_preview: int | None = None, catalog_preview: int | None = None,
                  retry_failed: bool = False, state_order: Sequence[str] = geo.STATES, run_id: str = "run") -> DataFrame:
    """Request manifest of one run: the drug-major grid, first occurrence of each key, minus the ledger.

    A zip listed under two states is requested once per drug, under the earlier
    state of ``state_order`` (SURVEY D2); failed ledger rows count as done unless
    ``retry_failed`` (D4).  ``position`` is the reference's processing order.  Call ids are made of
    ``run_id`` and the key, so a repeated task gives the same ones.
    """
    drugs, _ = resolved_catalog(catalog, uuid_map, catalog_preview)
    located, _ = located_zips(zips, geocodes, states, batch_num, total_batches, zip_preview)
    rank = F.array_position(F.array(*[F.lit(s) for s in state_order]), F.col("state"))
    located = located.withColumn("state_rank", F.coalesce(rank, F.lit(len(state_order) + 1)).cast("long"))
    # First wins per key (W7, D2) is applied to each side before the product, the ledger (J5) before a cell is made.
    done = None if ledger is None else pl.split_keys(pl.attempted(ledger, "status", retry_failed), "procedure_code", "zip")
    grid = pl.plan_grid(drugs, ["ordinal"], located.withColumnRenamed("ordinal", "zip_ordinal"),
                        ["state_rank", "zip_ordinal"], cat_key="procedure_code", loc_key="zip", done=done, done_on=("procedure_code", "zip"))
    firsts = grid.withColumn("combination_key", combination_key(F.col("procedure_code"), F.col("zip")))
    return firsts.select(
        "position", "combination_key", "state", F.col("zip").alias("zip_code"), "city", "lat", "lng",
        "procedure_code", "drug_name", "dosage_form", "claim_count", "uuid",
        F.col("lat").cast("string").alias("locationLat"), F.col("lng").cast("string").alias("locationLong"),
        F.coalesce(F.nullif(F.lower(F.col("drug_name")), F.lit("")), F.lit("prescription")).alias("searchedQuery"),
        pl.call_id(F.lit(run_id), "combination_key").alias("intentCallId"))


def analyze_prices(prices: DataFrame, order: str | Sequence[str] = "ordinal") -> tuple[DataFrame, DataFrame]:
    """(zip/code groups with no favourable pharmacy, summary); ``order`` is the fact's row order."""
    groups = cov.no_favorable(prices, ["zip_code", "procedure_code"], "estimated_member_responsibility",
                              ["drug_name"], order)
    return groups, cov.no_favorable_summary(groups, ["zip_code", "procedure_code"])


def enrich_catalog(catalog: DataFrame, uuid_map: DataFrame, code: str = "PROCEDURE_CODE",
                   map_code: str = "procedure_code", map_value: str = "care_uuid") -> tuple[DataFrame, DataFrame]:
    """(every catalogue row with CARE_UUID, lookup metrics): the catalogue enrichment job."""
    enriched = cat.enrich(catalog, code, uuid_map, map_code, map_value, "CARE_UUID")
    return enriched, cat.lookup_metrics(enriched, "CARE_UUID")


def parse_failures(lines: DataFrame, value: str = "value", line_no: str = "line_no") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(distinct failed zip/drug pairs in first-seen order, unparsed lines, summary): the log-mining job."""
    from coverlens.operators import failures as fl

    scanned = fl.scan_failure_lines(lines, value, line_no)
    return fl.failures_distinct(fl.failures(scanned)), fl.unparsed(scanned), fl.log_summary(scanned)
