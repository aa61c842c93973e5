"""Request planning over the catalogue x location grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.functions.attempts import REQUEST_DELAY_SEC
from coverlens.operators.ordered import running_scan


#: Catalogue rows that travel together; one (location, block) pair is one row of work.
BLOCK_ROWS = 256
#: (Block, chunk of locations) pairs wanted for a task, so that a hash deals them evenly.
PAIRS_PER_TASK = 16


def _first_per_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Rows holding the lowest ``ordinal`` of their ``key`` (a mergeable min, then a semi join)."""
    firsts = df.groupBy(key).agg(F.min(ordinal).alias(ordinal))
    return df.join(firsts, [key, ordinal], "left_semi")


def _done_bits(done: DataFrame, cats: DataFrame, cat_on: str, locs: DataFrame, loc_on: str, block_rows: int) -> DataFrame:
    """Done cells as bits (location_ordinal, __block, __done): bit ``i`` of a block is its ``i``-th catalogue row.

    A cell is found by two joins on its keys; the bits combine map-side, and one row holds at
    most ``block_rows`` cells, however long the ledger is.
    """
    pairs = done.select(F.col(cat_on).alias("__dc"), F.col(loc_on).alias("__dl"))
    cells = (pairs.join(cats.select(F.col(cat_on).alias("__dc"), "catalog_ordinal"), "__dc")
             .join(locs.select(F.col(loc_on).alias("__dl"), "location_ordinal"), "__dl"))
    at = (F.col("catalog_ordinal") - 1) % block_rows
    words = -(-block_rows // 64)
    bit = F.expr("shiftleft(1L, cast(__at % 64 as int))")
    return (cells.select("location_ordinal", F.floor((F.col("catalog_ordinal") - 1) / block_rows).cast("long").alias("__block"), at.alias("__at"))
            .groupBy("location_ordinal", "__block")
            .agg(F.array(*[F.coalesce(F.bit_or(F.when(F.floor(F.col("__at") / 64) == w, bit)), F.lit(0).cast("long")) for w in range(words)]).alias("__done")))


def plan_grid(catalog: DataFrame, cat_order: Sequence[str], locations: DataFrame,
              loc_order: Sequence[str], cat_key: str | None = None, loc_key: str | None = None,
              block_rows: int = BLOCK_ROWS, partitions: int | None = None,
              done: DataFrame | None = None, done_on: tuple[str, str] | None = None) -> DataFrame:
    """Every catalogue row with every location, with its drug-major position.

    The grid is the result, so it is built where it ends up: the catalogue is packed into
    blocks of ``block_rows`` rows, each location takes every block's number, the (location,
    block) pairs are spread evenly over ``partitions`` tasks (default: the session's shuffle
    partitions), and each pair unpacks its block.  What is shuffled is one row per pair, a
    ``block_rows``-th of the grid, and copies of the catalogue; nothing is broadcast.  Locations
    are dealt into chunks, no more than there are locations or tasks and no more than spread
    the blocks over all tasks, and a block is copied once for a chunk: ``PAIRS_PER_TASK`` copies
    of a block for each task at most, whatever the size of the catalogue.
    ``position`` is (catalogue ordinal - 1) * n + location ordinal, the reference's loop order.

    With ``cat_key`` / ``loc_key`` only the first cell of each (cat_key, loc_key) pair is
    produced (W7, first wins): positions are ordered by (catalogue ordinal, location ordinal),
    so the first cell of a pair is the first catalogue row of its key with the first location
    of its key.  Each side is reduced on its own, before the product.

    With ``done`` (and ``done_on``, its two columns, called as in the catalogue and the
    locations) cells of these pairs are not produced (J5): they are bits of a (location, block)
    pair, taken out before the block is unpacked.
    """
    spark = locations.sparkSession
    tasks = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    locs = running_scan(locations, [], loc_order, ordinal="location_ordinal", group_size="__n")
    cats = running_scan(catalog, [], cat_order, ordinal="catalog_ordinal", group_size="__m")
    n_blocks = F.floor((F.col("__m") - 1) / block_rows) + 1
    # Numbers of blocks and locations travel with the rows; the largest is the last.
    last = cats.agg(F.coalesce(F.max(n_blocks), F.lit(0)).cast("long")).scalar()
    chunks = F.least(F.lit(tasks).cast("long"), locs.agg(F.coalesce(F.max("__n"), F.lit(1))).scalar(),
                     F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(PAIRS_PER_TASK * tasks) / F.greatest(last, F.lit(1))).cast("long")))
    if cat_key:
        cats = _first_per_key(cats, cat_key, "catalog_ordinal")
    if loc_key:
        locs = _first_per_key(locs, loc_key, "location_ordinal")
    fields = [c for c in cats.columns if c != "__m"]
    blocks = (cats.withColumn("__block", F.floor((F.col("catalog_ordinal") - 1) / block_rows).cast("long"))
              .groupBy("__block").agg(F.collect_list(F.struct(*fields)).alias("__items"))
              .withColumn("__chunks", chunks).withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__chunks") - 1))).drop("__chunks"))
    pairs = (locs.withColumns({"__last": last, "__chunks": chunks}).filter("__last > 0")
             .withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__last") - 1)))
             .withColumn("__chunk", F.pmod("location_ordinal", "__chunks")).drop("__last", "__chunks"))
    items = F.col("__items")
    if done is not None:
        pairs = pairs.join(_done_bits(done, cats, done_on[0], locs, done_on[1], block_rows), ["location_ordinal", "__block"], "left")
        at = f"int((x.catalog_ordinal - 1) % {block_rows})"
        items = F.expr(f"filter(__items, x -> __done IS NULL OR getbit(__done[{at} div 64], {at} % 64) = 0)")
    # Both sides are dealt by number, so the cells are spread before they are unpacked, at any size.
    on = ["__block", "__chunk"]
    grid = pairs.repartition(tasks, *on).join(blocks.repartition(tasks, *on), on).withColumn("__c", F.explode(items))
    rest = [c for c in locs.columns if c not in ("location_ordinal", "__n")]
    return grid.select("location_ordinal", *[F.col(f"__c.{c}").alias(c) for c in fields], *rest,
                       ((F.col("__c.catalog_ordinal") - 1) * F.col("__n") + F.col("location_ordinal")).alias("position"))


def split_keys(ledger: DataFrame, cat_col: str, loc_col: str, key: str = "combination_key") -> DataFrame:
    """The (code, location) pairs that a ledger's keys can stand for: one for each underscore of a key."""
    parts = F.split(key, "_")
    return (ledger.select(parts.alias("__p"), F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("__i")).filter("size(__p) > 1")
            .select(F.array_join(F.slice("__p", F.lit(1), F.col("__i")), "_").alias(cat_col),
                    F.array_join(F.slice("__p", F.col("__i") + 1, F.size("__p")), "_").alias(loc_col)))


def remaining(grid: DataFrame, ledger: DataFrame, keys: Sequence[str], status: str | None = None,
              retry_failed: bool = False) -> DataFrame:
    """Grid cells not yet attempted (J5), from a grid that is there already; ``plan_grid`` leaves them out from the start."""
    return grid.join(attempted(ledger, status, retry_failed).select(*keys), list(keys), "left_anti")


def attempted(ledger: DataFrame, status: str | None = None, retry_failed: bool = False) -> DataFrame:
    """Ledger rows that count as done: failed attempts too, unless ``retry_failed``."""
    return ledger.filter(F.col(status) != F.lit("failed")) if retry_failed and status else ledger


def first_wins(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """First row per key in ``order``; later duplicates are skipped (W7).  Mergeable ``min_by``."""
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in key]
    if len(rest) == 1 and len(order) == 1:
        # No struct wrapping: a fixed-width value and order keep the hash aggregate.
        return df.groupBy(*key).agg(F.min_by(F.col(rest[0]), F.col(order[0])).alias(rest[0]))
    pick = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*key).agg(pick.alias("__r")).select(*key, "__r.*")


def plan_summary(locations: DataFrame, by: Sequence[str], catalog_size: int | Column,
                 delay_sec: float = REQUEST_DELAY_SEC) -> DataFrame:
    """Combinations and estimated seconds per group (A7): locations x catalogue x delay.

    ``est_tenths`` is the estimate in tenths of a second, an exact integer.
    """
    size = catalog_size if isinstance(catalog_size, Column) else F.lit(int(catalog_size))
    tenths = int(round(delay_sec * 10))
    g = locations.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    comb = (F.col("__n") * size).cast("long")
    return g.select(*by, comb.alias("combinations"), (comb * tenths).cast("long").alias("est_tenths"))


def call_id(*parts: Column | str) -> Column:
    """A request's call id: a UUID made of ``parts`` (such as run and key), the same when a task is run again (P10).

    The first 32 hex digits of a digest, with the version and variant marks of a random UUID.
    """
    h = F.sha2(F.concat_ws("\u0001", *parts).cast("binary"), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)),
                       F.concat(F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1)), F.substring(h, 18, 3)),
                       F.substring(h, 21, 12))


def request_rows(plan: DataFrame, *, uuid: str, zip_code: str, lat: str | None, lng: str | None,
                 name: str, call: Column | None = None) -> DataFrame:
    """The request parameters of each cell (P10): text coordinates, lower-cased query, call id if given (see ``call_id``)."""
    cols = [F.col(uuid).alias("uuid"), F.col(zip_code).cast("string").alias("zipCode")]
    if lat:
        cols.append(F.col(lat).cast("string").alias("locationLat"))
    if lng:
        cols.append(F.col(lng).cast("string").alias("locationLong"))
    cols.append(F.coalesce(F.nullif(F.lower(F.col(name)), F.lit("")), F.lit("prescription")).alias("searchedQuery"))
    if call is not None:
        cols.append(call.alias("intentCallId"))
    return plan.select(*cols)
