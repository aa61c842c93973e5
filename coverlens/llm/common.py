"""Helpers shared by the operators of this subpackage: checkpoints, columns, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.session import ensure_checkpoint_dir, work_dir


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files when they end.

    Otherwise the files of all steps stay until the driver happens to collect its garbage, which
    it does no more often on a large input.  A stage that is run again computes them anew.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before else spark.conf.unset(_CLEANUP)


def save(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of spark.checkpoint.dir: computed once, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # the setting is read when a query is built


def store(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the folder of spark.checkpoint.dir: computed once like ``save``, in a fraction of the room.

    For long tables of few columns: a checkpoint holds whole rows uncompressed, Parquet packs what repeats.
    ``drop`` removes the table when nothing reads it any more.
    """
    path = work_dir(df.sparkSession, "store")
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove the files of tables made by ``store``; no DataFrame that is still to be run may read them."""
    for table in tables:
        remove(table.sparkSession, table.stored_at)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``work_dir`` named, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_prefix(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column of the input begins with it (case is ignored)."""
    taken = [c.lower() for c in columns]
    while any(c.startswith(wanted.lower()) for c in taken):
        wanted += "_"
    return wanted


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Bits of a table of hashes: a fixed 32 KB, whatever the data.
TABLE_BITS = 18


def seen_table(hashes: DataFrame, bits: int = TABLE_BITS) -> Callable[[Column], Column]:
    """A test for rows to keep before a join, from the join keys' hashes (column ``h``, long).

    The test is true for every hash of the table and for some others, so a filter with it takes
    rows out of a shuffle without changing the join.  The table has ``2 ** bits`` bits, however
    many hashes there are; a crowded one lets more rows through.
    """
    words = 1 << (bits - 6)
    got = (hashes.select(F.col("h").bitwiseAND((1 << bits) - 1).alias("s"))
           .groupBy(F.shiftright("s", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("m")))
    mask = ["0"] * words
    for r in got.toLocalIterator():
        mask[r.w] = str(r.m)
    table = F.split(F.lit(",".join(mask)), ",").cast("array<bigint>")

    def test(h: Column) -> Column:
        slot = h.bitwiseAND((1 << bits) - 1)
        return F.getbit(F.get(table, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(63).cast("int")) == 1

    return test


def with_seen(df: DataFrame, key: Column, hashes: DataFrame, name: str, bits: int = TABLE_BITS) -> DataFrame:
    """``df`` with the test of ``seen_table`` for ``key`` as boolean column ``name``, the table being broadcast and no part of the plan.

    For large tables: a constant in the plan is written out in each description that the driver keeps of it.
    ``name``, ``name``_w and ``name``_m must be no columns of ``df``.
    """
    table = (hashes.select(F.col("h").bitwiseAND((1 << bits) - 1).alias("s"))
             .groupBy(F.shiftright("s", 6).cast("int").alias(name + "_w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias(name + "_m")))
    slot = key.bitwiseAND((1 << bits) - 1)
    there = F.getbit(quoted(name + "_m"), slot.bitwiseAND(63).cast("int")) == 1
    return (df.join(F.broadcast(table), F.shiftright(slot, 6).cast("int") == quoted(name + "_w"), "left")
            .withColumn(name, F.coalesce(there, F.lit(False))).drop(name + "_w", name + "_m"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: any one ordered type, a <> b): rows (node, root), root the least node.

    Alternates large-star and small-star steps: each node links its neighbours to the least
    one it knows, until nothing changes.  Every step is an aggregate and a join on the node;
    the edge list never grows beyond its first size, and each step is stored in the place of the
    one before; ``drop`` removes the last.  Nodes are never gathered anywhere.  ``max_rounds`` only guards against a defect: steps shrink
    the diameter geometrically, and an error is raised rather than a partial answer returned.
    Empty input gives an empty result.
    """
    e = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        # Large star: every neighbour above a node points to the least of the node's neighbourhood.
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: a node and its lower neighbours point to the least of these.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        last, e = e, store(small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                           .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        drop(last)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            out = e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
            out.stored_at = e.stored_at
            return out
        before = now
    raise RuntimeError("connected components did not settle")
