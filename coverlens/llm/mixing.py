"""Mixing sources to target weights: hash-random order, distributed prefix sums, an exact cut.

Sources share a word budget by weight, none above a multiple of its own size.  Inside a
source the documents stand in hash-random order; whole epochs are taken first, and the rest
of the budget is cut from the running word count of that order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coverlens.llm.common import free_prefix, quoted, save

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
SEED = 20240229
#: Documents of a bucket of the hash order; a bucket is one window partition.
BUCKET_ROWS = 2_000


def word_count(text: Column) -> Column:
    """Number of words between ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size`` rows -> the same with ``target`` (double).

    Weights go round the sources in code-point order, null last.  The targets share
    ``share_percent`` of all sizes by weight; a target stops at ``max_epochs`` times its source's
    size and the excess is shared again by weight among the others, until none is above.  With
    the sources in order of ``limit / weight``, the ones that stop are the first k, and the
    others get ``(budget - limits of the first k) / (their weights)`` for each unit of weight.
    Sources without words get 0; no sources, no rows.  The sources are one row each after the
    aggregate over the documents; their running sums go through one sort of that small table.
    """
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("i") - 1, F.lit(n)) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = (sources.withColumn("i", F.row_number().over(by_name)).withColumn("weight", weight.cast("long"))
         .withColumn("limit", (F.lit(max_epochs) * F.col("source_size")).cast("decimal(38,0)")))
    by_ratio = Window.orderBy(F.col("limit").cast("double") / F.col("weight"), "i")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    w = (w.withColumn("budget", F.sum("source_size").over(everyone).cast("decimal(38,0)") * F.lit(share_percent))
         .withColumn("left", F.col("budget") - 100 * F.coalesce(F.sum("limit").over(before), F.lit(0)))
         .withColumn("heavy", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("level", F.col("left").cast("double") / 100 / F.col("heavy"))
         .withColumn("stops", F.col("limit").cast("double") <= F.col("level") * F.col("weight")))
    # The first source that does not stop names the level; before it all stop at their limit.
    level = F.min(F.when(~F.col("stops"), F.struct((F.col("limit").cast("double") / F.col("weight")).alias("r"), "i", "level"))
                  ).over(everyone)
    return (w.withColumn("at", level)
            .select("source", "source_size",
                    F.coalesce(F.least(F.col("limit").cast("double"), F.col("at.level") * F.col("weight")),
                               F.col("limit").cast("double")).alias("target")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS,
        bucket_rows: int = BUCKET_ROWS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, epochs, cut, key.

    ``taken`` words are ``epochs`` whole passes plus the first ``cut`` words of one more; the
    taken words of a source add up to its target, rounded down to whole words.  A null source
    is a source of its own, a null or blank text has size 0 and takes 0.  Repeated rows are
    documents of their own; rows alike in id, text and source take the same places in the
    order in any run, so reruns agree.  Other columns are left out; empty input gives no rows.

    The order key is a hash, hence evenly spread: it is cut into equal ranges, as many for a
    source as its documents ask for, and one range is one window.  A source with a third of
    all documents has a third of all ranges.  The sizes are written once (four small columns),
    the texts are read once.
    """
    sized = save(docs.select(
        quoted(id_col).alias("doc_id"), quoted(source_col).cast("string").alias("source"),
        word_count(quoted(text_col)).alias("size"),
        F.xxhash64(quoted(id_col), quoted(text_col), F.lit(seed)).alias("key")))
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(stats.select("source", "source_size"), weights, share_percent, max_epochs)
    plan = save(
        targets.alias("t").join(stats.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
        .select("t.source", "t.source_size", "target", F.ceil(F.col("n_docs") / bucket_rows).alias("buckets"),
                F.floor("target").cast("long").alias("budget"))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size")))
                    .otherwise(0).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("source_size")))
    unit = F.shiftrightunsigned("key", 11).cast("double") / F.lit(float(1 << 53))
    rows = (sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
            .select("doc_id", "d.source", "size", "key", "source_size", "target", "whole", "rest",
                    F.floor(unit * F.col("buckets")).cast("long").alias("bucket")))
    in_bucket = Window.partitionBy("source", "bucket").orderBy(F.shiftrightunsigned("key", 1), "key", "doc_id", "size")
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("source", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    run = rows.withColumn("end", F.sum("size").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - (F.col("offset") + F.col("end") - F.col("size"))))
    return (run.alias("r").join(offsets.alias("o"), F.col("r.source").eqNullSafe(F.col("o.source"))
                                & (F.col("r.bucket") == F.col("o.bucket")))
            .withColumn("cut", cut.cast("long"))
            .select("doc_id", "r.source", "size", "source_size", "target",
                    (F.col("whole") * F.col("size") + F.col("cut")).cast("long").alias("taken"),
                    F.col("whole").alias("epochs"), "cut", "key"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the documents' columns plus ``epoch`` (1, 2, ...) and ``words``, one row per pass.

    A whole pass has the whole text, the last one the text up to the end of its ``cut``-th
    word; documents that take nothing are left out.  Input columns called like one of the two
    new ones are replaced.  Repeated rows are told apart by a running number.
    """
    keep = [c for c in docs.columns if c.lower() not in ("epoch", "words")]
    t = free_prefix(docs.columns, "mix_")
    seed = options.get("seed", SEED)
    taken = (mix(docs, **options).filter("size > 0")
             .withColumn("no", F.row_number().over(Window.partitionBy("doc_id", "source", "key").orderBy(F.desc("cut"))))
             .select(*[F.col(c).alias(t + c) for c in ("doc_id", "source", "key", "no", "size", "epochs", "cut")]))
    own = docs.select(*[quoted(c) for c in keep], quoted("source").cast("string").alias(t + "s"),
                      F.xxhash64("doc_id", "text", F.lit(seed)).alias(t + "k"))
    own = own.withColumn(t + "n", F.row_number().over(Window.partitionBy("doc_id", t + "s", t + "k").orderBy(t + "k")))
    joined = own.join(taken, F.col("doc_id").eqNullSafe(F.col(t + "doc_id")) & F.col(t + "s").eqNullSafe(F.col(t + "source"))
                      & (F.col(t + "k") == F.col(t + "key")) & (F.col(t + "n") == F.col(t + "no")))
    passes = F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col(t + "epochs").cast("int")),
                      F.when(F.col(t + "cut") > 0, F.array(t + "cut")).otherwise(F.array().cast("array<bigint>")))
    out = joined.select(*[quoted(c) for c in keep], F.col(t + "size"), F.posexplode(passes).alias("epoch", t + "w"))
    cut = F.col(t + "w") >= 0
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)),
                                F.lit(1), F.greatest(F.col(t + "w"), F.lit(0)).cast("int")), "")
    return out.select(
        *[F.when(cut, head).otherwise(F.col("text")).alias(c) if c.lower() == "text" else quoted(c) for c in keep],
        (F.col("epoch") + 1).alias("epoch"), F.when(cut, F.col(t + "w")).otherwise(F.col(t + "size")).alias("words"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")
