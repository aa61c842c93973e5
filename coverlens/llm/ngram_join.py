"""N-gram Jaccard join by vertical partitioning: classes of documents whose word n-gram sets are alike.

The hashes of the n-grams give them one global order; n-grams that many texts share come
last.  Two sets with a Jaccard similarity of at least t share an n-gram among the first
``|x| - ceil(t |x|) + 1`` of each (the prefix), so sets that meet in no prefix n-gram are never
compared.  Sets that meet, directly or through others, form a candidate group.  Inside a
group the global order is cut into fragments, overlaps are counted fragment by fragment for
all pairs of a block at once, and the partial counts are summed per pair.  Only a spanning
forest of the links leaves a block, so a group of thousands of copies costs no list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coverlens.llm.common import components, drop, free_prefix, quoted, seen_table, store
from coverlens.llm.words import BLANKS, U, distinct_sorted, gram_hashes, mix, utf8, word_hashes

GRAM = 5
PERCENT = 80
#: An n-gram in at least this many texts is moved to the end of the global order.
COMMON = 16
#: Share of the order's front in which n-grams are counted; prefixes reach hardly beyond it.
COUNTED = 0.25
#: Longest list of sets around one n-gram whose pairs are looked at one by one.
PAIRED = 24
#: Bits of the table of common n-grams: its size (2 MB) does not depend on the data.
TABLE_BITS = 24
#: Sets of a block, and n-grams of a fragment: bounds of one task's counting table.
BLOCK = 1024
FRAGMENT = 4096
_PART = 512


def _sets(batch, text: int, gram: int):
    """Distinct n-gram hashes of each text of an Arrow batch (sorted) and where they begin."""
    words, bounds = word_hashes(utf8(batch.column(text)), BLANKS)
    return distinct_sorted(*gram_hashes(words, bounds, gram))


def _set_key(grams: np.ndarray) -> int:
    """64-bit name of a set, from all its members; equal for equal sets."""
    a = mix(grams + U(0x9E3779B97F4A7C15))
    h = mix(np.array([a.sum(dtype=np.uint64) ^ mix(np.array([np.bitwise_xor.reduce(mix(a))]))[0] + U(len(a))], np.uint64))
    return int(h.view(np.int64)[0])


def _needed(n: np.ndarray | int, percent: int):
    """ceil(percent / 100 * n): the least overlap of a set of n members with any similar one."""
    return -(-percent * n // 100)


def _slices(batches: Iterable) -> Iterator:
    for whole in batches:
        for at in range(0, whole.num_rows, _PART):
            yield whole.slice(at, _PART)


def _front(batches_of: int):
    """Mapper: n-grams of the order's front, each once for every batch it occurs in, with the number of texts."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        limit = U(int(COUNTED * 2**64))
        for whole in batches:
            seen: dict[int, None] = {}
            parts = []
            for batch in _slices([whole]):
                grams, b = _sets(batch, 0, batches_of)
                keep = []
                for i in range(len(b) - 1):
                    g = grams[b[i]:b[i + 1]]
                    if len(g):
                        k = _set_key(g)
                        if k not in seen:  # exact copies count once
                            seen[k] = None
                            keep.append(g[:np.searchsorted(g, limit)])
                parts += keep
            if parts:
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int32))], ["g", "n"])

    return run


def common_table(docs: DataFrame, text_col: str, gram: int, common: int, bits: int = TABLE_BITS) -> np.ndarray | None:
    """Bit table of the n-grams that at least ``common`` texts share, by hash; None if there are none.

    Counts cover every text.  The table has a fixed size; with very many common n-grams other
    n-grams fall on the same bits and move to the end of the order too, which costs time, not
    results: any global order gives the same links.
    """
    counted = docs.select(quoted(text_col).alias("text")).mapInArrow(_front(gram), "g long, n int")
    often = counted.groupBy("g").agg(F.sum("n").alias("n")).filter(F.col("n") >= common)
    slot = F.col("g").bitwiseAND((1 << bits) - 1)
    # Stored, so that the shuffle of the counts is gone before the next step.
    masks = store(often.select(F.shiftright(slot, 6).cast("int").alias("word"), (slot % 64).cast("int").alias("bit"))
                  .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")))
    words = masks.toPandas()
    drop(masks)
    if not len(words):
        return None
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words["word"].to_numpy()] = words["mask"].to_numpy()
    return table


def _prefixes(gram: int, percent: int, table, bits: int):
    """Mapper: text rows -> id, set size, set key, prefix n-grams (empty for an exact copy within the batch)."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        flags = table.value if table is not None else None
        for whole in batches:
            seen: set[int] = set()
            for batch in _slices([whole]):
                grams, b = _sets(batch, 1, gram)
                if flags is not None:
                    slot = (grams & U((1 << bits) - 1)).astype(np.int64)
                    common = (flags[slot >> 6] >> (slot & 63)) & 1 > 0
                keys, prefixes, lasts, named = [], [], [], batch.column(0).is_valid().to_pylist()
                for i in range(len(b) - 1):
                    g = grams[b[i]:b[i + 1]]
                    n = len(g) if named[i] else 0
                    k = _set_key(g) if n else None
                    keys.append(k)
                    if not n or k in seen:
                        prefixes.append(None)
                        lasts.append(None)
                        continue
                    seen.add(k)
                    rare = n
                    if flags is not None:
                        c = common[b[i]:b[i + 1]]
                        rare = n - int(c.sum())
                        g = np.concatenate([g[~c], g[c]])
                    g = g[:n - _needed(n, percent) + 1]
                    prefixes.append(g.view(np.int64))
                    lasts.append((int(g[-1]) >> 2) + ((len(g) > rare) << 62))  # its place in the global order
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(b), pa.int64()), pa.array(keys, pa.int64()), pa.array(lasts, pa.int64()),
                     pa.array(prefixes, pa.list_(pa.int64()))], ["doc_id", "n", "key", "last", "prefix"])

    return run


def candidate_pairs(rows: DataFrame, percent: int, paired: int = PAIRED) -> DataFrame:
    """Edges (a, b) that connect all sets which may be similar, from rows (key, n, last, prefix).

    In a list of up to ``paired`` sets around an n-gram, every pair whose lengths allow a link is
    noted, and the notes of a pair are counted: its shared prefix n-grams.  Of the two prefixes,
    the one that ends first in the global order has all its common n-grams in the other one, so
    the overlap is at most that count plus what lies behind that prefix; pairs that cannot reach
    the bound go.  A longer list (its sets are made of common n-grams nearly whole) is strung by
    length, each set to the next if the lengths allow a link: all that may link are then
    connected, at the cost of one edge for each set.  N-grams of longer lists are not counted,
    so as many of them as both sets have are taken to be shared.
    """
    return _candidate_pairs(rows, percent, paired)[0]


def _candidate_pairs(rows: DataFrame, percent: int, paired: int) -> tuple[DataFrame, DataFrame]:
    """``candidate_pairs``, and the stored lists that they are still read from."""
    by_gram = Window.partitionBy("g")
    posts = rows.select("key", "n", F.explode("prefix").alias("g"))
    lists = store(posts.withColumn("least", F.min("key").over(by_gram)).withColumn("most", F.max("key").over(by_gram))
                  .withColumn("size", F.count(F.lit(1)).over(by_gram)).filter("least < most").select("g", "key", "n", "size"))
    short, long = lists.filter(F.col("size") <= paired), lists.filter(F.col("size") > paired)
    x, y = (short.select("g", F.col("key").alias(k), F.col("n").alias("n" + k)) for k in "ab")
    shared = (x.join(y, "g").filter((F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
              .groupBy("a", "b").agg(F.count(F.lit(1)).alias("s")))
    uncounted = long.select("key", "g").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    about = (rows.join(lists.select("key").distinct(), "key", "left_semi").groupBy("key")
             .agg(F.first("n").alias("n"), F.first("last").alias("last"), F.first(F.size("prefix")).alias("p"))
             .join(uncounted, "key", "left").select("key", "n", "last", (F.col("n") - F.col("p")).alias("rest"), F.coalesce("c", F.lit(0)).alias("c")))
    one, two = (about.select(*[F.col(c).alias(c + "_" + k if c != "key" else k) for c in about.columns]) for k in "ab")
    behind = (F.when(F.col("last_a") < F.col("last_b"), F.col("rest_a")).when(F.col("last_a") > F.col("last_b"), F.col("rest_b"))
              .otherwise(F.greatest("rest_a", "rest_b")))
    pairs = (shared.join(one, "a").join(two, "b")
             .filter((100 + percent) * (F.col("s") + F.least("c_a", "c_b") + behind) >= percent * (F.col("n_a") + F.col("n_b")))
             .select("a", "b"))
    along = Window.partitionBy("g").orderBy("n", "key")
    strung = (long.select("key", F.lag("key").over(along).alias("b"), "n", F.lag("n").over(along).alias("m"))
              .filter((F.col("b") != F.col("key")) & (100 * F.col("m") >= percent * F.col("n"))).select(F.col("key").alias("a"), "b"))
    return pairs.unionByName(strung).distinct(), lists


def _member_sets(gram: int):
    """Mapper: (key, text, ...) -> (key, the text's set as bytes, ...), rows whose text has that key."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in _slices(batches):
            grams, b = _sets(batch, 1, gram)
            sets = [grams[b[i]:b[i + 1]] for i in range(batch.num_rows)]
            right = [len(s) > 0 and _set_key(s) == k for s, k in zip(sets, batch.column(0).to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), *batch.columns[2:]],
                                             names=["key", "grams", *batch.schema.names[2:]])
            yield out.filter(pa.array(right, pa.bool_()))

    return run


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Boolean matrix of the linked pairs between two lists of sets (``right`` None: inside ``left``).

    The sorted n-grams that occur at least twice are cut into fragments; each fragment gives a
    partial overlap for every pair, and the sum over the fragments is compared with the bound.
    """
    sets = left + (right or [])
    size = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), size)
    grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = times > 1
    at = np.cumsum(twice) - 1
    keep = twice[column]
    row, column, width = row[keep], at[column[keep]], int(twice.sum())
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    a, b = len(left), len(sets) - len(left)
    overlap = np.zeros((a, b or a), np.float32)
    for start in range(0, width, FRAGMENT):
        lo, hi = np.searchsorted(column, [start, start + FRAGMENT])
        part = np.zeros((len(sets), min(FRAGMENT, width - start)), np.float32)
        part[row[lo:hi], column[lo:hi] - start] = 1
        overlap += part[:a] @ (part[a:] if right is not None else part).T
    both = size[:a, None] + (size[a:] if right is not None else size)[None, :]
    return 100 * overlap.astype(np.int64) >= percent * (both - overlap.astype(np.int64))


def spanning_forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph of n nodes with the edges a[i], b[i]."""
    label = np.arange(n)
    while True:  # every node takes the least label around it, then labels are followed to their ends
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return [(i, int(label[i])) for i in range(n) if label[i] != i]


def _group_links(percent: int):
    """Mapper over rows (grp, i, j, side, key, grams) in order: spanning edges of each (grp, i, j)."""
    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        rows = sorted({r[:2]: r for r in rows}.values(), key=lambda r: r[:2])  # repeated rows of a set are one
        keys = [r[1] for r in rows]
        left = [np.frombuffer(r[2], np.uint64) for r in rows if r[0] == 0]
        right = [np.frombuffer(r[2], np.uint64) for r in rows if r[0] == 1]
        if len(rows) < 2 or not left:
            return []
        a, b = np.nonzero(linked_pairs(left, right or None, percent))
        return [(keys[p], keys[q]) for p, q in spanning_forest(a, b + len(left) * bool(right), len(rows))]

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        now, rows = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for g, i, j, side, key, grams in zip(*(batch.column(x).to_pylist() for x in range(6)), strict=True):
                if (g, i, j) != now:
                    out += links(rows) if rows else []
                    now, rows = (g, i, j), []
                rows.append((side, key, grams))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        out = links(rows) if rows else []
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                    percent: int = PERCENT, common: int = COMMON, paired: int = PAIRED, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    A text's set holds its distinct ``gram``-word shingles (words between ASCII blanks, A-Z
    folded); with fewer words the whole sequence is one, without words or text the set is empty
    and linked with nothing.  Two texts link when ``100 * |x and y| >= percent * |x or y|``;
    ``component_id`` is the least id reachable by links, itself included.  Repeated rows are rows
    of their own with the same result; a row without id is linked with nothing and has no
    component.  Other columns are left out; an empty table gives no rows.

    N-grams and sets go by 64-bit hashes: two unlike ones agree with a chance of 5e-20 each.

    Exact copies are one set from the first step on.  A candidate group that is larger than a
    block is dealt into blocks along the sets' lengths, and each pair of blocks whose lengths
    allow links is worked on by itself, so no step holds more than two blocks of sets.
    """
    spark = docs.sparkSession
    base = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    table = common_table(base, "text", gram, common)
    flags = spark.sparkContext.broadcast(table) if table is not None else None
    found = store(base.select("doc_id", "text").mapInArrow(
        _prefixes(gram, percent, flags, TABLE_BITS), "doc_id long, n long, key long, last long, prefix array<long>"))

    meets, lists = _candidate_pairs(found.filter("prefix is not null"), percent, paired)
    joined = components(meets)
    rows = store(found.select("doc_id", "n", "key"))
    drop(lists, found)
    groups = joined.select(F.col("node").alias("key"), F.col("root").alias("grp"))

    # Groups are dealt into blocks along the sets' lengths; blocks meet whose lengths allow a link.
    one = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n")).join(groups, "key")
    place = F.row_number().over(Window.partitionBy("grp").orderBy("n", "key"))
    one = store(one.withColumn("blk", F.floor((place - 1) / block).cast("int")))
    spans = one.groupBy("grp", "blk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    first, second = (spans.select("grp", F.col("blk").alias(k), F.col("lo").alias("lo" + k), F.col("hi").alias("hi" + k)) for k in "ij")
    meet = first.join(second, "grp").filter((F.col("i") <= F.col("j")) & (100 * F.col("hii") >= percent * F.col("loj")))
    seats = (meet.select("grp", F.col("i").alias("blk"), "i", "j", F.lit(0).alias("side"))
             .unionByName(meet.filter("i < j").select("grp", F.col("j").alias("blk"), "i", "j", F.lit(1).alias("side"))))
    seats = seats.groupBy("grp", "blk").agg(F.collect_list(F.struct("i", "j", "side")).alias("seats"))
    seated = one.join(seats, ["grp", "blk"]).select("doc_id", "key", "grp", "seats")

    # The members' whole sets, from one text for each.
    seated = store(seated)
    drop(one, joined)
    here = seen_table(seated.select(F.xxhash64("doc_id").alias("h")))
    sets = (base.filter(here(F.xxhash64("doc_id"))).join(seated, "doc_id").select("key", "text", "grp", "seats")
            .mapInArrow(_member_sets(gram), "key long, grams binary, grp long, seats array<struct<i:int,j:int,side:int>>"))
    dealt = sets.select("grp", F.explode("seats").alias("s"), "key", "grams").select("grp", "s.i", "s.j", "s.side", "key", "grams")
    edges = (dealt.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
             .mapInArrow(_group_links(percent), "a long, b long"))
    classes = components(edges).select(F.col("node").alias("key"), "root")
    drop(seated)

    # Back to documents: the least id of all sets of a class.
    least = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    named = least.join(classes, "key", "left").withColumn("root", F.coalesce("root", "key"))
    first = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_key = named.join(first, "root").select("key", "component_id")
    return (rows.join(of_key, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def first_of_class(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id names their class: one document of each group stays, all others' columns kept.

    An id stands for all its rows: they stay or go together.  Documents without words all stay,
    rows without an id too.
    """
    classes = similar_classes(docs, id_col, **options)
    name = free_prefix(docs.columns, "gone_id")
    gone = classes.filter("n_shingles > 0 and component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, quoted(id_col) == F.col(name), "left_anti")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
