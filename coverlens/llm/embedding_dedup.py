"""Embedding near-dedup: cross-polytope hashing with multiprobe buckets and verified pairs.

A vector is turned by a random rotation (three rounds of sign flips and a fast Hadamard
transform); its hash is the closest of the axes and their opposites.  A few such hashes
together name a bucket of a table; each vector stands in the buckets of its closest few axis
combinations.  Vectors that share a bucket are compared by their cosine in double precision.
Links are counted, and only a spanning forest of them leaves a bucket.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.common import components, quoted, save
from coverlens.llm.ngram_join import spanning_forest

THRESHOLD = 0.9
#: Axis combinations that a vector is filed under in each table.
PROBES = 6
#: Vectors wanted in a bucket at most, on average; fixes how many hashes make a bucket's name.
BUCKET = 2048
#: Chance of missing a pair at exactly the threshold; fixes the number of tables.
MISS = 5e-4
BLOCK = 1024
SEED = 99


@dataclass(frozen=True)
class Index:
    hashes: int
    tables: int
    probes: int
    seed: int

    def signs(self, dim: int) -> np.ndarray:
        """Sign flips of all tables, hashes and rounds for vectors padded to ``dim`` (a power of two)."""
        rng = np.random.Generator(np.random.PCG64([self.seed, dim]))
        return rng.choice(np.array([-1.0, 1.0]), size=(self.tables, self.hashes, 3, dim))


def hadamard(a: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = a.shape
    h = 1
    while h < d:
        a = a.reshape(n, -1, 2, h)
        a = np.concatenate([a[:, :, :1] + a[:, :, 1:], a[:, :, :1] - a[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return a / math.sqrt(d)


def bucket_codes(x: np.ndarray, index: Index) -> np.ndarray:
    """(vectors, tables, probes) bucket numbers, closest axis combination first."""
    n, dim = x.shape
    size = 1 << max(1, (dim - 1).bit_length())
    x = np.concatenate([x, np.zeros((n, size - dim))], axis=1)
    near = min(3, size)
    combos = list(itertools.product(range(near), repeat=index.hashes))
    probes = min(index.probes, len(combos))
    out = np.empty((n, index.tables, probes), np.int64)
    for t, table in enumerate(index.signs(size)):
        tops, values = [], []
        for rounds in table:
            y = x
            for s in rounds:
                y = hadamard(y * s)
            size_of = np.abs(y)
            top = np.argsort(-size_of, axis=1, kind="stable")[:, :near]
            values.append(np.take_along_axis(size_of, top, 1))
            tops.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
        cost = np.stack([sum((v[:, 0] - v[:, j]) ** 2 for v, j in zip(values, c, strict=True)) for c in combos], 1)
        code = np.stack([sum(a[:, j].astype(np.int64) * (2 * size) ** k for k, (a, j) in enumerate(zip(tops, c, strict=True)))
                         for c in combos], 1)
        out[:, t] = np.take_along_axis(code, np.argsort(cost, axis=1, kind="stable")[:, :probes], 1)
    return out


def plan_index(n: int, dim: int, threshold: float = THRESHOLD, probes: int = PROBES, bucket: int = BUCKET, miss: float = MISS,
               seed: int = SEED) -> Index:
    """Hashes for a bucket's name from the number of vectors; tables from the collision rate of pairs at the threshold.

    The rate is measured on random pairs whose cosine is exactly the threshold.
    """
    size = 1 << max(1, (dim - 1).bit_length())
    hashes = max(2, math.ceil(math.log(max(n, 2) / bucket) / math.log(2 * size)))
    rng = np.random.Generator(np.random.PCG64(seed))
    x, r = rng.normal(size=(2, 2000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r -= (r * x).sum(1, keepdims=True) * x
    r /= np.maximum(np.linalg.norm(r, axis=1, keepdims=True), 1e-12)
    trial = Index(hashes, 2, probes, seed)
    a, b = bucket_codes(x, trial), bucket_codes(threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * r, trial)
    rate = float((a[:, :, :, None] == b[:, :, None, :]).any((2, 3)).mean())
    tables = math.ceil(math.log(miss) / math.log(max(1e-9, 1 - min(rate, 1 - 1e-9))))
    return Index(hashes, max(2, tables), probes, seed)


def _clean(batches: Iterable) -> Iterator:
    """Mapper: (id, vector) -> id, key of the vector's values (null when it links with nothing), length, values as given."""
    import pyarrow as pa

    for batch in batches:
        keys, sizes, blobs = [], [], []
        named = batch.column(0).is_valid().to_pylist()
        for ok, v in zip(named, batch.column(1), strict=True):
            v = v.values if ok and v.is_valid else None
            x = None
            if v is not None and len(v) and not v.null_count:
                x = v.to_numpy(zero_copy_only=False)
                x = x.astype(np.float32 if x.dtype == np.float32 else np.float64) + x.dtype.type(0)  # no negative zeros
                x = x if np.isfinite(x).all() and x.any() else None
            keys.append(None if x is None else hashlib.blake2b(x.tobytes(), digest_size=16).digest())
            sizes.append(None if x is None else len(x))
            blobs.append(None if x is None else x.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
                                          pa.array(blobs, pa.binary())], ["vec_id", "key", "dim", "vec"])


def _unit(blobs: list[bytes], dim: int) -> np.ndarray:
    """Vectors of one length scaled to length 1, in double precision."""
    kind = np.float32 if len(blobs[0]) == 4 * dim else np.float64
    x = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _file(index: Index):
    """Mapper: (rep, copies, dim, vec) -> a row for each table and probe, with all codes of the vector."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                dims = batch.column(2).to_numpy()
                for dim in np.unique(dims):
                    part = batch.filter(pa.array(dims == dim))
                    codes = bucket_codes(_unit(part.column(3).to_pylist(), int(dim)), index)
                    n, tables, probes = codes.shape
                    each = np.repeat(np.arange(n), tables * probes)
                    blobs = pa.array([c.tobytes() for c in codes], pa.binary())
                    rows = part.take(pa.array(each))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, blobs.take(pa.array(each)), pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes), n)),
                         pa.array(codes.reshape(-1))], ["rep", "copies", "dim", "vec", "codes", "t", "code"])

    return run


def _verify(threshold: float, tables: int):
    """Mapper over rows of (t, dim, code, i, j) in order: links counted where first met, and spanning edges."""
    def group(name: tuple, rows: list[tuple]) -> list[tuple]:
        rows = sorted({r[:2]: r for r in rows}.values(), key=lambda r: r[:2])
        left, right = [r for r in rows if r[0] == 0], [r for r in rows if r[0] == 1]
        if len(rows) < 2 or not left or (name[3] != name[4] and not right):
            return []
        x = _unit([r[3] for r in rows], name[1])
        codes = np.frombuffer(b"".join(r[4] for r in rows), np.int64).reshape(len(rows), tables, -1)
        copies = np.array([r[2] for r in rows], np.int64)
        ids = [r[1] for r in rows]
        k = len(left)
        if right:
            a, b = np.nonzero(x[:k] @ x[k:].T >= threshold)
            b = b + k
        else:
            a, b = np.nonzero(np.triu(x @ x.T >= threshold, 1))
        new = np.ones(len(a), bool)
        for t in range(name[0] + 1):  # a pair counts in the first bucket that both stand in
            met = codes[a, t][:, :, None] == codes[b, t][:, None, :]
            if t == name[0]:
                met &= (codes[a, t] < name[2])[:, :, None]
            new &= ~met.any((1, 2))
        a, b = a[new], b[new]
        if not len(a):
            return []
        count = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        out = [(ids[i], None, int(c)) for i, c in enumerate(count) if c]
        return out + [(ids[p], ids[q], 0) for p, q in spanning_forest(a, b, len(rows))]

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        def made(out: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["a", "b", "n"])

        now, rows = None, []
        for batch in batches:
            out: list[tuple] = []
            for t, dim, code, i, j, *row in zip(*(batch.column(c).to_pylist() for c in range(10)), strict=True):
                if (t, dim, code, i, j) != now:
                    out += group(now, rows) if rows else []
                    now, rows = (t, dim, code, i, j), []
                rows.append(tuple(row))
            yield made(out)
        yield made(group(now, rows) if rows else [])

    return run


def near_copies(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                block: int = BLOCK, **tuning) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept.

    Two vectors link when their cosine is at least ``threshold``; ``n_links`` counts the other
    rows linked directly, copies included; ``component_id`` is the least id reachable by links,
    itself included.  A vector that is null, empty, zero, or holds a null or a value that is not
    finite links with nothing, nor does a row without id (its component is null).  Vectors of
    unlike lengths do not link.  Repeated rows are rows of their own.  Other columns are left
    out; an empty table gives no rows.

    Equal vectors are one from the start and count by their number.  Every row is filed; a pair
    at exactly the threshold is missed with a chance of ``miss``, closer ones less.  A bucket of
    any size is handled: it is dealt into blocks, and each pair of blocks is a task of its own.
    """
    rows = save(df.select(quoted(id_col).cast("long").alias("vec_id"), quoted(vec_col).alias("v")).mapInArrow(
        _clean, "vec_id long, key binary, dim int, vec binary"))
    usable = rows.filter("key is not null")
    reps = save(usable.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                          F.first("dim").alias("dim"), F.first("vec").alias("vec")))
    n, dim = reps.agg(F.count(F.lit(1)), F.max("dim")).first()
    index = plan_index(n, dim or 2, threshold, **tuning)
    filed = reps.select("rep", "copies", "dim", "vec").mapInArrow(
        _file(index), "rep long, copies long, dim int, vec binary, codes binary, t int, code long")
    name = ["t", "dim", "code"]
    sizes = (reps.select("rep", "copies", "dim", "vec").mapInArrow(
        _file(index), "rep long, copies long, dim int, vec binary, codes binary, t int, code long")
        .groupBy(*name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(*name, F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks")).cast("int")
    dealt = (filed.join(sizes, name).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*name, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     (F.col("mine") > F.col("other")).cast("int").alias("side"), "rep", "copies", "vec", "codes"))
    found = save(dealt.repartition(*name, "i", "j").sortWithinPartitions(*name, "i", "j")
                 .mapInArrow(_verify(threshold, index.tables), "a long, b long, n long"))
    counts = found.groupBy("a").agg(F.sum("n").alias("n")).select(F.col("a").alias("rep"), "n")
    classes = components(found.filter("b is not null").select("a", "b")).select(F.col("node").alias("rep"), "root")
    known = (reps.select("key", "rep", "copies").join(counts, "rep", "left").join(classes, "rep", "left")
             .select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("root", "rep").alias("component_id")))
    return (rows.join(known, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
