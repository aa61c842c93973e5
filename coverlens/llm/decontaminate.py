"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The patterns are the windows of ``width`` consecutive words of the benchmark items (an item
of fewer words is one window).  A shift table over blocks of words tells how far a text
position can move on without missing a window's end; where it says 0, the bucket of windows
ending in that block is looked up by its hash and each window is compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.common import quoted
from coverlens.llm.words import ALNUM, U, mix, utf8, word_hashes

WIDTH = 10
#: Words of a block; shorter windows use blocks of their own length.
BLOCK = 3
#: Benchmark words of one broadcast pattern set.  A larger benchmark is searched in several sets.
SET_WORDS = 400_000
_TABLE = 1 << 16
#: Text positions that one lane walks through; all lanes of a batch step together.
_LANE = 256


@dataclass
class PatternSet:
    """Windows of one length: their words, the tables, and the items that each belongs to."""

    length: int
    block: int
    words: np.ndarray  # (windows, length) word hashes, sorted by the hash of the last block
    suffix: np.ndarray  # those hashes
    shift: np.ndarray
    first: np.ndarray  # items of window i: items[first[i]:first[i + 1]]
    items: np.ndarray


def _blocks(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of ``size`` words that ends at each word of the last axis (from word ``size - 1`` on)."""
    n = words.shape[-1] - size + 1
    h = np.zeros((*words.shape[:-1], n), np.uint64)
    for i in range(size):
        h = (h ^ (h >> U(31))) * U(0x9E3779B97F4A7C15) + words[..., i:i + n]
    return mix(h)


def build_sets(items: list[tuple[str | None, np.ndarray]], width: int = WIDTH) -> list[PatternSet]:
    """Tables for the windows of ``items`` (id, word hashes).  Windows of one length share their tables."""
    by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
    for k, (_, w) in enumerate(items):
        if len(w):
            m = min(width, len(w))
            by_length.setdefault(m, []).append((np.lib.stride_tricks.sliding_window_view(w, m), k))
    sets = []
    for m, found in sorted(by_length.items()):
        rows = np.concatenate([w for w, _ in found])
        owner = np.concatenate([np.full(len(w), k) for w, k in found])
        rows, inverse = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([inverse.reshape(-1), owner], 1), axis=0)
        size = min(BLOCK, m)
        blocks = _blocks(rows, size)
        order = np.argsort(blocks[:, -1], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pairs = pairs[np.argsort(place[pairs[:, 0]], kind="stable")]
        shift = np.full(_TABLE, m - size + 1, np.int64)
        for j in range(m - size + 1):  # left to right: the rightmost occurrence of a block decides
            shift[(blocks[:, j] % U(_TABLE)).astype(np.int64)] = np.minimum(
                shift[(blocks[:, j] % U(_TABLE)).astype(np.int64)], m - size - j)
        sets.append(PatternSet(m, size, rows[order], blocks[order, -1], shift,
                               np.searchsorted(place[pairs[:, 0]], np.arange(len(order) + 1)), pairs[:, 1]))
    return sets


def search(words: np.ndarray, p: PatternSet) -> tuple[np.ndarray, np.ndarray]:
    """(last word, window) of every occurrence of a window of ``p`` in ``words``."""
    ends, found = [], []
    pos = np.arange(p.length - 1, len(words), _LANE)
    stop = np.minimum(pos + _LANE, len(words))
    while len(pos):
        h = np.zeros(len(pos), np.uint64)
        for i in range(p.block):
            h = (h ^ (h >> U(31))) * U(0x9E3779B97F4A7C15) + words[pos - (p.block - 1 - i)]
        h = mix(h)
        step = p.shift[(h % U(_TABLE)).astype(np.int64)]
        hit = np.flatnonzero(step == 0)
        if len(hit):
            lo = np.searchsorted(p.suffix, h[hit])
            count = np.searchsorted(p.suffix, h[hit], "right") - lo
            at = np.repeat(pos[hit], count)
            if len(at):
                window = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
                for j in range(p.length):  # direct comparison, word by word
                    same = words[at - j] == p.words[window, p.length - 1 - j]
                    at, window = at[same], window[same]
                ends.append(at)
                found.append(window)
        pos = pos + np.maximum(step, 1)
        keep = pos < stop
        pos, stop = pos[keep], stop[keep]
    if not ends:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(ends), np.concatenate(found)


def _item_sets(benchmark: DataFrame, id_col: str, text_col: str, set_words: int) -> Iterator[list[tuple]]:
    """The benchmark's items, some at a time, each set within ``set_words`` words (or one longer item); one set at least."""
    rows = benchmark.select(quoted(id_col).cast("string").alias("id"), quoted(text_col).alias("text")).dropna(subset=["text"])
    items, size, any_set = [], 0, False
    for r in rows.toLocalIterator():
        w, _ = word_hashes([r.text.encode("utf-8", "surrogatepass")], ALNUM)
        if items and size + len(w) > set_words:
            yield items
            items, size, any_set = [], 0, True
        items.append((r.id, w))
        size += len(w)
    if items or not any_set:
        yield items


OUT = "n_words long, n_hit long, items array<string>, spans array<long>"


def find_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", width: int = WIDTH, set_words: int = SET_WORDS) -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit, items (ids as strings, sorted) and spans.

    ``spans`` holds first and last word of each run of hit words, flat, in order; ``n_hit`` is
    the number of words in them.  A null text has no words; a benchmark row with a null text
    has no windows, one with a null id marks words but names no item; repeated items are one.
    Input columns called like a result are replaced, all others (with their rows, repeated or
    not) stay.  An empty benchmark hits nothing.

    The pattern tables are broadcast in sets of at most ``set_words`` benchmark words, so what
    a worker holds is bounded whatever the benchmark's size; the texts pass once through each
    set.  Nothing is shuffled.
    """
    names = [x.split()[0] for x in OUT.split(", ")]
    keep = [c for c in docs.columns if c.lower() not in names]
    df = docs.select(*[quoted(c) for c in keep], F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                     F.array().cast("array<string>").alias("items"), F.array().cast("array<long>").alias("spans"))
    spark = docs.sparkSession
    text_at = [c.lower() for c in keep].index(text_col.lower())
    for items in _item_sets(benchmark, item_id, item_text, set_words):
        tables = spark.sparkContext.broadcast(([i for i, _ in items], build_sets(items, width)))
        df = df.mapInArrow(_scanner(tables, text_at, len(keep)), df.schema)
    return df


def _scanner(tables, text_at: int, keep: int):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        ids, sets = tables.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                words, bounds = word_hashes(utf8(batch.column(text_at)), ALNUM)
                n = batch.num_rows
                hits, owned = _hits(words, bounds, sets)
                earlier = batch.column(keep + 3).to_pylist(), batch.column(keep + 2).to_pylist()
                n_hit, items, spans = [], [], []
                for d in range(n):
                    mask = hits[bounds[d]:bounds[d + 1]]
                    if earlier[0][d]:
                        for a, b in zip(earlier[0][d][::2], earlier[0][d][1::2], strict=True):
                            mask[a:b + 1] = True
                    edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
                    spans.append((edge - np.arange(len(edge)) % 2).tolist())
                    n_hit.append(int(mask.sum()))
                    mine = {ids[k] for k in owned.get(d, ())} - {None}
                    items.append(sorted(mine.union(earlier[1][d])))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:keep], pa.array(np.diff(bounds), pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.int64()))],
                    names=batch.schema.names)

    return run


def _hits(words: np.ndarray, bounds: np.ndarray, sets: list[PatternSet]) -> tuple[np.ndarray, dict[int, list[int]]]:
    """Hit words of a batch, and the items found in each of its texts."""
    cover = np.zeros(len(words) + 1, np.int64)
    owned: dict[int, list[int]] = {}
    for p in sets:
        end, window = search(words, p)
        doc = np.searchsorted(bounds, end, "right") - 1
        inside = end - p.length + 1 >= bounds[doc]  # not across two texts
        end, window, doc = end[inside], window[inside], doc[inside]
        np.add.at(cover, end - p.length + 1, 1)
        np.add.at(cover, end + 1, -1)
        if len(end):
            count = p.first[window + 1] - p.first[window]
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(p.first[window], count)
            for d, k in np.unique(np.stack([np.repeat(doc, count), p.items[at]], 1), axis=0).tolist():
                owned.setdefault(d, []).append(k)
    return np.cumsum(cover[:-1]) > 0, owned


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with their own columns.

    The operator's answer for a corpus; a document with a hit word goes whole.
    """
    mine = {c: f"c{i}_{c}" for i, c in enumerate(docs.columns)}
    text = next(v for k, v in mine.items() if k.lower() == text_col.lower())
    found = find_items(docs.select(*[quoted(k).alias(v) for k, v in mine.items()]), benchmark, text_col=text, **options)
    return found.filter("n_hit = 0").select(*[quoted(v).alias(k) for k, v in mine.items()])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP10_SQL = r"""
WITH dw AS (
  SELECT n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS n, doc_id, text FROM documents)),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
pat AS (
  SELECT DISTINCT id, least(10, len(w)) AS m, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS p
  FROM (SELECT id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
win AS (
  SELECT n, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS p
  FROM (SELECT n, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, (SELECT DISTINCT m FROM pat) WHERE len(w) >= m)),
hit AS (SELECT win.n, win.i, win.m, pat.id FROM win JOIN pat ON win.p = pat.p AND win.m = pat.m),
words AS (SELECT n, count(DISTINCT k) AS n_hit FROM (SELECT n, unnest(range(i, i + m)) AS k FROM hit) GROUP BY n),
its AS (SELECT n, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT n, id FROM hit WHERE id IS NOT NULL) GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (n) LEFT JOIN its USING (n)
"""
