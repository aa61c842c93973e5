"""Merkle manifest of a dataset: a proof for every row, by streaming append with incremental witnesses.

Rows are appended in order to the tree of their group.  An appender keeps the open subtrees of
an aligned block; a new node starts its witness with the siblings before it, and each sibling
completed later extends the witnesses of the nodes before it.  Blocks are appended to side by
side; their roots are appended in turn to the next round's blocks, until each group has one
root, and the groups' roots are appended to the last tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.common import quoted, save
from coverlens.operators.ordered import running_scan

FANOUT = 8
#: Levels of one block: a task holds the nodes of one block of ``FANOUT ** BLOCK_LEVELS`` at a time.
BLOCK_LEVELS = 4
#: What the leaves of a document cover, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


class Subtree:
    """A completed subtree: its digest, the siblings around it so far, and the subtree it became part of."""

    __slots__ = ("above", "digest", "left", "right")

    def __init__(self, digest: bytes, left: list[bytes]):
        self.digest, self.left, self.right, self.above = digest, left, [], None

    def witness(self) -> bytes:
        """For each level up to the open end: own place, number of siblings, their digests from left to right."""
        out, at = [], self
        while at.above is not None:
            out += [bytes((len(at.left), len(at.left) + len(at.right))), *at.left, *at.right]
            at = at.above
        return b"".join(out)


class Appender:
    """The open subtrees of one aligned block of at most ``fanout ** height`` leaves."""

    def __init__(self, height: int, fanout: int = FANOUT):
        self.height, self.fanout = height, fanout
        self.open: list[list[Subtree]] = [[] for _ in range(height + 1)]

    def append(self, digest: bytes) -> Subtree:
        """A leaf; its witness grows while later leaves arrive."""
        return self._complete(0, digest)

    def _complete(self, level: int, digest: bytes) -> Subtree:
        run = self.open[level]
        new = Subtree(digest, [s.digest for s in run])
        for s in run:
            s.right.append(digest)
        run.append(new)
        if level < self.height and len(run) == self.fanout:
            self._close(level)
        return new

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        above = self._complete(level + 1, node_digest([s.digest for s in run]))
        for s in run:
            s.above = above

    def finish(self) -> bytes:
        """Close what is open, short runs included; the block's root."""
        for level in range(self.height):
            if self.open[level]:
                self._close(level)
        return self.open[self.height][0].digest


def node_digest(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def levels_of(n: int, fanout: int = FANOUT) -> int:
    """Levels above ``n`` leaves until one node remains."""
    up = 0
    while n > 1:
        n, up = -(-n // fanout), up + 1
    return up


def siblings(witness: bytes) -> Iterator[tuple[int, bytes]]:
    """(own place, joined digests of the siblings) from the lowest level up."""
    at = 0
    while at < len(witness):
        end = at + 2 + DIGEST * witness[at + 1]
        yield witness[at], witness[at + 2:end]
        at = end


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for place, others in siblings(witness):
        leaf = hashlib.sha256((others[:DIGEST * place].hex() + leaf.hex() + others[DIGEST * place:].hex()).encode()).digest()
    return leaf


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (binary) of the values in order: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                                     for t in texts]).cast("binary"), 256))


def _append(fanout: int, levels: int):
    """Mapper over nodes (tree, block, pos, size, digest, ...) in order: each node's witness, and each block's root (null pos).

    Further columns stay with their nodes.
    """
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        block, open_to, nodes, schema = None, None, [], None

        def closed() -> list[tuple]:
            root = open_to.finish()
            out = [(*block[:2], pos, block[2], None, *rest, s.witness()) for pos, rest, s in nodes]
            return [*out, (*block[:2], None, -(-block[2] // fanout**levels), root, *(None for _ in nodes[0][1]), None)]

        def made(rows: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            schema = pa.schema([pa.field(f.name, f.type) for f in batch.schema] + [pa.field("witness", pa.binary())])
            out: list[tuple] = []
            for tree, at, pos, size, digest, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block is None or (tree, at) != block[:2]:
                    out += closed() if block else []
                    block, nodes = (tree, at, size), []
                    open_to = Appender(min(levels, levels_of(size, fanout)), fanout)
                nodes.append((pos, rest, open_to.append(digest)))
            yield made(out)
        if block:
            yield made(closed())

    return run


def append_all(nodes: DataFrame, fanout: int = FANOUT, levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Nodes (tree, pos from 0, size of the tree, digest, further columns) with their witness instead of the digest, and roots (tree, digest).

    A round deals the nodes into aligned blocks and appends to all of them at once; the blocks'
    roots are the next round's nodes.  Rounds go on until each tree is one node, which takes the
    logarithm of the largest tree to the base ``fanout ** levels``.
    """
    wide = fanout**levels
    rounds, more = [], True
    extra = [c for c in nodes.columns if c not in ("tree", "pos", "size", "digest")]
    carried = extra
    while more:
        dealt = nodes.select("tree", F.floor(F.col("pos") / wide).cast("long").alias("block"), "pos", "size", "digest", *extra)
        out = save(dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(
            _append(fanout, levels), ", ".join(f"{c} {t}" for c, t in [*dealt.dtypes, ("witness", "binary")])))
        rounds.append(out.filter("pos is not null").select("tree", "block", "pos", *extra, "witness"))
        nodes, extra = out.filter("pos is null").select("tree", F.col("block").alias("pos"), "size", "digest"), []
        more = nodes.filter("size > 1").limit(1).count() > 0
    whole = rounds.pop()
    while rounds:
        above = whole.select("tree", F.col("pos").alias("block"), F.col("witness").alias("rest"))
        whole = rounds.pop().join(above, ["tree", "block"]).withColumn("witness", F.concat("witness", "rest"))
    return whole.select("tree", "pos", *carried, "witness"), nodes.select("tree", "digest")


def _prove(batches: Iterable) -> Iterator:
    """Mapper: (id, leaf, given, subroot, root, witness) -> the proof's digest and the root that ``given`` folds to."""
    import pyarrow as pa

    for batch in batches:
        ids, *cols = (batch.column(i) for i in range(6))
        rows = list(zip(*(c.to_pylist() for c in cols), strict=True))
        folded = [fold(given, w) for _, given, _, _, w in rows]
        proofs = [hashlib.sha256("".join(s.hex() for _, s in siblings(w)).encode()).hexdigest() for *_, w in rows]
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array([r[i].hex() for r in rows], pa.string()) for i in (0, 2, 3)), pa.array(proofs, pa.string()),
             pa.array([f.hex() for f in folded], pa.string()),
             pa.array([f == r[3] for f, r in zip(folded, rows, strict=True)], pa.bool_()),
             batch.column(5)],
            ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "witness"])


def manifest(df: DataFrame, by: str = "lang", order: str = "doc_id", columns: Sequence[str] = COLUMNS,
             given: Mapping[str, Column] | None = None, fanout: int = FANOUT, levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``df``: ``id`` (the ``order`` column), leaf, subroot, root, proof_sha256, folded_root, verified, witness.

    A row's leaf is the digest of ``columns``.  The leaves of each value of ``by`` ascend by
    ``order`` in one tree; the trees' roots, ordered by the UTF-8 bytes of ``by`` with null
    first, are the leaves of the last tree.  ``witness`` holds place and siblings for each
    level from the leaf to the root.  ``given`` names columns whose received value is another
    expression: the leaf made of them is folded with the row's witness, and ``verified`` says
    whether it leads to the root.  ``by`` is compared as text.

    Nulls: a null value is a value of its own in leaves, groups and order (first).  Rows that
    tie in ``order`` follow their leaves, so equal rows may stand in either place with equal
    results but for place.  Repeated rows are leaves of their own; texts of any length are
    hashed whole.  An empty table gives no rows; other columns are not read.

    Skew: a group of any size spans as many blocks as it has nodes.  A task holds one block
    (``fanout ** levels`` nodes); nothing is broadcast by force or collected.
    """
    own = {c.lower(): quoted(c) for c in df.columns}
    values = [own[c.lower()] for c in columns]
    given = {k.lower(): v for k, v in (given or {}).items()}
    key = own[by.lower()].cast("string")
    leaves = save(df.select(
        own[order.lower()].alias("id"), F.when(key.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), key)).alias("tree"),
        leaf_digest(values).alias("leaf"), leaf_digest([given.get(c.lower(), v) for c, v in zip(columns, values, strict=True)]).alias("given")))
    numbered = running_scan(leaves, ["tree"], ["id", "leaf"], ordinal="n", group_size="size")
    nodes = numbered.select("tree", (F.col("n") - 1).alias("pos"), "size", F.col("leaf").alias("digest"), "id", "leaf", "given")
    witnesses, subroots = append_all(nodes, fanout, levels)
    subroots = save(subroots)
    trees = save(running_scan(subroots.withColumn("all", F.lit("")), ["all"], ["tree"], ordinal="n", group_size="size"))
    tops, root = append_all(trees.select(F.col("all").alias("tree"), (F.col("n") - 1).alias("pos"), "size", "digest"), fanout, levels)
    top = (trees.select(F.col("all"), F.col("tree"), (F.col("n") - 1).alias("pos"), F.col("digest").alias("subroot"))
           .join(tops.select(F.col("tree").alias("all"), "pos", F.col("witness").alias("rest")), ["all", "pos"])
           .join(root.select(F.col("tree").alias("all"), F.col("digest").alias("root")), "all")
           .select("tree", "subroot", "rest", "root"))
    proven = (witnesses.join(top, "tree")
              .select("id", "leaf", "given", "subroot", "root", F.concat("witness", "rest").alias("witness")))
    kind = dict(proven.dtypes)["id"]
    return proven.mapInArrow(_prove, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                                     "verified boolean, witness binary")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``; every third row (by crc32 of its id) is checked with its text's A-Z lower-cased."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    given = {"text": F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))}
    return (manifest(docs, given=given)
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


OP11_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM crc_table),
src AS (
  SELECT row_number() OVER () AS n, doc_id, source, lang, n_chars, text,
         coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0, false) AS tampered
  FROM documents, crc),
enc AS (
  SELECT n, doc_id, lang,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    text, CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS given
  FROM src),
leaf AS (
  SELECT n, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
         sha256(head || coalesce(strlen(given) || ':' || given, '-')) AS g FROM enc),
nodes AS (
  SELECT 0 AS level, coalesce('1' || lang, '0') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, h
  FROM leaf
  UNION ALL
  SELECT level + 1, tree, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM nodes) WHERE size > 1 GROUP BY level, tree, pos // 8),
sub AS (SELECT tree, max(level) AS height, arg_max(h, level) AS subroot FROM nodes GROUP BY tree),
tops AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS pos, subroot AS h FROM sub
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS size FROM tops) WHERE size > 1 GROUP BY level, pos // 8),
top AS (SELECT max(level) AS height, arg_max(h, level) AS root FROM tops),
runs AS (
  SELECT tree, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM nodes JOIN sub USING (tree) WHERE level < height GROUP BY ALL
  UNION ALL
  SELECT '', level, pos // 8, list(h ORDER BY pos) FROM tops, top WHERE level < height GROUP BY ALL),
spot AS (
  SELECT n, doc_id, coalesce('1' || lang, '0') AS tree, h, g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaf),
rank AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS rank, height, subroot FROM sub),
fold AS (
  SELECT n, 0 AS step, tree, rank, r.height AS below, r.height + t.height AS steps, pos, g AS cur, '' AS proof
  FROM spot JOIN rank r USING (tree), top t
  UNION ALL
  SELECT f.n, step + 1, f.tree, rank, below, steps,
         place // 8, sha256(array_to_string(list_slice(hs, 1, place % 8), '') || cur || array_to_string(list_slice(hs, place % 8 + 2, 8), '')),
         proof || array_to_string(list_slice(hs, 1, place % 8), '') || array_to_string(list_slice(hs, place % 8 + 2, 8), '')
  FROM (SELECT *, CASE WHEN step = below THEN rank ELSE pos END AS place,
               CASE WHEN step < below THEN tree ELSE '' END AS t, CASE WHEN step < below THEN step ELSE step - below END AS l FROM fold) f
  JOIN runs ON runs.tree = f.t AND runs.level = f.l AND runs.run = f.place // 8
  WHERE step < steps)
SELECT p.doc_id, p.h AS leaf, r.subroot, top.root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = top.root AS verified
FROM spot p JOIN rank r USING (tree) JOIN fold f ON f.n = p.n AND f.step = f.steps, top
"""
