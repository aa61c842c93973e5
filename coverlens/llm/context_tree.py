"""LM scoring by context-tree weighting over bytes.

Each byte is eight binary decisions; each decision has a tree of contexts, the bytes before
it, nearest first.  A node holds how often the decision went either way in its context and
their Krichevsky-Trofimov probability; from the leaves down to the root each node weighs its
own estimate against what its children make of the same decisions.  A text's probability mixes
the estimates of all depths along its path with these weights; its code length is minus the
logarithm.

The text is dealt into chunks.  A chunk asks for each of its distinct (context, byte) pairs
and words once, packed by hash buckets; buckets add up the counts of all chunks, the tree is
built and walked by context, and the answers go back to the chunks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.common import quoted, save
from coverlens.llm.words import U, mix, utf8, word_hashes

DEPTH = 5
#: Bytes of text in a chunk, on average; a chunk's texts and answers are in one task's memory.
CHUNK_BYTES = 16 << 20
#: Bytes of text whose contexts are laid out at once.
PIECE = 1 << 22
#: Ends a text; no byte of UTF-8.
END = b"\xff"
LN2 = math.log(2)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SMALL = 4096
_HALF = math.lgamma(0.5) + np.concatenate([[0.0], np.cumsum(np.log(np.arange(_SMALL - 1) + 0.5))])
_WHOLE = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, _SMALL)))])


def _lgamma(n: np.ndarray, add: float, small: np.ndarray) -> np.ndarray:
    """log Gamma(n + add) for whole n >= 0 (add 0.5 or 1): a table, and Stirling's series beyond it."""
    x = np.maximum(n, _SMALL // 2) + add
    far = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < _SMALL, small[np.minimum(n, _SMALL - 1).astype(np.int64)], far)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of ``a`` zeros and ``b`` ones."""
    return _lgamma(a, 0.5, _HALF) + _lgamma(b, 0.5, _HALF) - 2 * math.lgamma(0.5) - _lgamma(a + b, 1.0, _WHOLE)


def byte_grams(texts: Sequence[bytes | memoryview | None], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces (codes, texts, starts): one code for each byte and end of a text, A-Z folded.

    A code holds ``depth`` bytes of context, the nearest highest, and the byte itself lowest; a
    text is preceded by zeros.  Codes from ``starts[i]`` on belong to text ``texts[i]``.
    """
    todo, size = [], 0

    def made() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        buf = np.take(_FOLD, np.frombuffer(b"".join(x for _, left, body in todo for x in (left, body)), np.uint8)).astype(np.uint64)
        n = np.array([len(body) for _, _, body in todo])
        code = np.zeros(len(buf) - depth, np.uint64)
        for j in range(1, depth + 1):
            code = (code << U(8)) | buf[depth - j:len(buf) - j]
        code = (code << U(8)) | buf[depth:]
        starts = np.cumsum(n) - n
        return code[np.arange(n.sum()) + np.repeat(depth * np.arange(len(n)), n)], np.array([d for d, _, _ in todo]), starts

    for d, text in enumerate(texts):
        text = b"" if text is None else text
        for at in range(0, max(len(text), 1), PIECE):
            to = min(at + PIECE, len(text))
            left = (bytes(depth) + bytes(text[max(0, at - depth):at]))[-depth:]
            todo.append((d, left, bytes(text[at:to]) + (END if to == len(text) else b"")))
            size += to - at + 1
            if size >= PIECE:
                yield made()
                todo, size = [], 0
    if todo:
        yield made()


def _add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def chunk_counts(texts: Sequence, learn: np.ndarray, depth: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Distinct (context, byte) codes (kind 0) and word hashes (kind 1) of all texts, counted in those to learn from."""
    keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for codes, owner, starts in byte_grams(texts, depth):
        mark = np.repeat(learn[owner].astype(np.uint64), np.diff(np.append(starts, len(codes))))
        u, n = np.unique((codes << U(1)) | mark, return_counts=True)
        keys.append(u >> U(1))
        counts.append(n * (u & U(1)).astype(np.int64))
    words, bounds = word_hashes(texts)
    return {0: _add_up(np.concatenate(keys), np.concatenate(counts)),
            1: _add_up(words, np.repeat(learn.astype(np.int64), np.diff(bounds)))}


def subtrees(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> dict[tuple[int, int], tuple]:
    """Nodes of depths ``top`` to ``depth``, for each of the eight decisions: (nodes, zeros, ones, log weighted probability, own weight).

    A node is its context and the bits of the byte known before the decision: context * 256 + 1bits.
    """
    out: dict[tuple[int, int], tuple] = {}
    ctx, byte = keys >> U(8), keys & U(255)
    for d in range(depth, top - 1, -1):
        pair, n = _add_up(((ctx >> U(8 * (depth - d))) << U(8)) | byte, counts)
        for j in range(8):
            node = ((pair >> U(8)) << U(8)) | (U(1) << U(j)) | ((pair & U(255)) >> U(8 - j))
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.empty(0, np.int64)
            one = ((pair >> U(7 - j)) & U(1)).astype(np.int64)
            a, b = (np.add.reduceat(x, first) if len(first) else n for x in (n * (1 - one), n * one))
            node = node[first]
            own = log_kt(a, b)
            if d == depth:
                out[d, j] = node, a, b, own, np.ones(len(node))
                continue
            below, _, _, lw, _ = out[d + 1, j]
            parent = np.searchsorted(node, ((below >> U(16)) << U(8)) | (below & U(255)))
            out[d, j] = node, a, b, *_weigh(own, np.bincount(parent, lw, len(node)))
    return out


def _weigh(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability and own weight of nodes, from their own estimate and the sum over their children."""
    lw = np.logaddexp(own, below) - LN2
    return lw, np.exp(own - LN2 - lw)


def _blobs(table, col: str, kind=np.uint64) -> np.ndarray:
    got = [np.frombuffer(x, kind) for x in table.column(col).to_pylist()]
    return np.concatenate(got) if got else np.empty(0, kind)


def _of_kind(table, kind: int):
    import pyarrow.compute as pc

    return table.filter(pc.equal(table.column("kind"), kind))


def _table(schema: list[tuple], rows: list[tuple]):
    import pyarrow as pa

    return pa.table([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(schema)], names=[c for c, _ in schema])


def _packed(keys: np.ndarray, part: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
    """(part, keys, *values as bytes) for each part, keys in their order."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(first, np.append(first, len(part))[1:], strict=True):
        at = order[a:b]
        yield int(part[a]), keys[at].tobytes(), *(v[at].tobytes() for v in values)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(keys) % U(parts)).astype(np.int64)


def _ask(depth: int, buckets: int):
    """Group of a chunk's texts -> (bucket, kind, chunk, keys, counts)."""
    def run(table):
        import pyarrow as pa

        schema = [("bucket", pa.int32()), ("kind", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
        learn = np.array(table.column("learn").to_pylist(), bool)
        rows = []
        for kind, (keys, n) in chunk_counts(utf8(table.column("text")), learn, depth).items():
            rows += [(b, kind, table.column("chunk")[0].as_py(), k, c) for b, k, c in _packed(keys, _part(keys, buckets), n.astype(np.uint32))]
        return _table(schema, rows)

    return run


def _total(depth: int, top: int, parts: int):
    """Group of a bucket's requests -> totals (bucket, kind, part, keys, counts, tokens, distinct); codes also by their context's part."""
    def run(table):
        import pyarrow as pa

        schema = [("bucket", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
                  ("tokens", pa.int64()), ("distinct", pa.int64())]
        bucket, rows = table.column("bucket")[0].as_py(), []
        for kind in (0, 1):
            mine = _of_kind(table, kind)
            keys, n = _add_up(_blobs(mine, "keys"), _blobs(mine, "counts", np.uint32).astype(np.int64))
            if kind:
                rows.append((bucket, 1, None, keys.tobytes(), n.tobytes(), int(n.sum()), int((n > 0).sum())))
            else:
                rows += [(bucket, 0, p, k, c, 0, 0) for p, k, c in _packed(keys, _part(keys >> U(8 * (depth - top + 1)), parts), n)]
        return _table(schema, rows)

    return run


def _grow(depth: int, top: int):
    """Group of a part's codes -> nodes of depth ``top``: (part, node, a, b, lw)."""
    def run(table):
        import pyarrow as pa

        keys, n = _add_up(_blobs(table, "keys"), _blobs(table, "counts", np.int64))
        tree = subtrees(keys, n, depth, top)
        node, a, b, lw, _ = (np.concatenate([tree[top, j][i] for j in range(8)]) for i in range(5))
        part = np.full(len(node), table.column("part")[0].as_py(), np.int32)
        return pa.table([part, node.astype(np.int64), a.astype(np.int64), b.astype(np.int64), lw], names=["part", "node", "a", "b", "lw"])

    return run


def _weigh_rows(batches: Iterable) -> Iterator:
    """Mapper: (node, a, b, below) -> (node, lw, w, one): weighted probability, own weight, own estimate of a one."""
    import pyarrow as pa

    for x in batches:
        a, b = (x.column(i).to_numpy().astype(np.float64) for i in (1, 2))
        lw, w = _weigh(log_kt(a, b), x.column(3).to_numpy())
        yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), x.column(2), *(pa.array(v) for v in (lw, w, (b + 0.5) / (a + b + 1)))],
                                         ["node", "a", "b", "lw", "w", "one"])


def _upper(nodes: DataFrame, top: int) -> DataFrame:
    """(part, node, w, s) for the nodes of depth ``top``: weight left to them, and what the depths above contribute to a one."""
    levels, below = [], nodes
    parent = F.shiftleft(F.shiftright("node", 16), 8) + F.col("node").bitwiseAND(255)
    for _ in range(top):
        grouped = (below.groupBy(parent.alias("p")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("lw").alias("below"))
                   .withColumnRenamed("p", "node"))
        below = save(grouped.mapInArrow(_weigh_rows, "node long, a long, b long, lw double, w double, one double"))
        levels.append(below)
    walked = None
    for level in reversed(levels):
        if walked is None:
            left, so_far = F.lit(1.0), F.lit(0.0)
        else:
            level = level.withColumn("p", parent).join(walked, "p")
            left, so_far = F.col("left"), F.col("s")
        walked = save(level.select(F.col("node").alias("p"), (left * (1 - F.col("w"))).alias("left"),
                                   (so_far + left * F.col("w") * F.col("one")).alias("s")))
    return nodes.withColumn("p", parent).join(walked, "p").select("part", "node", F.col("left").alias("w"), "s")


def _walk(depth: int, top: int, buckets: int):
    """Groups of a part: codes with counts, and what the depths above give -> (bucket, kind, keys, values): log10 probabilities."""
    def run(codes, above):
        import pyarrow as pa

        schema = [("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("vals", pa.binary())]
        keys, n = _add_up(_blobs(codes, "keys"), _blobs(codes, "counts", np.int64))
        tree = subtrees(keys, n, depth, top)
        node = above.column("node").to_numpy().astype(np.uint64)
        order = np.argsort(node)
        node, left0, s0 = node[order], above.column("w").to_numpy()[order], above.column("s").to_numpy()[order]
        total = np.zeros(len(keys))
        for j in range(8):
            bits = (U(1) << U(j)) | ((keys & U(255)) >> U(8 - j))
            one = ((keys >> U(7 - j)) & U(1)).astype(bool)
            for d in range(top, depth + 1):
                at = ((keys >> U(8 * (depth - d + 1))) << U(8)) | bits
                if d == top:
                    i = np.searchsorted(node, at)
                    left, p = left0[i], s0[i]
                nodes, a, b, _, w = tree[d, j]
                i = np.searchsorted(nodes, at)
                p = p + left * w[i] * ((b[i] + 0.5) / (a[i] + b[i] + 1.0))
                left = left * (1 - w[i])
            total += np.log10(np.where(one, p, 1 - p))
        return _table(schema, [(b, 0, k, v) for b, k, v in _packed(keys, _part(keys, buckets), total)])

    return run


def _answer(requests, known):
    """Groups of a bucket: requests, and (kind, keys, values) -> (chunk, bucket, kind, values) for each request, in the order of its keys."""
    import pyarrow as pa

    schema = [("chunk", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("vals", pa.binary())]
    bucket, rows = requests.column("bucket")[0].as_py(), []
    for kind in (0, 1):
        mine = _of_kind(known, kind)
        keys, values = _blobs(mine, "keys"), _blobs(mine, "vals", np.float64)
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        asked = _of_kind(requests, kind)
        for chunk, blob in zip(asked.column("chunk").to_pylist(), asked.column("keys").to_pylist(), strict=True):
            rows.append((chunk, bucket, kind, values[np.searchsorted(keys, np.frombuffer(blob, np.uint64))].tobytes()))
    return _table(schema, rows)


def _score(depth: int, buckets: int, tokens: int, distinct: int, ends: int):
    """Groups of a chunk: texts and answers -> a row for each text."""
    def run(texts, answers):
        import pyarrow as pa

        raw = utf8(texts.column("text"))
        known = {}
        for kind, (keys, _) in chunk_counts(raw, np.zeros(len(raw), bool), depth).items():
            # The same keys as were asked for; answers come by bucket, in the keys' order.
            values = np.empty(len(keys))
            values[np.argsort(_part(keys, buckets), kind="stable")] = _blobs(_of_kind(answers, kind).sort_by("bucket"), "vals", np.float64)
            known[kind] = keys, values
        score = np.zeros(len(raw))
        for codes, owner, starts in byte_grams(raw, depth):
            p = known[0][1][np.searchsorted(known[0][0], codes)]
            np.add.at(score, owner, np.add.reduceat(p, starts))
        words, bounds = word_hashes(raw)
        c = known[1][1][np.searchsorted(known[1][0], words)] if len(words) else np.empty(0)
        each = np.concatenate([[0.0], np.cumsum(np.log10((c + 0.5) / (tokens + 0.5 * (distinct + 1))))])
        seen = np.concatenate([[0], np.cumsum(c > 0)])
        size = np.array([0 if x is None else len(x) for x in raw], np.int64)
        end = math.log10((ends + 0.5) / (tokens + 0.5 * (distinct + 1)))
        return pa.table([texts.column("id"), texts.column("learn"), np.diff(bounds) + 1, np.diff(seen[bounds]) + (ends > 0),
                         np.diff(each[bounds]) + end, score, size, -score / math.log10(2) / np.maximum(size, 1)],
                        names=["id", "learn", "n_tokens", "n_known", "base_score", "score", "n_bytes", "bits_per_byte"])

    return run


def score_texts(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``df``: id, learn, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    The model learns from the rows where ``learn`` is true (null counts as false).  ``score`` is
    the log10 probability of the text's bytes, A-Z folded, and its end; ``bits_per_byte`` the
    code length.  ``base_score`` is the log10 probability of its words and one end by their
    counts in the texts learnt from, with half a count added; ``n_known`` counts the tokens
    that occur there.  A null text is an empty one: its end is scored.  A null id is kept.
    Repeated rows are scored (and learnt from) each.  With nothing to learn from, every bit
    has probability 1/2.  An empty table gives no rows; other columns are not read.

    Every text is read whole, and every context of the texts learnt from is in the model; a
    context that only other texts have holds zero counts, which changes no weight.  Memory: a
    task holds a chunk's texts, or the requests of one of as many buckets, or the codes whose
    contexts share a part.  Codes and words are asked for once a chunk, so a frequent one is at
    most as many entries as there are chunks.  Words are named by 64-bit hashes.  Nothing is
    broadcast; the driver sees three sums.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth must be 1 to 6: a context and its byte are one 64-bit key")
    top = max(1, depth - 2)
    rows = df.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    size, ends = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)), F.count_if("learn")).first()
    chunks = max(8, -(-size // chunk_bytes))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int"))
    asked = save(dealt.groupBy("chunk").applyInArrow(_ask(depth, chunks), "bucket int, kind int, chunk int, keys binary, counts binary"))
    totals = save(asked.groupBy("bucket").applyInArrow(
        _total(depth, top, chunks), "bucket int, kind int, part int, keys binary, counts binary, tokens long, distinct long"))
    tokens, distinct = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    codes = totals.filter("kind = 0").select("part", "keys", "counts")
    nodes = save(codes.groupBy("part").applyInArrow(_grow(depth, top), "part int, node long, a long, b long, lw double"))
    values = codes.groupBy("part").cogroup(_upper(nodes, top).groupBy("part")).applyInArrow(
        _walk(depth, top, chunks), "bucket int, kind int, keys binary, vals binary")
    counts = totals.filter("kind = 1").select("bucket", "kind", "keys", "counts").mapInArrow(_as_values, values.schema)
    answers = asked.select("bucket", "kind", "chunk", "keys").groupBy("bucket").cogroup(
        values.unionByName(counts).groupBy("bucket")).applyInArrow(_answer, "chunk int, bucket int, kind int, vals binary")
    scored = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(depth, chunks, tokens, distinct, ends),
        f"id {dict(rows.dtypes)['id']}, learn boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, bits_per_byte double")
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))


def _as_values(batches: Iterable) -> Iterator:
    """Mapper: words' counts as doubles."""
    import pyarrow as pa

    for x in batches:
        vals = [np.frombuffer(c, np.int64).astype(np.float64).tobytes() for c in x.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*x.columns[:3], pa.array(vals, pa.binary())], ["bucket", "kind", "keys", "vals"])


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents`` by a model of those whose crc32 of the id is not 1 modulo 5 (a null id is learnt from)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return (score_texts(docs, ~held)
            .select(F.col("id").alias("doc_id"), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                    "base_score", "score", "bits_per_byte"))
