"""Hard-negative mining: clusters of anchors walk shared lists of candidates.

Anchors that point in like directions form a cluster.  For a cluster the candidates are sorted
once by an upper bound of their inner product with any member: the angle between candidate and
cluster centre, less the widest angle of a member.  Each member takes exact scores down that
list until what it holds is certified, that is until no score that the rest can reach would
enter.  The first walk finds each anchor's best rows of its own label, the second the rows of
other labels that score a little less.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coverlens.llm.common import quoted, save

#: Anchors that centres are fitted on at most (in expectation; picked by a hash of their id), and centres of one vector length.
SAMPLE = 20_000
CENTRES = 256
#: Members of a cluster, and anchors of a team (whole clusters that one task serves).
MEMBERS = 64
TEAM = 2048
#: Bytes of candidate vectors (as doubles) of a task.
PART_BYTES = 8 << 20
#: Candidates taken from a list at a time.
STEP = 512
#: Squared length from which on a score might not fit a long.
TOO_LONG = 2.0**62


def _clean(scale: int):
    """Mapper: (id, label, vector) -> (id, label, dim, q): components floor(scale * x) as 32-bit whole numbers; unusable rows go."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for i, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                v = v.values if i is not None and label is not None and v.is_valid else None
                if v is None or v.null_count:
                    continue
                x = v.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    q = np.floor(scale * x)
                    if np.isfinite(x).all() and q @ q < TOO_LONG:
                        rows.append((i, label, len(q), q.astype("<i4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int64(), pa.string(), pa.int32(), pa.binary()))], ["id", "label", "dim", "q"])

    return run


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<i4").reshape(len(blobs), dim).astype(np.float64)


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.sqrt((x * x).sum(1))
    return x / np.maximum(size, 1e-300)[:, None], size


def centres_of(x: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Directions of ``k`` clusters of the rows of ``x`` (spherical k-means from evenly spaced rows)."""
    u, _ = _units(x)
    c = u[np.linspace(0, len(u) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.argmax(u @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, u)
        c = np.where(np.abs(total).sum(1, keepdims=True) > 0, _units(total)[0], c)
    return c


def _assign(centres: dict[int, np.ndarray]):
    """Mapper: anchors with their cluster, the closest centre of their length."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = np.zeros(batch.num_rows, np.int32)
            dims, blobs = batch.column(2).to_numpy(), batch.column(3).to_pylist()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if int(dim) in centres:
                    out[at] = np.argmax(_matrix([blobs[i] for i in at], int(dim)) @ centres[int(dim)].T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "cluster"])

    return run


class Best:
    """The first ``k`` (score falling, id rising) of what each member has been offered."""

    def __init__(self, members: int, k: int):
        self.k, self.members = k, members
        self.who, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.least = np.full(members, -np.inf)  # score to reach to enter

    def offer(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        who, score, ids = (np.concatenate(p) for p in ((self.who, who), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, who))
        who, score, ids = who[order], score[order], ids[order]
        first = np.searchsorted(who, who)
        keep = np.arange(len(who)) - first < self.k
        self.who, self.score, self.id = who[keep], score[keep], ids[keep]
        count = np.bincount(self.who, minlength=self.members)
        full = np.flatnonzero(count == self.k)
        self.least[full] = self.score[(np.cumsum(count) - 1)[full]]


def shared_list(members: np.ndarray, units: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates by falling bound, and the bounds: no member's score exceeds its own length times the bound."""
    u, size = _units(members)
    total = u.sum(0)
    centre = total / np.linalg.norm(total) if np.linalg.norm(total) > 1e-9 else u[0]
    angles = np.arccos(np.clip(u @ centre, -1, 1))[size > 0]
    wide = float(angles.max()) if len(angles) else 0.0
    angle = np.arccos(np.clip(units @ centre, -1, 1))
    bound = sizes * (np.cos(np.maximum(0, angle - wide)) + 1e-7)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(members: np.ndarray, cands: np.ndarray, units: np.ndarray, sizes: np.ndarray, best: Best, floor: np.ndarray,
         offer: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> int:
    """Walk the shared list until every member is certified; the number of exact scores taken.

    ``offer(members, candidates, scores)`` passes a block's scores on to ``best``; ``floor`` is
    the least score that could matter to a member, whatever ``best`` holds.
    """
    order, bound = shared_list(members, units, sizes)
    length = np.sqrt((members * members).sum(1))
    exact = float(length.max(initial=0)) * float(sizes.max(initial=0)) < 2**53
    taken = 0
    for at in range(0, len(order), STEP):
        reach = length * bound[at]
        active = np.flatnonzero((reach >= floor) & (reach >= best.least.reshape(len(members), -1).min(1)))
        if not len(active):
            break
        block = order[at:at + STEP]
        if exact:  # no partial sum exceeds the product of lengths, so doubles are exact
            score = (members[active] @ cands[block].T).astype(np.int64)
        else:
            score = members[active].astype(np.int64) @ cands[block].T.astype(np.int64)
        taken += score.size
        offer(active, block, score)
    return taken


def _teams(anchors, cands) -> Iterator[tuple[np.ndarray, dict, dict]]:
    """Clusters of a task: rows of the anchors table, and both tables' columns as arrays."""
    dim = anchors.column("dim")[0].as_py()
    a, c = ({k: np.array(t.column(k).to_pylist()) for k in ("id", "label")} | {"q": _matrix(t.column("q").to_pylist(), dim)}
            for t in (anchors, cands))
    c["unit"], c["size"] = _units(c["q"])
    cluster = anchors.column("cluster").to_numpy()
    a["order"] = np.lexsort((a["id"], cluster))
    for one in np.unique(cluster):
        rows = a["order"][cluster[a["order"]] == one]
        for at in range(0, len(rows), MEMBERS):
            yield rows[at:at + MEMBERS], a, c


def _positives(k: int):
    """Groups of (team, part): anchors, candidates -> (anchor, id, score): each anchor's first ``k`` of its label in the part."""
    def run(anchors, cands):
        import pyarrow as pa

        out: list[list[np.ndarray]] = [[], [], []]
        for rows, a, c in _teams(anchors, cands) if anchors.num_rows and cands.num_rows else ():
            best = Best(len(rows), k)

            def offer(who, block, score, rows=rows, a=a, c=c, best=best):
                same = (a["label"][rows[who]][:, None] == c["label"][block]) & (a["id"][rows[who]][:, None] != c["id"][block])
                i, j = np.nonzero(same & (score >= best.least[who][:, None]))
                best.offer(who[i], score[i, j], c["id"][block[j]])

            walk(a["q"][rows], c["q"], c["unit"], c["size"], best, np.full(len(rows), -np.inf), offer)
            for x, y in zip(out, (a["id"][rows][best.who], best.id, best.score), strict=True):
                x.append(y)
        return pa.table([np.concatenate([np.empty(0, np.int64), *x]) for x in out], names=["anchor", "id", "score"])

    return run


def _negatives(k: int, low: int, high: int):
    """Groups of (team, part): anchors with their positives' scores, candidates -> (anchor, positive, id, score): first ``k`` of other labels."""
    def run(anchors, cands):
        import pyarrow as pa

        out: list[list[np.ndarray]] = [[], [], [], []]
        scores = anchors.column("scores").to_pylist()
        for rows, a, c in _teams(anchors, cands) if anchors.num_rows and cands.num_rows else ():
            most = max(len(scores[r]) for r in rows)
            # Whole bounds of the scores that a positive lets in; one that lets none in wants more than it allows.
            top = np.array([[high * s // 100 for s in scores[r]] + [-1] * (most - len(scores[r])) for r in rows], np.int64)
            bottom = np.array([[-(-low * s // 100) for s in scores[r]] + [0] * (most - len(scores[r])) for r in rows], np.int64)
            best = Best(len(rows) * most, k)
            best.least = np.where(top < bottom, np.inf, -np.inf).reshape(-1)

            def offer(who, block, score, rows=rows, a=a, c=c, best=best, top=top, bottom=bottom, most=most):
                other = a["label"][rows[who]][:, None] != c["label"][block]
                for p in range(most):
                    pair = who * most + p
                    i, j = np.nonzero(other & (score <= top[who, p][:, None]) & (score >= bottom[who, p][:, None])
                                      & (score >= best.least[pair][:, None]))
                    if len(i):
                        best.offer(pair[i], score[i, j], c["id"][block[j]])

            wanted = np.where(top < bottom, np.inf, bottom.astype(np.float64)).min(1)
            walk(a["q"][rows], c["q"], c["unit"], c["size"], best, wanted, offer)
            for x, y in zip(out, (a["id"][rows][best.who // most], best.who % most, best.id, best.score), strict=True):
                x.append(y)
        return pa.table([np.concatenate([np.empty(0, np.int64), *x]) for x in out], names=["anchor", "positive", "id", "score"])

    return run


def mine(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", every: int = 100,
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the whole inner product.  Anchors are the
    rows whose id ``every`` divides; an anchor's positives are its first ``positives`` other rows
    of its label, by falling score and rising id.  For each, the first ``negatives`` rows of
    other labels whose score is within ``low`` to ``high`` percent of the positive's follow, by
    the same order; a pair without such rows gives none.

    Rows without id, label or vector, with a null or non-finite component, or with a squared
    length (in whole components) of 2**62 and more take no part; of rows with one id, the least
    by label (as text) and vector does.  Vectors of unlike lengths do not meet; an empty or zero
    vector scores 0.  Other columns are not read; an empty table gives no rows.

    Every anchor meets every candidate's bound and none is left out.  A task holds at most
    about ``TEAM`` anchors and ``PART_BYTES`` of candidates.  Candidates are sent once to every
    team, that is once for about ``every * TEAM`` rows of the table.  The driver sees a bounded
    sample of anchors and their number by vector length and cluster.
    """
    spark = df.sparkSession
    rows = (df.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("string").alias("label"), quoted(vec_col).alias("v"))
            .mapInArrow(_clean(scale), "id long, label string, dim int, q binary"))
    cands = save(rows.groupBy("id").agg(F.min(F.struct("label", "dim", "q")).alias("r")).select("id", "r.label", "r.dim", "r.q"))
    anchors = cands.filter(F.col("id") % every == 0)
    share = min(1.0, SAMPLE / max(1, anchors.count()))
    sample: dict[int, list[bytes]] = {}
    for r in anchors.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20)))).orderBy("id").toLocalIterator():
        sample.setdefault(r.dim, []).append(bytes(r.q))
    centres = {dim: centres_of(_matrix(v, dim), min(CENTRES, -(-len(v) // 32))) for dim, v in sample.items()}
    anchors = save(anchors.mapInArrow(_assign(centres), "id long, label string, dim int, q binary, cluster int"))

    # Teams: small clusters together, large ones cut by a hash of the id.
    placed, dims, team, held = [], [], 0, 0
    sizes = {r.dim: r.n for r in cands.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    last = None
    for r in sorted(anchors.groupBy("dim", "cluster").agg(F.count(F.lit(1)).alias("n")).collect()):
        if r.dim != last or held + r.n > TEAM:
            team, held = team + 1, 0
        if r.dim != last:
            dims.append([r.dim, team, team, max(1, -(-sizes[r.dim] * 8 * max(1, r.dim) // PART_BYTES))])
            last = r.dim
        cuts = max(1, -(-r.n // TEAM))
        placed.append((r.dim, r.cluster, team, cuts))
        team, held = team + cuts - 1, held + r.n if cuts == 1 else TEAM
        dims[-1][2] = team
    places = F.broadcast(spark.createDataFrame(placed, "dim int, cluster int, team int, cuts int"))
    spread = F.broadcast(spark.createDataFrame([tuple(d) for d in dims], "dim int, first int, last int, parts int"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    listed = (cands.join(spread, "dim").select("id", "label", "dim", "q", part, F.explode(F.sequence("first", "last")).alias("team")))
    meeting = (anchors.join(places, ["dim", "cluster"]).join(spread, "dim")
               .withColumn("team", (F.col("team") + F.pmod(F.xxhash64("id"), F.col("cuts"))).cast("int"))
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    mine_of = ["id", "label", "dim", "q", "cluster", "team", "part"]

    def together(left: DataFrame, func, schema: str) -> DataFrame:
        return left.groupBy("team", "part").cogroup(listed.groupBy("team", "part")).applyInArrow(func, schema)

    first = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    near = save(together(meeting.select(*mine_of), _positives(positives), "anchor long, id long, score long")
                .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= positives))
    scores = near.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "score"))), lambda x: x["score"]).alias("scores"))
    armed = meeting.join(scores, F.col("id") == F.col("anchor")).select(*mine_of, "scores")
    per_pair = Window.partitionBy("anchor", "positive").orderBy(F.col("score").desc(), "id")
    far = (together(armed, _negatives(negatives, low, high), "anchor long, positive long, id long, score long")
           .withColumn("rank", F.row_number().over(per_pair)).filter(F.col("rank") <= negatives)
           .select("anchor", (F.col("positive") + 1).alias("n"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))
    return (near.select("anchor", "n", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(far, ["anchor", "n"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings``; every seventh row's label is moved on by one first."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label))


OP13_SQL = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.vec_id <> r.vec_id AND len(a.q) = len(r.q) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""
