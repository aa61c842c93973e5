"""Hard negatives against all scores in Python integers, and the certified walk against whole lists."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlens.llm import hard_negatives
from coverlens.llm.hard_negatives import Best, _units, mine, shared_list, walk

SCHEMA = "vec_id long, embedding array<double>, label int, TEAM int, anchor string, score long"


def brute(rows, every=100, k=5, low=80):
    seen = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) < 2**62:
            key = (str(label), len(q), b"".join(x.to_bytes(4, "little", signed=True) for x in q))
            if i not in seen or key < seen[i][0]:
                seen[i] = key, label, q
    out = []
    for a, (_, la, qa) in seen.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(qa, q, strict=True)) for i, (_, _, q) in seen.items() if i != a and len(q) == len(qa)}
        best = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in best if seen[i][1] == la][:k]:
            far = [i for i in best if seen[i][1] != la and low * score[p] <= 100 * score[i] <= 100 * score[p]][:k]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(far)]
    return sorted(out)


def rows_of(seed, n=700, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    vecs = [(centres[i % 6] + rng.normal(size=dim) * [0.05, 0.3, 1.0][i % 3]).tolist() for i in range(n)]
    rows = [(5 * i, v, int(rng.integers(4)), 1, "x", 2) for i, v in enumerate(vecs)]
    tie = vecs[0]
    rows += [(5 * (n + i), tie, i % 4, 1, "x", 2) for i in range(60)]  # one group of equal vectors
    odd = [None, [], [0.0] * dim, [1.0] * (dim - 1) + [None], [float("nan")] * dim, [float("inf")] * dim, [1e300] * dim, [-1.0] * dim,
           [1.0, 2.0], [2.0, 1.0], [1e6, 1e6], [9e8, 9e8], [-0.0] * dim]
    rows += [(100_000 + 100 * i, v, i % 3, 1, "x", 2) for i, v in enumerate(odd)]
    rows += [(200_000 + i, v, None if i % 4 == 0 else i % 3, 1, "x", 2) for i, v in enumerate(odd)]
    rows += [(None, vecs[1], 1, 1, "x", 2), (100, vecs[2], 3, 1, "x", 2), (100, vecs[2], 3, 1, "x", 2), (105, vecs[3], 0, 1, "x", 2)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_against_all_scores(spark, monkeypatch, small):
    if small:  # many teams, parts, clusters and steps
        monkeypatch.setattr(hard_negatives, "TEAM", 5)
        monkeypatch.setattr(hard_negatives, "PART_BYTES", 20_000)
    rows = rows_of(3)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = mine(df, every=20)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, every=20)


def test_empty_and_few(spark):
    assert mine(spark.createDataFrame([], SCHEMA)).collect() == []
    one = [(100, [1.0], 1, 1, "", 1)]
    assert mine(spark.createDataFrame(one, SCHEMA)).collect() == []
    no_anchor = [(101, [1.0], 1, 1, "", 1), (102, [1.0], 2, 1, "", 1)]
    assert mine(spark.createDataFrame(no_anchor, SCHEMA)).collect() == []
    few = [(100, [1.0], 1, 1, "", 1), (101, [1.0], 1, 1, "", 1), (102, [0.9], 2, 1, "", 1)]
    assert [tuple(r) for r in mine(spark.createDataFrame(few, SCHEMA)).collect()] == brute(few) == [(100, 101, 1, 102, 65536, 58880)]


def test_walk_is_certified_and_stops_early():
    """What a member holds after the walk equals the whole list's; tight clusters take few scores."""
    rng = np.random.default_rng(0)
    for spread, most in ((0.02, 0.2), (0.7, 1.01)):
        centre = rng.normal(size=16)
        members = np.floor(256 * (centre + spread * rng.normal(size=(40, 16))))
        near = centre + 0.05 * rng.normal(size=(600, 16))
        cands = np.floor(256 * np.concatenate([near, rng.normal(size=(20_000, 16))]))
        units, sizes = _units(cands)
        order, bound = shared_list(members, units, sizes)
        scores = (members @ cands[order].T).astype(np.int64)
        assert (scores <= np.sqrt((members * members).sum(1))[:, None] * bound).all()
        best = Best(len(members), 5)
        ids = np.arange(len(cands))

        def offer(who, block, score, best=best, ids=ids):
            i, j = np.nonzero(score >= best.least[who][:, None])
            best.offer(who[i], score[i, j], ids[block[j]])

        taken = walk(members, cands, units, sizes, best, np.full(len(members), -np.inf), offer)
        assert taken <= most * len(members) * len(cands)
        whole = (members @ cands.T).astype(np.int64)
        for m in range(len(members)):
            want = sorted(range(len(cands)), key=lambda i: (-whole[m, i], i))[:5]
            assert best.id[best.who == m].tolist() == want


def test_driver_table_against_all_scores(spark):
    from coverlens.llm.hard_negatives import op13_hard_negatives
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op13_hard_negatives(spark, sf).collect())
    assert got == brute(rows) and got
    assert spark.read.parquet(f"{sf}/embeddings.parquet").filter(F.col("vec_id") % 100 == 0).count() >= len({r[0] for r in got})
