"""Embedding dedup against all cosines."""

import math

import numpy as np

from coverlens.llm.embedding_dedup import bucket_codes, hadamard, near_copies, plan_index


def vectors(seed, dim=24):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dim) for _ in range(60)]
    for k in range(8):  # groups of near copies around the threshold
        base = rng.normal(size=dim)
        rows += [base + rng.normal(size=dim) * rng.choice([0.02, 0.1, 0.3, 0.45]) for _ in range(12)]
    rows += [rows[3]] * 5 + [rows[4] * 7.5, rows[4] * 1e-30, rows[5] * 1e30, -rows[5]]
    return [[float(np.float32(x)) for x in r] for r in rows]


def brute(rows, threshold=0.9):
    def ok(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ids = [i for i, v in rows if i is not None and ok(v)]
    vec = {i: np.array(v, float) / np.abs(np.array(v, float)).max() for i, v in rows if i in ids}
    links = {i: [] for i, _ in rows}
    for a in ids:
        for b in ids:
            if a != b and len(vec[a]) == len(vec[b]):
                if vec[a] @ vec[b] / np.sqrt(vec[a] @ vec[a]) / np.sqrt(vec[b] @ vec[b]) >= threshold:
                    links[a].append(b)
    root = {i: i for i, _ in rows}
    for _ in rows:
        root = {i: min([root[i], *[root[j] for j in links[i]]]) if i is not None else None for i in root}
    return {i: (len(links[i]), root[i]) for i in root}


def test_against_all_cosines(spark):
    vs = vectors(1)
    odd = [None, [], [0.0] * 24, [1.0] * 23 + [None], [1.0] * 23 + [float("nan")], [1.0] * 23 + [float("inf")], [1.0, 0.0], [2.0, 0.0], [1.0]]
    rows = [(5 * i + 2, v) for i, v in enumerate([*vs, *odd])]
    df = spark.createDataFrame([(*r, 1) for r in rows] + [(None, vs[0], 2)], "vec_id long, embedding array<float>, N_LINKS int")
    want = brute(rows)
    for block in (1024, 4):
        got = near_copies(df.repartition(3), block=block).collect()
        assert len(got) == len(rows) + 1
        for r in got:
            if r.vec_id is None:
                assert (r.n_links, r.component_id, r.kept) == (0, None, True)
            else:
                assert (r.n_links, r.component_id) == want[r.vec_id], r.vec_id
                assert r.kept == (r.component_id == r.vec_id)


def test_empty_and_nothing_usable(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert near_copies(empty).collect() == []
    none = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_copies(none).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_rotation_and_recall():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 64))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)
    index = plan_index(50_000, 64)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = rng.normal(size=a.shape)
    r -= (r * a).sum(1, keepdims=True) * a
    r /= np.linalg.norm(r, axis=1, keepdims=True)
    ca, cb = bucket_codes(a, index), bucket_codes(0.9 * a + math.sqrt(0.19) * r, index)
    met = (ca[:, :, :, None] == cb[:, :, None, :]).any((1, 2, 3))
    assert met.mean() > 0.995
    far = (ca[:-1, :, :, None] == ca[1:, :, None, :]).any((1, 2, 3))
    assert far.mean() < 0.1


def test_tables_follow_the_miss_rate():
    """A low threshold asks for many tables; their number is not cut."""
    few, many = plan_index(1000, 64, 0.9), plan_index(1000, 64, 0.2)
    assert few.tables < 64 < many.tables
