"""WARC fixity: the audit against a plain comparison of all records, and how far it descends."""

import random

import pytest
from pyspark.sql import functions as F

from coverlens.llm import warc_fixity as wf

SCHEMA = "file long, offset long, length long, digest string, record_id long, `up` int"


def replicas(seed):
    rng = random.Random(seed)
    a = []
    for f in (0, 1, 7):
        at = 0
        for i in range(rng.randint(1, 400)):
            n = rng.choice([5, 40, 300, 9000])
            a.append((f, at, n, f"{rng.random()}", 1000 * f + i, 0))
            at += n
    b = list(a)
    for _ in range(12):
        k = rng.randrange(len(b))
        f, at, n, d, i, u = b[k]
        b[k] = rng.choice([(f, at, n, "rot", i, u), (f, at, n - 1, d, i, u), (f, at, n - 1, "rot", i, u), None])
        b = [x for x in b if x]
    b += [(9, 0, 3, "new", 5, 0), (0, 10**7, 3, "new", 6, 0), b[0], b[0]]
    return a, b


def by_hand(a, b):
    x, y = {r[:2]: r for r in a}, {r[:2]: r for r in b}
    out = []
    for k in {*x, *y}:
        p, q = x.get(k), y.get(k)
        if p is None or q is None or p[2:4] != q[2:4]:
            kind = "missing" if q is None else "extra" if p is None else "length" if p[2] != q[2] else "changed"
            out.append((*k, kind, (p or q)[4]))
    return sorted(out)


@pytest.mark.parametrize("seed,range_bytes,fanout", [(1, 64, 2), (2, 4096, 16), (3, 10**9, 4)])
def test_audit_against_all_records(spark, seed, range_bytes, fanout):
    a, b = replicas(seed)
    got = wf.audit(spark.createDataFrame(a, SCHEMA).repartition(3), spark.createDataFrame(b, SCHEMA), range_bytes, fanout).collect()
    assert sorted((r.file, r.offset, r.kind, r.record_id) for r in got) == by_hand(a, b)


def test_equal_empty_and_null(spark):
    a, _ = replicas(4)
    df = spark.createDataFrame(a, SCHEMA)
    none = spark.createDataFrame([], SCHEMA)
    assert wf.audit(df, df.orderBy(F.rand(1))).collect() == [] and wf.audit(none, none).collect() == []
    assert wf.audit(df, none).count() == len(a)
    odd = spark.createDataFrame([(None, 0, 1, "x", 1, 0), (1, None, 1, "x", 1, 0), (1, 5, 1, None, 1, 0)], SCHEMA)
    assert wf.audit(odd, none).collect() == []


def test_one_record_changes_one_branch(spark):
    a = [(0, i * 10, 10, str(i), i, 0) for i in range(1000)]
    b = [r if r[4] != 777 else (*r[:3], "rot", *r[4:]) for r in a]
    ta, tb = (wf.tree(spark.createDataFrame(x, SCHEMA), 50, 4, 4) for x in (a, b))
    for x, y in zip(ta, tb, strict=True):
        assert wf._unlike(x, y).count() == 1


def test_pages_with_odd_values(spark):
    rows = [(i, None if i % 5 == 0 else f"http://x/{i}", None if i % 7 == 0 else "é<p>" * (i % 50)) for i in range(650)]
    rows += [(None, "u", "h"), (11, "again", "x"), (11, "again", "x")]
    both = wf.archived_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert both.count() == len(rows)
    last = both.groupBy("file").agg(F.max(F.col("offset") + F.col("length_a")).alias("end"), F.sum("length_a").alias("all")).collect()
    assert all(r.end == r["all"] for r in last)
