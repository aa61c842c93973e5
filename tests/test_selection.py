"""Top-k, rank selection and single batches against plain Python, and their plans."""

import random

import pytest
from pyspark.sql import functions as F

from coverlens.operators import geography as geo
from coverlens.operators.ordered import rank_cuts, slice_by_rank, top_k_per_group

DDL = "g string, a int, b string, id long, x int"


def _rows(n=600, seed=1):
    r = random.Random(seed)
    rows = [(r.choice(["hot"] * 6 + ["b", "c", None]), r.choice([None, 0, 0, 0, 5, r.randint(-9, 9)]), r.choice([None, "", "k", "kk"]), i, i % 7)
            for i in range(n)]
    r.shuffle(rows)
    return rows


def _key(row):
    return tuple((v is not None, v) if v is not None else (False, 0) for v in (row[1], row[2], row[3]))


def _groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {g: sorted(v, key=_key) for g, v in out.items()}


@pytest.mark.parametrize("descending", [False, True])
def test_top_k(spark, descending):
    rows = _rows()
    df = spark.createDataFrame(rows, DDL).repartition(9)
    got = top_k_per_group(df, ["g"], ["a", "b", "id"], 4, descending=descending, rank_col="rk")
    want = []
    for v in _groups(rows).values():
        want += [(*r, i + 1) for i, r in enumerate((v[::-1] if descending else v)[:4])]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, top_k_per_group(df, [], ["a", "b", "id"], 3, descending=descending).collect()), key=str) == sorted(
        sorted(rows, key=_key, reverse=descending)[:3], key=str)


def test_top_k_plan_is_two_small_shuffles(spark):
    df = spark.range(100_000).withColumn("g", F.col("id") % 3)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = top_k_per_group(df, ["g"], ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line]
    assert len(shuffles) == 2 and "rangepartitioning" not in plan
    assert plan.count("WindowGroupLimit") >= 3 and "Scan ExistingRDD" not in plan  # limits before the shuffles, no checkpoint


@pytest.mark.parametrize("pivots", [4, 32])
def test_rank_cuts(spark, pivots):
    rows = _rows(200)
    df = spark.createDataFrame(rows, DDL).repartition(5)
    n = F.col("n")
    ranks = {"first": F.lit(0), "mid": F.floor(n / 2), "last": n - 1, "none": n, "before": F.lit(-1)}
    got = {(r.g, r.cut): r.key for r in rank_cuts(df, ["g"], ["a", "b", "id"], ranks, pivots=pivots).collect()}
    groups = _groups(rows)
    assert set(got) == {(g, c) for g in groups for c in ranks}
    for g, v in groups.items():
        for c, at in (("first", 0), ("mid", len(v) // 2), ("last", len(v) - 1)):
            assert tuple(got[g, c]) == v[at][1:4], (g, c)
        assert got[g, "none"] is None and got[g, "before"] is None


def test_ties_raise(spark):
    df = spark.createDataFrame([("g", 1)] * 40, "g string, a int")
    for pivots in (4, 64):
        with pytest.raises(ValueError, match="apart"):
            rank_cuts(df, ["g"], ["a"], {"x": F.lit(20)}, pivots=pivots)


@pytest.mark.parametrize("groups", [64, 0])
def test_slices(spark, monkeypatch, groups):
    monkeypatch.setattr("coverlens.operators.ordered.LITERAL_GROUPS", groups)  # with and without literal bounds
    rows = _rows(300, seed=2)
    df = spark.createDataFrame(rows, DDL).repartition(5)
    got = slice_by_rank(df, ["g"], ["a", "b", "id"], F.floor(F.col("n") / 3), F.col("n") - 2)
    want = [r for v in _groups(rows).values() for r in v[len(v) // 3:max(len(v) // 3, len(v) - 2)]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert slice_by_rank(df, ["g"], ["a", "b", "id"], F.lit(5), F.lit(5)).count() == 0
    assert slice_by_rank(df.limit(0), ["g"], ["id"], F.lit(0), F.col("n")).count() == 0
    whole = slice_by_rank(df, [], ["id"], F.lit(10), F.lit(12)).collect()
    assert sorted(r.id for r in whole) == [10, 11]


@pytest.mark.parametrize(("batch", "total", "preview"), [(3, 4, None), (4, 4, 2), (5, 200, None)])
def test_one_batch_equals_its_part_of_all_batches(spark, batch, total, preview):
    rows = _rows(250, seed=3)
    df = spark.createDataFrame(rows, DDL)
    one = geo.batch_slice(df, ["g"], ["a", "b", "id"], batch, total, preview)
    want = geo.assign_batches(df, ["g"], ["a", "b", "id"], total).filter(F.col("batch_num") == batch).drop("batch_num")
    if preview:
        want = top_k_per_group(want, ["g"], ["a", "b", "id"], preview)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, want.select(one.columns).collect()), key=str)


def test_bounds_of_one_batch_reach_the_scan(spark, tmp):
    spark.range(5000).select(F.lit("s").alias("g"), "id").write.parquet(f"{tmp}/t")
    plan = geo.batch_slice(spark.read.parquet(f"{tmp}/t"), ["g"], ["id"], 2, 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,1000)" in plan and "LessThanOrEqual(id,1999)" in plan
