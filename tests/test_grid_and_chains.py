"""Remaining cells of the grid, call ids, whole attempt chains and the stored map."""

import itertools
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from coverlens.functions.attempts import attempt_action
from coverlens.operators import failures as fl
from coverlens.operators import planning as pl
from coverlens.sources import readers, sinks


@pytest.mark.parametrize("block_rows", [3, 64, 70, 256])
def test_done_cells_are_never_made(spark, block_rows):
    r = random.Random(4)
    codes, zips = [f"c{i % 90}" for i in range(100)], [f"z{i % 13}" for i in range(15)]
    done = [(r.choice(codes), r.choice(zips)) for _ in range(400)] + [("c1", z) for z in zips] + [("nowhere", "z1"), (None, "z1"), ("c2", None)]
    cats = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code string")
    locs = spark.createDataFrame([(i, z) for i, z in enumerate(zips)], "j int, zip string")
    ledger = spark.createDataFrame(done * 2, "code string, zip string")
    got = pl.plan_grid(cats, ["i"], locs, ["j"], cat_key="code", loc_key="zip", block_rows=block_rows, done=ledger, done_on=("code", "zip"))
    want, seen = [], set(done)
    for (i, c), (j, z) in itertools.product(enumerate(codes), enumerate(zips)):
        if (c, z) not in seen:
            seen.add((c, z))
            want.append((c, z, i * len(zips) + j + 1))
    assert sorted(tuple(x) for x in got.select("code", "zip", "position").collect()) == sorted(want)


def test_ledger_keys_with_underscores(spark):
    ledger = spark.createDataFrame([("a_b_c",), ("x",), ("_",), (None,)], "combination_key string")
    got = sorted(tuple(r) for r in pl.split_keys(ledger, "code", "zip").collect())
    assert got == [("", ""), ("a", "b_c"), ("a_b", "c")]


def test_blocks_are_copied_for_few_chunks(spark):
    """A long catalogue is not copied for every task: its blocks alone fill the tasks."""
    cats, locs = spark.range(40_000).withColumnRenamed("id", "c"), spark.range(40).withColumnRenamed("id", "l")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        grid = pl.plan_grid(cats, ["c"], locs, ["l"], block_rows=16, partitions=8)
        assert grid.count() == 40_000 * 40
        text = grid._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "sequence(0, 7" not in text  # not one copy for each of the 8 tasks


def test_call_ids_are_stable_uuids(spark):
    df = spark.range(200).select(pl.call_id(F.lit("r1"), F.col("id").cast("string")).alias("u"), pl.call_id(F.lit("r2"), F.col("id").cast("string")).alias("v"))
    a, b = df.collect(), df.repartition(5).collect()
    assert {r.u for r in a} == {r.u for r in b} and len({r.u for r in a} | {r.v for r in a}) == 400
    assert all(uuid.UUID(r.u).version == 4 and uuid.UUID(r.u).variant == uuid.RFC_4122 for r in a)


def _follow(attempts, tries=3):
    """The collector's loop over one request, step by step."""
    refreshed, actions, waited, refreshes = False, [], 0, 0
    for n, (status, body, error, works) in enumerate(attempts[:tries]):
        fresh = works is None or works

        def renew(fresh=fresh):
            nonlocal refreshed, refreshes
            if fresh:
                refreshed, refreshes = True, refreshes + 1
                actions.append("refresh_retry")
            return fresh

        if status == 200:
            return "ok", n + 1, refreshes, waited, [*actions, "ok"]
        if status in (401, 403):
            if refreshed:
                return "failed", n + 1, refreshes, waited, [*actions, "fail"]
            if renew():
                continue
            return "failed", n + 1, refreshes, waited, [*actions, "refresh_failed"]
        if status == 429:
            waited += 40
            actions.append("backoff_retry")
            continue
        text = ((body if status else error) or "").lower()
        if status:
            asks = "token" in text or "unauthorized" in text
        else:
            asks = n == 0 if "timeout" in text else "unauthorized" in text
        if asks and not refreshed and renew():
            continue
        actions.append("retry")
        if n < tries - 1:
            waited += 20
    return "failed" if len(attempts) >= tries else "open", min(len(attempts), tries), refreshes, waited, actions


KINDS = [(200, "{}", None), (401, "", None), (403, None, None), (429, "", None), (500, "bad Token", None), (502, "oops", None),
         (None, None, "Read Timeout"), (None, None, "401 Unauthorized"), (None, None, "reset"), (None, None, None)]


def test_every_chain(spark):
    """All chains of up to three attempts of ten kinds with a refresh that works, fails or is unknown; some with attempts too many."""
    r = random.Random(6)
    steps = [(*k, w) for k in KINDS for w in (True, False)]
    chains = [c for n in (1, 2) for c in itertools.product(steps, repeat=n)]
    chains += r.sample(list(itertools.product(steps, repeat=3)), 1500) + [tuple(r.choices([*steps, (401, "", None, None)], k=5)) for _ in range(200)]
    rows = [(i, 10 * i + n, *a) for i, c in enumerate(chains) for n, a in enumerate(c)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "req long, seq long, status int, body string, error string, refresh_ok boolean")
    got = {x.req: (x.outcome, x.attempts, x.refreshes, x.waited, x.actions) for x in fl.request_outcomes(df, ["req"], ["seq"]).collect()}
    assert len(got) == len(chains)
    for i, c in enumerate(chains):
        assert got[i] == _follow(c), c


def test_one_attempt_with_a_failed_refresh(spark):
    rows = [(401, "", None, 1, False, False, "fail"), (401, "", None, 1, False, True, "refresh_retry"), (403, "", None, 1, True, False, "fail"),
            (500, "token", None, 1, False, False, "retry"), (500, "token", None, 3, False, False, "give_up"), (None, None, "timeout", 1, False, False, "retry"),
            (None, None, "timeout", 2, False, False, "retry"), (None, None, "unauthorized", 2, False, False, "retry"), (200, "", None, 1, False, False, "ok"),
            (429, "", None, 1, False, False, "backoff_retry"), (401, "", None, 3, False, False, "fail"), (500, "x", None, 1, False, None, "retry")]
    df = spark.createDataFrame(rows, "status int, body string, error string, n int, refreshed boolean, works boolean, want string")
    got = df.select("*", attempt_action(*map(F.col, ("status", "body", "error", "n", "refreshed")), refresh_ok=F.col("works")).alias("got")).collect()
    assert [(tuple(r)[:6], r.got) for r in got] == [(tuple(r)[:6], r.want) for r in got]


def test_stored_map(spark, tmp):
    path, ddl = os.path.join(tmp, "map"), "k string, v string"

    def run(rows, parts=8):
        return sinks.upsert_map(spark.createDataFrame(rows, ddl), path, "k", "v", parts)

    assert run([]) == 0
    first = [(f"k{i}", f"v{i}") for i in range(40)] + [("e", ""), ("n", None), (None, "x"), ("k1", "v0")]
    assert run(first) == 8
    stamp = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}
    assert run(first) == 0                                   # the same again rewrites nothing
    assert stamp == {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}
    assert run([("k1", "zzz"), ("e", "found"), ("new", "w"), ("new", "a")]) <= 2
    got = {r.k: r.v for r in readers.read_map(spark, path).collect()}
    assert got == {**{f"k{i}": f"v{i}" for i in range(40)}, "e": "found", "new": "w"}
    assert readers.read_map(spark, path).count() == len(got)
    with pytest.raises(ValueError, match="parts"):
        run([("q", "1")], parts=4)
