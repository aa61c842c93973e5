"""Streaming forms equal their batch twins, across several files, a restart and a late row."""

import os
import random

from pyspark.sql import functions as F

from coverlens.operators import failures as fl
from coverlens.operators import planning as pl
from coverlens.streaming import streams, updates


def _land(spark, rows, ddl, path):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def test_first_wins_survives_restart(spark, tmp):
    ddl = "combination_key string, seq long"
    landed, ledger, ck = (os.path.join(tmp, x) for x in ("in", "ledger", "ck"))
    _land(spark, [("k1", 1), ("k2", 2), ("k1", 3)], ddl, landed)
    src = lambda: spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(landed)
    streams.stream_first_wins(src(), ["combination_key"], ["seq"], ledger, ck).awaitTermination()
    _land(spark, [("k2", 4), ("k3", 5)], ddl, landed)
    streams.stream_first_wins(src(), ["combination_key"], ["seq"], ledger, ck).awaitTermination()  # restart
    got = sorted((r.combination_key, r.seq) for r in streams.first_wins_ledger(spark, ledger, ["combination_key"]).collect())
    all_rows = spark.createDataFrame([("k1", 1), ("k2", 2), ("k1", 3), ("k2", 4), ("k3", 5)], ddl)
    assert got == sorted(tuple(r) for r in pl.first_wins(all_rows, "combination_key", "seq").collect())


DDL = "run_id string, ts timestamp, seq long, status string"


def _attempts(spark, rows):
    return spark.createDataFrame([(r, f"2024-01-01 {t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}" if t is not None else None, i, s) for r, t, i, s in rows],
                                 "run_id string, ts string, seq long, status string").withColumn("ts", F.col("ts").cast("timestamp"))


def _streaks(spark, landed, out, ck, **options):
    src = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(landed)
    streams.stream_failure_streak(src, ["run_id"], "ts", "seq", F.col("status") == "failed", out, ck, **options).awaitTermination()
    return {(r.run_id, r.seq): (r.streak, r.late) for r in streams.latest_streaks(spark, out, ["run_id"], "seq").collect()}


def test_streaks_in_any_order_of_arrival(spark, tmp):
    """Shuffled rows over several files and a restart give the batch result, and none is left out."""
    landed, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    r = random.Random(3)
    rows = [(run, r.randrange(40), 100 * k + i, r.choice(["failed", "failed", "failed", "ok", "empty", None])) for k, run in enumerate("ab") for i in range(60)]
    rows += [("a", None, 901, "failed"), (None, 5, 902, "failed"), (None, 3, 903, "failed")]
    r.shuffle(rows)
    for part in (rows[:40], rows[40:80]):
        _attempts(spark, part).coalesce(1).write.mode("append").parquet(landed)
    _streaks(spark, landed, out, ck)
    _attempts(spark, rows[80:]).coalesce(1).write.mode("append").parquet(landed)
    got = _streaks(spark, landed, out, ck)
    batch = fl.failure_streak(_attempts(spark, rows), ["run_id"], ["ts", "seq"], F.col("status") == "failed").collect()
    assert got == {(x.run_id, x.seq): (x.streak, False) for x in batch} and len(got) == len(rows)


def test_a_late_row_revises_only_what_it_reaches(spark, tmp):
    landed, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    first = [("a", t, t, s) for t, s in zip((0, 10, 20, 30, 40, 50), ("failed", "failed", "ok", "failed", "failed", "failed"), strict=True)]
    _attempts(spark, first).coalesce(1).write.parquet(landed)
    _streaks(spark, landed, out, ck)
    _attempts(spark, [("a", 15, 15, "failed"), ("a", 35, 35, "ok")]).coalesce(1).write.mode("append").parquet(landed)
    got = _streaks(spark, landed, out, ck)
    assert {k[1]: v[0] for k, v in got.items()} == {0: 1, 10: 2, 15: 3, 20: 0, 30: 1, 35: 0, 40: 1, 50: 2}
    revised = spark.read.parquet(f"{out}/log/epoch=1")
    assert sorted(r.seq for r in revised.collect()) == [15, 35, 40, 50]  # 0 to 30 stand as they were


def test_settled_rows(spark, tmp):
    """Beyond the allowed lateness a row is given out as late; what is settled keeps its last streak."""
    landed, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    _attempts(spark, [("a", t, t, "failed") for t in range(0, 100, 10)]).coalesce(1).write.parquet(landed)
    _streaks(spark, landed, out, ck, lateness_sec=25)
    _attempts(spark, [("a", 5, 5, "failed"), ("a", 75, 75, "failed"), ("a", 100, 100, "failed")]).coalesce(1).write.mode("append").parquet(landed)
    got = _streaks(spark, landed, out, ck, lateness_sec=25)
    assert got.pop(("a", 5)) == (None, True)
    assert {k[1]: v for k, v in got.items()} == {**{t: (t // 10 + 1, False) for t in range(0, 80, 10)}, 75: (9, False), 80: (10, False), 90: (11, False), 100: (12, False)} | {70: (8, False)}


def test_the_update_log_is_compacted(spark, tmp):
    ddl, path = "k string, v long", os.path.join(tmp, "log")
    for epoch in range(8):
        rows = [(f"k{epoch % 3}", epoch), ("all", epoch)]
        for _ in range(2):  # every micro-batch is repeated
            updates.write_updates(spark.createDataFrame(rows, ddl), path, epoch, ["k"], compact_every=3)
        got = {r.k: r.v for r in updates.read_latest(spark, path, ["k"]).collect()}
        assert got == {"all": epoch, **{f"k{e % 3}": e for e in range(epoch + 1)}}
    assert sorted(os.listdir(os.path.join(path, "snapshots"))) == ["upto=5"]
    assert sorted(x for x in os.listdir(os.path.join(path, "log")) if x.startswith("epoch")) == ["epoch=6", "epoch=7"]


def test_run_summary_updates(spark, tmp):
    ddl = "run_id string, status string"
    landed, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    _land(spark, [("a", "failed"), ("a", "ok"), ("b", "failed")], ddl, landed)
    _land(spark, [("a", "failed")], ddl, landed)
    src = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(landed)
    streams.stream_run_summary(src, ["run_id"], F.col("status") == "failed", out, ck).awaitTermination()
    got = {r.run_id: (r.processed, r.failed) for r in streams.latest_run_summary(spark, out, ["run_id"]).collect()}
    assert got == {"a": (3, 2), "b": (1, 1)}
