"""Failure-log mining, streaks and auto-stop, and code matching, on synthetic fixtures."""

from pyspark.sql import functions as F

from coverlens.operators import failures as fl
from coverlens.operators import matching as mt

LOG = [
    "2025-01-01 00:00:00,000 - INFO - Processing 1/10: Drug in Akron, OH (43001)",
    "2025-01-01 00:00:01,000 - ERROR - ❌ Failed to get data for Drug A 10 MG in 43001 (Total failures: 1, Consecutive: 1)",
    "2025-01-01 00:00:02,000 - ERROR - ❌ Failed to get data for Salt in Water (Inj), 5% in 43002 (Total failures: 2, Consecutive: 2)",
    "2025-01-01 00:00:03,000 - ERROR - ❌ Failed to get data for Broken in 43003 (Total failures: 3)",
    "2025-01-01 00:00:04,000 - ERROR - ❌ Failed to get data for Drug A 10 MG in 43001 (Total failures: 4, Consecutive: 1)",
    "2025-01-01 00:00:05,000 - WARNING - 401 Unauthorized, token expired",
    "2025-01-01 00:00:06,000 - ERROR - ❌ Failed to get data for Sensor  Miscellaneous in 43004 (Total failures: 5, Consecutive: 2)",
]


def test_failure_log(spark):
    lines = spark.createDataFrame([(i + 1, v) for i, v in enumerate(LOG)], "line_no long, value string")
    s = fl.scan_failure_lines(lines)
    f = fl.failures(s).orderBy("line_no").collect()
    assert [(r.line_no, r.drug_name, r.zipcode) for r in f] == [
        (2, "Drug A 10 MG", "43001"), (3, "Salt in Water (Inj), 5%", "43002"), (5, "Drug A 10 MG", "43001"),
        (7, "Sensor  Miscellaneous", "43004")]
    assert [r.line_no for r in fl.unparsed(s).collect()] == [4]
    d = fl.failures_distinct(fl.failures(s)).orderBy("first_seen").collect()
    assert [(r.zipcode, r.first_seen) for r in d] == [("43001", 2), ("43002", 3), ("43004", 7)]
    sm = fl.log_summary(s).first()
    assert (sm.n_lines, sm.n_pairs, sm.n_zip, sm.n_drug) == (5, 3, 3, 3)
    docs = spark.createDataFrame([("run1", "\n".join(LOG))], "src string, text string")
    assert fl.auth_line_hits(docs, "text", ["src"]).first().n == 1


def _attempts(spark):
    rows = []
    seq = 0
    # run a: 9 failures then a success, then an 'empty' inside a streak, then 12 failures
    for st in ["failed"] * 9 + ["ok"] + ["failed"] * 2 + ["empty"] + ["failed"] * 12:
        seq += 1
        rows.append(("a", seq, st))
    # run b interleaved sequence numbers: exactly 10 failures, then more
    for i, st in enumerate(["failed"] * 10 + ["ok", "failed"]):
        rows.append(("b", 1000 + 2 * i, st))
    return spark.createDataFrame(rows, "run_id string, seq long, status string")


def test_streak_and_auto_stop(spark):
    a = _attempts(spark)
    failed = F.col("status") == "failed"
    st = {(r.run_id, r.seq): r.streak for r in fl.failure_streak(a, ["run_id"], ["seq"], failed).collect()}
    assert st[("a", 9)] == 9 and st[("a", 10)] == 0 and st[("a", 12)] == 2 and st[("a", 13)] == 0
    assert st[("a", 25)] == 12 and st[("b", 1018)] == 10
    kept = fl.auto_stop(a, ["run_id"], ["seq"], failed, limit=10).groupBy("run_id").agg(
        F.max("seq").alias("last"), F.count(F.lit(1)).alias("n")).collect()
    got = {r.run_id: (r.last, r.n) for r in kept}
    assert got == {"a": (23, 23), "b": (1018, 10)}   # the tripping attempt is kept (D5)
    rec = fl.recent_failures(a, ["run_id"], ["seq"], failed, 10).filter("run_id = 'a'").collect()
    assert sorted(r.seq for r in rec) == list(range(16, 26))
    rs = {r.run_id: (r.processed, r.failed) for r in fl.run_summary(a, ["run_id"], failed).collect()}
    assert rs == {"a": (25, 23), "b": (12, 11)}


def test_code_match(spark):
    catalog = spark.createDataFrame(
        [(0, "00012345678", "Drug 1"), (1, "2771559", "Drug 2"), (2, "173088710", "Drug 3"), (3, "99", "Drug 4")],
        "ordinal long, PROCEDURE_CODE string, name string")
    prices = spark.createDataFrame(
        [(0, "12345678", 1.5), (1, "02771559", 2.5), (2, "2771559", 9.9), (3, None, 3.0),
         (4, "1234567890123", 4.0), (5, "173088710", 5.0)], "ordinal long, price_code string, average_unit_price double")
    m = mt.match_codes(prices, "price_code", {"excel_avg_unit_price": "average_unit_price"}, ["ordinal"],
                       catalog, "PROCEDURE_CODE", {"csv_drug_name": "name"}, ["ordinal"])
    got = [tuple(r) for r in m.orderBy("code").collect()]
    # sorted as text: '173088710' < '2771559'; first price row wins for the repeated code
    assert got == [("12345678", 1.5, "Drug 1"), ("173088710", 5.0, "Drug 3"), ("2771559", 2.5, "Drug 2")]
    s = mt.code_match_summary(prices, "price_code", catalog, "PROCEDURE_CODE").first()
    assert (s.n_left, s.n_right, s.n_both) == (4, 4, 3)
