"""The driver contract: entry() runs; every query matches its DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from coverlens.plans.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        return f"{x:.9g}" if isinstance(x, float) else x
    return sorted(repr(tuple(v(r[i]) for i in order)) for r in rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["l_suppkey", "l_partkey", "l_returnflag"]
    assert df.count() >= 0


def test_every_query_has_an_oracle_or_is_listed():
    own = {*E.driver.QUERIES, *E.stream_bindings.QUERIES}
    missing = own - set(E.oracle_sql())
    assert missing == set(), missing
    assert own <= set(E.queries())


def test_entry_works_without_the_optional_parts(monkeypatch):
    find = E.importlib.util.find_spec
    monkeypatch.setattr(E.importlib.util, "find_spec", lambda name: None if name in ("coverlens.llm", "corpus_pipeline") else find(name))
    assert set(E.queries()) == {*E.driver.QUERIES, *E.stream_bindings.QUERIES}
    assert set(E.oracle_sql()) == set(E.queries())


FAST = ["batch_slice", "catalog_rejects", "plan_order", "response_rows", "response_nulls", "map_upsert", "code_intersection", "locate", "unfavorable_lineitem", "code_match",
        "log_failures", "auto_stop_ledger", "lookup_progress", "list_clean"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(ocols, cur.fetchall())


SPLIT = ["batch_slice", "batch_preview", "catalog_rejects", "lookup_progress", "plan_order", "failure_streak",
         "auto_stop_ledger", "recent_failures", "plan_requests"]


@pytest.mark.parametrize("name", SPLIT)
def test_two_level_scan_on_driver_tables(spark, name):
    """Cut the tables into many small ranges, so that groups span several, then compare to the oracle."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    spark.conf.set("coverlens.scan.partitions", "37")
    try:
        df = E.queries()[name](spark, SF)
        got = _canon(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.unset("coverlens.scan.partitions")
    cur = con.execute(E.oracle_sql()[name])
    assert got == _canon([d[0] for d in cur.description], cur.fetchall())
