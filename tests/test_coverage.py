"""No-favourable groups, summaries and pair coverage with the FIXTURES trap rows."""

import pytest
from pyspark.sql import functions as F

from coverlens.operators.coverage import (no_favorable, no_favorable_summary, pair_coverage,
                                          pair_coverage_by_source, require_columns)

ROWS = [  # ordinal, zip, code, responsibility (text, as read from CSV), drug_name
    (0, "1", "A", "", "first"), (1, "1", "A", "abc", "second"),           # all missing -> unfavourable
    (2, "1", "B", "5d", None), (3, "1", "B", "0x1p3", "x"),               # first name null is carried (D12)
    (4, "1", "C", " 5 ", "c"), (5, "1", "C", "0", "c"),                   # exactly 0 -> favourable
    (6, "2", "A", "NaN", "n"), (7, "2", "A", "-0.0", "n"),                # -0.0 <= 0 -> favourable
    (8, None, "A", "9", "null zip"), (9, "3", None, "9", "null code"),    # null keys vanish (D11)
    (10, "3", "D", "12", "d1"), (11, "3", "D", "7.5", "d2"),
]


@pytest.fixture()
def prices(spark):
    return spark.createDataFrame(ROWS, "ordinal long, zip_code string, procedure_code string, "
                                       "estimated_member_responsibility string, drug_name string")


def test_no_favorable(prices):
    got = no_favorable(prices, ["zip_code", "procedure_code"], "estimated_member_responsibility",
                       ["drug_name"], "ordinal").orderBy("zip_code", "procedure_code").collect()
    assert [tuple(r) for r in got] == [("1", "A", "first"), ("1", "B", None), ("3", "D", "d1")]


def test_missing_is_favorable_switch(prices):
    got = no_favorable(prices, ["zip_code", "procedure_code"], "estimated_member_responsibility",
                       ["drug_name"], "ordinal", missing_is_favorable=True).collect()
    assert {(r.zip_code, r.procedure_code) for r in got} == {("3", "D")}


def test_summary(prices):
    g = no_favorable(prices, ["zip_code", "procedure_code"], "estimated_member_responsibility", ["drug_name"], "ordinal")
    r = no_favorable_summary(g, ["zip_code", "procedure_code"]).first()
    assert (r.n, r.n_zip_code, r.n_procedure_code) == (3, 2, 3)


def test_required_columns(prices):
    with pytest.raises(ValueError, match="the table lacks \\['nope'\\]"):
        require_columns(prices, ["zip_code", "nope"])


def test_pair_coverage(spark):
    a = spark.createDataFrame([("f1", "1", "x"), ("f1", "1", "x"), ("f1", None, "x"), ("f2", "1", "x")],
                              "source string, zip_code string, drug_name string")
    by = {r.source: r.n_pairs for r in pair_coverage_by_source(a, ["zip_code", "drug_name"], "source").collect()}
    assert by == {"f1": 2, "f2": 1}
    b = spark.createDataFrame([("2", "y"), (None, "x")], "zip_code string, drug_name string")
    r = pair_coverage([a.drop("source"), b], ["zip_code", "drug_name"]).first()
    assert (r.pairs, r.n_zip_code, r.n_drug_name) == (3, 2, 2)
