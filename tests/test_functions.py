"""Scalar helpers: strip, lines, numeric coercion, codes, city, tags, attempt actions."""

import math

from pyspark.sql import functions as F

from coverlens.functions.attempts import attempt_action, response_status
from coverlens.functions.codes import padded_code, stripped_code
from coverlens.functions.keys import source_tag
from coverlens.functions.location import city_from_display, city_or_fallback
from coverlens.functions.numeric import to_number
from coverlens.functions.text import clean_lines, py_strip


def _one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("o")).first().o


def test_py_strip_matches_python(spark):
    samples = ["  a  b ", "\t31058\r", "　x ", "Sensor  Miscellaneous", "", "\x1cz\x1f"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r.o for r in df.select(py_strip("v").alias("o")).collect()]
    assert got == [s.strip() for s in samples]


def test_clean_lines_like_file_iteration(spark):
    text = "33101\n\n  33102 \r\n\t\n33103\r33104\n"
    got = _one(spark, clean_lines("v"), text)
    expect = [l.strip() for l in text.replace("\r\n", "\n").replace("\r", "\n").split("\n") if l.strip()]
    assert got == expect


def test_to_number_follows_pandas_rules(spark):
    cases = {"": None, "abc": None, "5d": None, "0x1p3": None, " 5 ": 5.0, "NaN": "nan", "-0.0": -0.0,
             "1e3": 1000.0, "+.5": 0.5, "inf": math.inf, "1,000": None, "$3": None, "True": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.o for r in df.select("v", to_number(F.col("v")).alias("o")).collect()}
    for k, want in cases.items():
        if want == "nan":
            assert math.isnan(got[k])
        else:
            assert got[k] == want, (k, got[k])


def test_codes(spark):
    df = spark.createDataFrame([("00093505601",), ("2771559",), ("0",), ("000",), ("1234567890123",), ("A12",)], "c string")
    got = df.select(stripped_code("c").alias("s"), padded_code("c").alias("p")).collect()
    assert [r.s for r in got] == ["93505601", "2771559", "0", "0", "1234567890123", "A12"]
    assert [r.p for r in got] == ["00093505601", "00002771559", "00000000000", "00000000000", "1234567890123", "A12"]


def test_city_rules(spark):
    rows = [("Main, Springfield, County", "33101"), ("33101, 33101, Miami", "33101"), ("33101, 33101", "33101"),
            ("Only", "33101"), (None, "33101")]
    df = spark.createDataFrame(rows, "d string, z string")
    got = [r.c for r in df.select(city_from_display(F.col("d"), F.col("z")).alias("c")).collect()]
    assert got == ["Springfield", "Miami", "", "", ""]
    df2 = spark.createDataFrame([("", "OH"), (None, "GA"), ("Akron", "OH")], "c string, s string")
    assert [r.o for r in df2.select(city_or_fallback(F.col("c"), F.col("s")).alias("o")).collect()] == \
        ["OH_City", "GA_City", "Akron"]


def test_source_tag_first_match(spark):
    names = ["results_OH_COMPLETE.csv", "x_FL_COMPLETE_PT2", "FL_COMPLETE_PT1_GA_COMPLETE", "other.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.t for r in df.select(source_tag(F.col("n")).alias("t")).collect()] == ["OH", "FL_PT2", "GA", "UNKNOWN"]


def test_attempt_action(spark):
    rows = [(200, "", None, 1, False, "ok"), (401, "", None, 1, False, "refresh_retry"),
            (403, "", None, 2, True, "fail"), (429, "", None, 1, False, "backoff_retry"),
            (429, "", None, 3, False, "give_up"), (500, "Unauthorized call", None, 1, False, "refresh_retry"),
            (500, "token bad", None, 1, True, "retry"), (None, None, "Read timeout", 1, False, "refresh_retry"),
            (None, None, "Read timeout", 2, False, "retry"), (None, None, "conn Unauthorized", 2, False, "refresh_retry")]
    df = spark.createDataFrame(rows, "s int, b string, e string, a int, r boolean, want string")
    got = df.select("want", attempt_action(F.col("s"), F.col("b"), F.col("e"), F.col("a"), F.col("r")).alias("o")).collect()
    assert all(r.o == r.want for r in got), got


def test_response_status(spark):
    rows = [(None, "failed"), ("{}", "failed"), ("not json", "failed"), ('{"title": "x"}', "empty"),
            ('{"pharmacies": []}', "empty"), ('{"pharmacies": [{"name": "a"}]}', "ok")]
    df = spark.createDataFrame(rows, "b string, want string")
    got = df.select("want", response_status(F.col("b")).alias("o")).collect()
    assert all(r.o == r.want for r in got), got
