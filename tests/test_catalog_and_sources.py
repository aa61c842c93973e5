"""Catalogue resolution, enrichment, metrics and the readers on synthetic files."""

import json
import os

from pyspark.sql import functions as F

from coverlens.operators import catalog as cat
from coverlens.sources import readers, sinks

CATALOG_CSV = """PROCEDURE_CODE,DRUG_NAME_WITH_FORM_STRENGTH,DOSAGE_FORM,TOTAL_BENEFIT_AMOUNT,BENEFIT_PERCENTAGE,CLAIM_COUNT,CLAIMS_FREQUENCY_PERCENTAGE
00012345678,"Drug, with comma 10 MG",Tablet,"  12,345 ",0.42%,10,1.0%
12345678901,Sensor  Miscellaneous,Misc,"  1,000 ",0.10%,5,0.5%
22222222222,Sensor  Miscellaneous,Misc,"  900 ",0.09%,4,0.4%
33333333333,No Uuid,Cap,"  5 ",0.01%,1,0.1%
44444444444,Empty Uuid,Cap,"  6 ",0.01%,1,0.1%
"""
UUIDS = {"00012345678": "care_abc", "12345678901": "ABCDEFGHIJKLMNOPQRST", "22222222222": "x2",
         "44444444444": "", "12345678": "stripped-form-key"}


def _files(tmp):
    c = os.path.join(tmp, "catalog.csv")
    open(c, "w").write(CATALOG_CSV)
    u = os.path.join(tmp, "uuid.json")
    open(u, "w").write(json.dumps(UUIDS, indent=2))
    return c, u


def test_read_and_resolve(spark, tmp):
    c, u = _files(tmp)
    catalog = readers.read_catalog(spark, c)
    assert catalog.count() == 5
    first = catalog.filter("ordinal = 0").first()
    assert first.PROCEDURE_CODE == "00012345678" and first.DRUG_NAME_WITH_FORM_STRENGTH == "Drug, with comma 10 MG"
    assert first.TOTAL_BENEFIT_AMOUNT == "  12,345 "
    m = readers.read_json_map(spark, u, key="code", value="uuid")
    assert m.count() == 5
    resolved = cat.resolve(catalog, "PROCEDURE_CODE", m, "code", "uuid")
    assert sorted(r.PROCEDURE_CODE for r in resolved.collect()) == ["00012345678", "12345678901", "22222222222"]
    rej = cat.number_rows(cat.rejects(catalog, "PROCEDURE_CODE", m, "code", "uuid").withColumn("g", F.lit(1)),
                          ["g"], ["ordinal"], "n")
    assert [(r.n, r.PROCEDURE_CODE) for r in rej.orderBy("n").collect()] == [(1, "33333333333"), (2, "44444444444")]
    enriched = cat.enrich(catalog, "PROCEDURE_CODE", m, "code", "uuid", "CARE_UUID")
    assert enriched.count() == 5
    met = cat.lookup_metrics(enriched, "CARE_UUID").first()
    assert (met.total, met.ok, met.failed, met.success_rate, met.success_tenths) == (5, 3, 2, 60.0, 600)


def test_missing_map_file_is_empty(spark, tmp):
    assert readers.read_json_map(spark, os.path.join(tmp, "nope.json")).count() == 0


def test_read_text_list(spark, tmp):
    fl = os.path.join(tmp, "fl.txt")
    open(fl, "w").write("33101\n\n\t33102 \r\n31058\n  \n33103")
    oh = os.path.join(tmp, "oh.txt")
    open(oh, "w").write("43001\n31058")
    df = readers.read_text_list(spark, {"FL": fl, "GA": os.path.join(tmp, "missing.txt"), "OH": oh})
    got = sorted((r.state, r.ordinal, r.zip) for r in df.collect())
    assert got == [("FL", 0, "33101"), ("FL", 1, "33102"), ("FL", 2, "31058"), ("FL", 3, "33103"),
                   ("OH", 0, "43001"), ("OH", 1, "31058")]


def test_geocodes_and_lines(spark, tmp):
    g = os.path.join(tmp, "geo.json")
    open(g, "w").write(json.dumps({"33101_FL": {"lat": 25.7, "lng": -80.2, "city": ""},
                                   "31058_GA": {"lat": 32.0, "lng": -84.0, "city": "Mauk"}}))
    rows = {(r.zip, r.state): r.city for r in readers.read_geocodes(spark, g).collect()}
    assert rows == {("33101", "FL"): "", ("31058", "GA"): "Mauk"}
    log = os.path.join(tmp, "a.log")
    open(log, "w").write("one\ntwo\nthree\n")
    assert [(r.line_no, r.value) for r in readers.read_lines(spark, log).orderBy("line_no").collect()] == \
        [(1, "one"), (2, "two"), (3, "three")]


def test_progress_every_ten(spark):
    df = spark.createDataFrame([(i, "s", i % 3 == 0) for i in range(25)], "i long, src string, ok boolean")
    got = cat.lookup_progress(df, ["src"], ["i"], F.col("ok")).orderBy("i").collect()
    assert [(r.i, r.ok, r.failed) for r in got] == [(10, 4, 6), (20, 7, 13)]


def test_new_entries_and_first_hit(spark):
    fetched = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3")], "k string, uuid string")
    existing = spark.createDataFrame([("a",)], "k string")
    assert [tuple(r) for r in cat.new_entries(fetched, existing, "k", "uuid").collect()] == [("b", "3")]
    hits = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, rank int, uuid string")
    assert {r.k: r.hit for r in cat.first_hit(hits, "k", "rank", "uuid").collect()} == {"a": "y", "b": "z"}


def test_reconcile_copy(spark, tmp):
    df = spark.createDataFrame([(1, "a,b"), (2, 'q"uote')], "i int, s string")
    r = sinks.reconcile_copy(df, os.path.join(tmp, "copy"), "csv").first()
    assert (r.n_src, r.n_dst, r.n_cols_src, r.n_cols_dst, r.ok) == (2, 2, 2, 2, True)


def test_line_numbers_restart_per_file(spark, tmp):
    d = os.path.join(tmp, "logs")
    os.makedirs(d)
    open(os.path.join(d, "a.log"), "w").write("a1\na2\na3\n")
    open(os.path.join(d, "b.log"), "w").write("b1\nb2\n")
    got = sorted((r.file_name, r.line_no, r.value) for r in readers.read_lines(spark, d).collect())
    assert got == [("a.log", 1, "a1"), ("a.log", 2, "a2"), ("a.log", 3, "a3"), ("b.log", 1, "b1"), ("b.log", 2, "b2")]


def test_equal_names_in_two_folders_are_two_files(spark, tmp):
    for d, text in (("x", "1\n2\n"), ("y", "3\n4\n")):
        os.makedirs(os.path.join(tmp, d))
        open(os.path.join(tmp, d, "run.log"), "w").write(text)
    got = sorted((r.line_no, r.value) for r in readers.read_lines(spark, [os.path.join(tmp, "x"), os.path.join(tmp, "y")]).collect())
    assert got == [(1, "1"), (1, "3"), (2, "2"), (2, "4")]


def test_columns_are_read_by_name(spark, tmp):
    p = os.path.join(tmp, "prices.csv")
    open(p, "w").write("region,averageUnitPrice,sidecarCode\nGA,1.5,00002771559\n")
    assert [tuple(r) for r in readers.read_price_list(spark, p).collect()] == [("00002771559", 1.5)]
    d = os.path.join(tmp, "cat")
    os.makedirs(d)
    lines = CATALOG_CSV.splitlines()
    for i in range(3):
        open(os.path.join(d, f"part-{i}.csv"), "w").write("extra," + lines[0] + "\n" + "".join(f"{i}," + x + "\n" for x in lines[1 + i:2 + i]))
    got = readers.read_catalog(spark, d).orderBy("ordinal").collect()
    assert [(r.ordinal, r.PROCEDURE_CODE) for r in got] == [(0, "00012345678"), (1, "12345678901"), (2, "22222222222")]


def test_a_results_file_without_required_columns_raises(spark, tmp):
    import pytest

    p = os.path.join(tmp, "fact.csv")
    open(p, "w").write("state,zip_code\nGA,30301\n")
    with pytest.raises(ValueError, match="pharmacy_name"):
        readers.read_fact_csv(spark, p)


def test_an_unreadable_ledger_raises(spark, tmp):
    import pytest

    assert readers.read_ledger(spark, os.path.join(tmp, "none")).count() == 0
    bad = os.path.join(tmp, "ledger")
    os.makedirs(bad)
    open(os.path.join(bad, "part-0.parquet"), "w").write("no parquet")
    with pytest.raises(Exception):
        readers.read_ledger(spark, bad).count()


def test_small_cases_of_lookup_and_match(spark):
    from coverlens.operators import matching as mt

    a = spark.createDataFrame([("2771559",), (None,)], "c string")
    b = spark.createDataFrame([("00002771559",), ("7",)], "c string")
    assert [r.code for r in mt.code_intersection(a, "c", b, "c").collect()] == ["2771559"]
    df = spark.createDataFrame([(i, "s", None if i == 3 else True) for i in range(10)], "i long, src string, ok boolean")
    assert [(r.ok, r.failed) for r in cat.lookup_progress(df, ["src"], ["i"], F.col("ok")).collect()] == [(9, 1)]
    m = spark.createDataFrame([("2771559", ""), ("2771559", "id")], "k string, v string")
    assert cat.enrich(a, "c", m, "k", "v").count() == 2
    assert [r.v for r in cat.resolve(a, "c", m, "k", "v").collect()] == ["id"]
