"""URL filters against a brute-force reading of the rules."""

from coverlens.llm.url_filter import RULES, filter_urls, rules_frame

URLS = [
    None, "", "no scheme/en/1", "http://", "http://org/", "http://org", "http://a.ORG/x?y#z", "http://xorg/", "http://b.a.org?x",
    "https://www.Example.org/es/5", "https://www.example.org/en/15", "https://www.example.org/en/2", "http://example.org/en/1",
    "http://sub.com/fr/", "http://sub.com/fr", "http://com/de/x", "http://com/en/", "a://b://c.org/p", "http://a..org/",
    "http://.org/q", "http://host:80/", "http://éxample.org/ÉS/", "http://x.com/de/" + "p" * 5000, "http://x.org/\nline",
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


def test_against_brute_force_with_repeats_and_clashing_columns(spark):
    rows = [(i, u, "kept", "lost") for i, u in enumerate(URLS)] + [(3, URLS[3], "kept", "lost")] * 3
    df = spark.createDataFrame(rows, "page_id long, url string, url_key_ string, VERDICT string")
    got = filter_urls(df, rules_frame(spark))
    assert got.columns == ["page_id", "url", "url_key_", "host", "path", "rule", "verdict"]
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    want = sorted(((i, *brute(u, RULES)) for i, u, *_ in rows), key=key)
    assert sorted((tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()), key=key) == want


def test_ties_and_general_rules(spark):
    rules = [("a.b.c", "/", "allow"), ("b.c", "/xy", "block"), ("c", "", "allow"), ("b.c", "/", "allow"), ("b.c", "/", "block"),
             ("b.c", "/", "block"), (None, "/", "block"), ("c", None, "block"), ("Q.c", "/z", "block")]
    urls = ["http://a.b.c/", "http://b.c/xyz", "http://b.c/", "http://c", "http://d", "http://q.c/zz", None]
    df = spark.createDataFrame(list(enumerate(urls)), "id long, url string")
    got = {r.id: (r.rule, r.verdict) for r in filter_urls(df, rules_frame(spark, rules), default="block").collect()}
    assert got == {0: ("a.b.c/", "allow"), 1: ("b.c/xy", "block"), 2: ("b.c/", "block"), 3: ("c", "allow"), 4: (None, "block"),
                   5: ("q.c/z", "block"), 6: (None, "block")}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(none, rules_frame(spark)).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in filter_urls(one, rules_frame(spark).limit(0)).collect()] == ["allow"]


def test_extra_columns_with_working_names(spark):
    df = spark.createDataFrame([("http://a.org/x", 1, 2, "k")], "url string, b_host int, b_path int, url_key_ string")
    got = filter_urls(df, rules_frame(spark)).collect()
    assert [(r.b_host, r.b_path, r.url_key_, r.host, r.verdict) for r in got] == [(1, 2, "k", "a.org", "allow")]
