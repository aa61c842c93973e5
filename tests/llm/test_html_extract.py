"""HTML extraction: the tree, exact marginals, and held-out pages."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from coverlens.llm import html_extract as hx


@pytest.fixture(scope="module")
def model():
    trees = [hx.parse(hx.composed_page(i)) for i in range(1000)]
    return hx.train([(t, hx.own_labels(t)) for t in trees])


def test_marginals_equal_sums_over_all_labellings():
    tree = hx.parse("<div><p>a b c.</p><ul><li>x</li><li>y z</li></ul></div><nav><a href=q>k</a></nav>")
    names = {f for fs in hx.node_features(tree) for f in fs}
    m = hx.Model({f: ((hash_ * 37) % 19 - 9) / 5 for hash_, f in enumerate(sorted(names))},
                 {k: [[0.3, -0.7], [-1.1, 0.9]] for k in ("p", "li", "ul", "div", "other")})
    feats = hx.node_features(tree)
    total, on = 0.0, [0.0] * len(tree.nodes)
    for y in itertools.product((0, 1), repeat=len(tree.nodes)):
        s = sum(sum(m.unary[f] for f in fs) for fs, v in zip(feats, y, strict=True) if v)
        s += sum(m.edge.get(hx._kind(n), hx._FLAT)[y[n.parent]][y[i]] for i, n in enumerate(tree.nodes) if i)
        total += math.exp(s)
        for i, v in enumerate(y):
            on[i] += v * math.exp(s)
    assert hx.marginals(tree, m) == pytest.approx([x / total for x in on], rel=1e-9)


def test_held_out_pages(model):
    wrong = nodes = 0
    for seed in range(90_000, 90_150):
        tree = hx.parse(hx.composed_page(seed))
        for n, p, y in zip(tree.nodes, hx.marginals(tree, model), hx.own_labels(tree), strict=True):
            if n.runs:
                nodes += 1
                wrong += (p >= 0.5) != y
    assert wrong / nodes < 0.02


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x}</style></head><body><header>Site</header><nav><ul><li><a href=/a>Home</a>
<li><a href=/b>News</a></ul></nav><div class="cookie-notice">We use cookies.</div><article><h1>A &amp; B&nbsp;&lt;c&gt;</h1>
<p>First   line,
with <b>bold</b>face.<br>Next.<p>Second &#233;&#x1F600; and some more words here.</p><div class="ad">Buy now.</div><script>var a="</p>";</script>
<form><input><button>Go</button></form><section class="comments"><p>Nice text, reader says.</p></section></article>
<aside><p>Related.</p></aside><footer>&copy; x</footer></body></html>"""


def test_a_page(model):
    assert hx.extract(PAGE, model) == "A & B <c> First line, with boldface. Next. Second é😀 and some more words here."


def text(n, seed=0):
    """``n`` sentences of plain words, none of them made by ``composed_page``."""
    r = random.Random(seed)
    pick = "the river runs past old stone houses while people walk home from market with bread and apples today".split()
    return " ".join(" ".join(r.choice(pick) for _ in range(r.randint(5, 12))).capitalize() + "." for _ in range(n))


def paragraphs(n, size=3):
    return "".join(f"<p>{text(size, i)}</p>" for i in range(n)), " ".join(text(size, i) for i in range(n))


EIGHT, EIGHT_TEXT = paragraphs(8)
FOUR, FOUR_TEXT = paragraphs(4)
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li><li><a href=/c>Sport</a></li></ul>"
#: Pages of many forms with their main text, written by hand.
FORMS = {
    "long article, fragment": (f"<article><p>{text(200)}</p></article>", text(200)),
    "50 comma words": ("<article><p>" + "word, " * 50 + "</p></article>", ("word, " * 50).strip()),
    "500 comma words": ("<article><p>" + "word, " * 500 + "</p></article>", ("word, " * 500).strip()),
    "named division": (f"<header>My Site</header><div class=content>{EIGHT}</div><footer>(c) 2020 me</footer>", EIGHT_TEXT),
    "plain division": (f"<html><body><div>{EIGHT}</div></body></html>", EIGHT_TEXT),
    "details, math, noscript": (
        f"<html><body><nav>{MENU}</nav><article><h1>A title</h1>{FOUR}<details><summary>More</summary><p>{text(2, 50)}</p></details>"
        f"<math><mi>x</mi></math><noscript><p>{text(1, 60)}</p></noscript></article></body></html>",
        f"A title {FOUR_TEXT} More {text(2, 50)} x {text(1, 60)}"),
    "heading and one line": ("<html><body><article><h1>Title</h1><p>One short line.</p></article></body></html>", "Title One short line."),
    "heading and eight": (f"<html><body><article><h1>Title</h1>{EIGHT}</article></body></html>", f"Title {EIGHT_TEXT}"),
    "bare paragraphs": (f"<html><body><header>My site</header><nav>{MENU}</nav><h1>Title</h1>{EIGHT}<footer>Copyright</footer></body></html>",
                        f"Title {EIGHT_TEXT}"),
    "main with comments": (
        f"<html><body><div id=header>Logo</div><main><h1>A day out</h1>{FOUR}<div class=comments><p>nice one</p><p>so true</p></div></main>"
        f"<div class=sidebar><p>{text(1, 70)}</p></div></body></html>", f"A day out {FOUR_TEXT}"),
    "wrapped, advert inside": (
        f'<html><body><div id="page"><div class="topbar">{MENU}</div><div class="entry-content">{FOUR}<div class="advert">Buy two, pay one.</div>'
        f'{EIGHT}</div><section id="comments"><h3>Replies</h3><p>{text(1, 80)}</p></section></div></body></html>', f"{FOUR_TEXT} {EIGHT_TEXT}"),
    "table and figure": (
        f"<html><body><article>{FOUR}<table><tr><td>Year</td><td>Rain</td></tr><tr><td>1999</td><td>12 mm</td></tr></table>"
        "<figure><img src=a><figcaption>A house by the river.</figcaption></figure></article><aside><h3>Related</h3>" + MENU + "</aside></body></html>",
        f"{FOUR_TEXT} Year Rain 1999 12 mm A house by the river."),
    "cookie notice and form": (
        f'<body><div class="cookie-consent"><p>We use cookies on this site.</p><button>Accept</button></div><article>{EIGHT}</article>'
        '<form class="newsletter"><label>Your mail</label><input><button>Send</button></form></body>', EIGHT_TEXT),
    "one paragraph": (f"<p>{text(3)}</p>", text(3)),
    "text alone": ("just some plain text without any tag", "just some plain text without any tag"),
}


@pytest.mark.parametrize("form", FORMS)
def test_forms(model, form):
    html, want = FORMS[form]
    got = Counter(hx.extract(html, model).split())
    right = sum((got & Counter(want.split())).values())
    assert right >= 0.95 * len(want.split()) and right >= 0.95 * sum(got.values()), hx.extract(html, model)


def test_labels_of_elements_around_content():
    tree = hx.parse("<html><body><nav>" + MENU + "</nav><div><article>" + EIGHT + "<div class=ad>Buy it</div></article></div></body></html>")
    named = {t: y for t, y in zip((n.tag for n in tree.nodes), hx.own_labels(tree), strict=True)}
    assert (named["html"], named["body"], named["nav"], named["article"], named["p"]) == (1, 1, 0, 1, 1)
    doubting = hx.Model({"word=ad": -9.0, "tag=p": 9.0, "tag=article": 9.0})
    inside = dict(zip((" ".join((n.tag, *n.words)) for n in tree.nodes), hx.own_labels(tree, doubting), strict=True))
    assert inside["div div ad"] == 0 and inside["p p"] == 1


def test_fit_does_not_depend_on_row_order(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    a, b = (hx.fit(p, composed=80, sample_pages=20) for p in (pages, pages.orderBy(F.rand(3)).repartition(5)))
    assert a == b


def test_clashing_columns(spark, model):
    df = spark.createDataFrame([(1, "<p>" + text(3) + "</p>", "a", "b")], "page_id long, html string, html_to_read string, HTML_TO_READ_ string")
    got = hx.extract_text(df, model).collect()
    assert [tuple(r) for r in got] == [(1, "a", "b", text(3))]


def test_rows(spark, model):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    broken = "<article><p>Open <b>bold <i>both<p>next</b> rest, of it.</article></article></div>"
    df = spark.createDataFrame([(1, PAGE, "t"), (2, None, "t"), (3, "", "t"), (4, "<script>x</script><!-- y -->", "t"), (5, deep, "t"), (6, broken, "t"),
                                (6, broken, "t"), (7, "<article><p>" + "word, " * 50_000 + "</p></article>", None)], "page_id long, html string, TEXT string")
    got = hx.extract_text(df, model)
    assert got.columns == ["page_id", "text"]
    texts = sorted((r.page_id, r.text) for r in got.collect())
    assert [t for i, t in texts if i in (2, 3, 4)] == ["", "", ""]
    assert [t for i, t in texts if i == 6] == ["Open bold both next rest, of it."] * 2
    assert [len(t) for i, t in texts if i == 7] == [50_000 * 6 - 1]
    assert hx.extract_text(df.limit(0), model).collect() == []


def test_fit_without_pages(spark):
    m = hx.fit(spark.createDataFrame([], "page_id long, html string"), composed=60)
    assert m.unary
