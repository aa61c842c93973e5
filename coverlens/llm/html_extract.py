"""HTML extraction: a tree-structured graphical model over DOM nodes.

Every block element of a page is a binary variable, content or not.  Its own features (tag,
class words, text and link amounts) give a node potential, each parent and child share an
edge potential, and sum-product messages, up from the leaves and down from the root, give
each node's marginal.  Node and edge weights are trained on labelled pages by the gradient
of the conditional likelihood, which the same messages provide.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.common import free_prefix, quoted

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that only mark up the text of the block around them.
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong "
                   "sub sup time tt u var wbr".split())
#: Elements whose text is never shown as text.
SILENT = frozenset("head script style template title iframe textarea select".split())
#: A block start ends an open paragraph; these end an open element of their own kind too.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
#: Labelled pages that the weights are trained on: from the table, and composed ones.
SAMPLE_PAGES = 200
COMPOSED_PAGES = 1600
#: A node inside an article of the table counts as content while composed pages alone make it this likely.
DOUBT = 0.2
_PART = 128


@dataclass
class Node:
    tag: str
    words: tuple[str, ...]
    parent: int
    silent: bool
    label: int | None = None
    chars: int = 0  # own text
    linked: int = 0  # own text inside links
    stops: int = 0  # sentence marks in own text
    runs: list[int] = field(default_factory=list)


class Tree(HTMLParser):
    """Block elements in document order (parents first) and the text runs between their tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#root", (), -1, False)]
        self.open: list[tuple[str, int]] = [("#root", 0)]  # every open element, with its block
        self.count = {"#root": 1}
        self.pieces: list[list[str]] = []  # text runs
        self.fresh = True
        self.links = 0

    def _push(self, tag: str, block: int) -> None:
        self.open.append((tag, block))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.links += tag == "a"

    def _close(self, tag: str) -> None:
        while True:
            name, _ = self.open.pop()
            self.count[name] -= 1
            self.links -= name == "a"
            self.fresh = self.fresh or name not in INLINE
            if name == tag:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in INLINE:
            if tag == "br":
                self.fresh = True
            elif tag not in VOID:
                self._push(tag, self.open[-1][1])
            return
        if tag == "body" and self.count.get("body") or tag == "html" and self.count.get("html"):
            return
        if tag in _SIBLINGS:
            # The nearest open block decides: an item ends the one before it, not one further out.
            name = next((t for t, _ in reversed(self.open) if t not in INLINE and t != "p"), "")
            if name in _SIBLINGS[tag]:
                self._close(name)
        elif self.count.get("p"):
            self._close("p")
        parent = self.open[-1][1]
        words = [tag] if tag in ("p", "div", "li") else []
        label = None
        for k, v in attrs:
            if k in ("class", "id", "role") and v:
                words += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", v).lower())
            elif k == "data-label":
                label = int(v)
            elif k == "hidden" or k == "aria-hidden" and v == "true":
                words.append("hidden")
        self.fresh = True
        self.nodes.append(Node(tag, tuple(words), parent, tag in SILENT or self.nodes[parent].silent, label))
        if tag not in VOID:
            self._push(tag, len(self.nodes) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "li", "a", "b", "i", "span"):
            if self.open[-1][0] == tag:
                self._close(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID and self.count.get(tag) and tag != "#root":
            self._close(tag)
        elif tag in ("br", "p"):
            self.fresh = True

    def handle_data(self, data: str) -> None:
        at = self.open[-1][1]
        node = self.nodes[at]
        if node.silent:
            return
        if self.fresh or not node.runs or node.runs[-1] != len(self.pieces) - 1:
            if not data.strip():
                return
            node.runs.append(len(self.pieces))
            self.pieces.append([])
            self.fresh = False
        self.pieces[-1].append(data)
        n = len(data)
        node.chars += n
        node.linked += n if self.links else 0
        node.stops += data.count(".") + data.count(",")


def parse(html: str | None) -> Tree:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    return tree


def _bucket(x: float) -> int:
    return min(12, int(math.log2(x + 1)))


def node_features(tree: Tree) -> list[list[str]]:
    """Names of the binary features of every node."""
    nodes = tree.nodes
    chars, linked, stops = ([getattr(n, k) for n in nodes] for k in ("chars", "linked", "stops"))
    blocks = [int(n.tag == "p") for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        linked[p] += linked[i]
        stops[p] += stops[i]
        blocks[p] += blocks[i]
    total = max(1, chars[0])
    out = []
    for i, n in enumerate(nodes):
        f = ["bias", "tag=" + n.tag, f"links={int(4 * linked[i] / max(1, chars[i]))}", f"own={min(4, _bucket(n.chars) // 2)}",
             f"stops={min(3, _bucket(100 * stops[i] / max(1, chars[i])))}", f"blocks={min(4, blocks[i])}",
             f"share={int(4 * chars[i] / total)}"]
        f += ["word=" + w for w in set(n.words)] + ["up=" + w for w in set(nodes[max(0, n.parent)].words) - {"p", "div", "li"}]
        out.append(f)
    return out


@dataclass
class Model:
    """Log potentials: ``unary[feature]`` for content against not, ``edge[(kind of child)]`` as a 2x2 table."""

    unary: dict[str, float] = field(default_factory=dict)
    edge: dict[str, list[list[float]]] = field(default_factory=dict)


def _kind(n: Node) -> str:
    return n.tag if n.tag in ("p", "li", "ul", "ol", "h1", "h2", "h3", "div", "section", "article", "table", "tr", "td",
                              "blockquote", "pre", "figure") else "other"


_FLAT = [[0.0, 0.0], [0.0, 0.0]]


def marginals(tree: Tree, model: Model, feats: list[list[str]] | None = None, pairs: bool = False):
    """P(content) of every node by one upward and one downward pass; with ``pairs`` the edge marginals too.

    Nodes are numbered parents first, so both passes are plain loops, whatever the depth.
    """
    nodes = tree.nodes
    feats = feats or node_features(tree)
    get = model.unary.get
    edges = [model.edge.get(_kind(n), _FLAT) for n in nodes]
    n = len(nodes)
    up = [[0.0, sum([get(f, 0.0) for f in fs])] for fs in feats]  # log belief from below, by state
    msg = [(0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):
        e, (b0, b1) = edges[i], up[i]
        m = []
        for s in (0, 1):
            x, y = b0 + e[s][0], b1 + e[s][1]
            hi, lo = (x, y) if x > y else (y, x)
            m.append(hi + math.log1p(math.exp(lo - hi)))
        msg[i] = (m[0], m[1])
        p = up[nodes[i].parent]
        p[0] += m[0]
        p[1] += m[1]
    belief = [None] * n
    joint = [None] * n
    belief[0] = up[0]
    for i in range(1, n):
        q, e, (b0, b1) = belief[nodes[i].parent], edges[i], up[i]
        o0, o1 = q[0] - msg[i][0], q[1] - msg[i][1]  # what the parent knows without this child
        cells = [o0 + e[0][0] + b0, o0 + e[0][1] + b1, o1 + e[1][0] + b0, o1 + e[1][1] + b1]
        hi = max(cells)
        w = [math.exp(c - hi) for c in cells]
        z = sum(w)
        belief[i] = [math.log(max((w[0] + w[2]) / z, 1e-300)), math.log(max((w[1] + w[3]) / z, 1e-300))]
        if pairs:
            joint[i] = [c / z for c in w]
    d0 = belief[0][0] - belief[0][1]
    prob = [1 / (1 + math.exp(min(700, max(-700, d0))))] + [math.exp(b[1]) for b in belief[1:]]
    return (prob, joint) if pairs else prob


def train(pages: Sequence[tuple[Tree, list[int]]], epochs: int = 8, rate: float = 0.3, l2: float = 1e-4, start: Model | None = None) -> Model:
    """Maximum conditional likelihood by stochastic gradients: observed minus expected features, from the marginals."""
    model, grad2 = Model(), {}
    if start:
        model = Model(dict(start.unary), {k: [list(row) for row in v] for k, v in start.edge.items()})
    rows = [(t, y, node_features(t)) for t, y in pages]
    order = random.Random(5)

    def move(store: dict, key, g: float, old: float) -> float:
        g -= l2 * old
        grad2[key] = grad2.get(key, 1e-2) + g * g
        return old + rate * g / math.sqrt(grad2[key])

    for _ in range(epochs):
        order.shuffle(rows)
        for tree, y, feats in rows:
            prob, joint = marginals(tree, model, feats, pairs=True)
            g1: dict[str, float] = {}
            g2: dict[tuple, float] = {}
            for i, fs in enumerate(feats):
                d = y[i] - prob[i]
                for f in fs:
                    g1[f] = g1.get(f, 0.0) + d
                if i:
                    kind = _kind(tree.nodes[i])
                    seen = 2 * y[tree.nodes[i].parent] + y[i]
                    for c in range(4):
                        k = (kind, c)
                        g2[k] = g2.get(k, 0.0) + (c == seen) - joint[i][c]
            for f, g in g1.items():
                model.unary[f] = move(model.unary, f, g, model.unary.get(f, 0.0))
            for (kind, c), g in g2.items():
                table = model.edge.setdefault(kind, [[0.0, 0.0], [0.0, 0.0]])
                table[c // 2][c % 2] = move(table, (kind, c), g, table[c // 2][c % 2])
    return model


def own_labels(tree: Tree, model: Model | None = None) -> list[int]:
    """Labels of a page: those written in it (``data-label``, inherited), else from its ``article`` element.

    Elements around labelled ones count as content when at least half of the text in them is.
    With ``model``, what stands in the article counts as content only where the model does not
    doubt it, so adverts, forms and comments of readers in there are not learnt as content.
    """
    nodes = tree.nodes
    written = any(n.label is not None for n in nodes)
    prob = marginals(tree, model) if model and not written else None
    labels: list[int | None] = []
    for i, n in enumerate(nodes):
        above = labels[n.parent] if n.parent >= 0 else None
        own = n.label if written else 1 if n.tag == "article" and above is None else None
        if n.silent:
            labels.append(0)
        elif own is not None or above is None:
            labels.append(own)
        else:
            labels.append(int(above and (prob is None or prob[i] >= DOUBT)))
    text = [n.chars for n in nodes]
    core = [n.chars * (y or 0) for n, y in zip(nodes, labels, strict=True)]
    for i in range(len(nodes) - 1, 0, -1):
        text[nodes[i].parent] += text[i]
        core[nodes[i].parent] += core[i]
    return [int(2 * c >= t > 0) if y is None else y for y, c, t in zip(labels, core, text, strict=True)]


#: Words by which page builders name the parts of a page, one part in each line.
PARTS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topbar tabs pager pagination toc skip links",
    "header": "header masthead branding logo top banner site head hero",
    "footer": "footer copyright legal bottom colophon imprint foot credits",
    "aside": "sidebar aside related widget rail secondary complementary recommended popular trending more teaser",
    "notice": "notice cookie consent gdpr alert warning banner message popup modal overlay paywall privacy announcement disclaimer info",
    "ad": "ad ads advert advertisement adsense sponsored sponsor promo promotion promoted commercial",
    "form": "form newsletter subscribe signup login search contact feedback subscription",
    "comments": "comments comment reader replies reply discussion respond disqus responses",
    "share": "share social sharing follow meta tags byline author toolbar buttons",
}
MAIN = "content main article post entry story body text page maincontent postbody articlebody"


def composed_page(seed: int) -> str:
    """A labelled page of random layout: parts around and inside a core of content, labels in ``data-label``.

    Cores are articles, mains, plain or named divisions, or blocks without any element around
    them, of one short line to long texts; pages may be fragments without ``html`` and ``body``
    and may have no other parts at all.
    """
    r = random.Random(seed)

    odd = r.choice(["", "", "", "", "", "repeat", "bare", "signs", "commas"])  # junk texts stand in articles too

    def words(n: int, inside: bool = False) -> str:
        if inside and odd == "repeat":
            return " ".join(["tora"] * n)
        out = ["".join(r.choice(["ra", "to", "en", "li", "su", "ka", "do"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
        marks = {"signs": ["### ", "$$$", "&amp;&amp;"], "commas": [","], "": [",", ".", "", "", "", ""]}.get(odd if inside else "", [""])
        end = not odd if inside else r.random() < 0.5
        return " ".join(w + r.choice(marks) for w in out).capitalize() + "." * end

    def named(kind: str) -> str:
        w = r.choice(MAIN.split() if kind == "main" else PARTS[kind].split())
        name = r.choice([w, w, w + "-" + r.choice(["box", "wrap", "area", "list", "inner", "section"]), w.capitalize()])
        return r.choice([f' class="{name}"', f' class="{name}"', f' id="{name}"', f' class="block {name}"'])

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{words(r.randint(1, 3))}</a></li>' for _ in range(n)) + "</ul>"

    def part(kind: str) -> str:
        tag = {"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"],
               "form": ["form", "div", "section"], "comments": ["section", "div", "ol"]}.get(kind, ["div", "section", "aside", "p", "p"])
        t = r.choice(tag)
        name = named(kind) if t in ("div", "section", "p", "ul", "ol") or r.random() < 0.4 else ""
        if kind == "nav":
            body = links(r.randint(2, 8)) if t != "ul" else links(r.randint(2, 8))[4:-5]
        elif kind == "comments":
            one = ["article", "div", "li"] if t != "ol" else ["li"]
            c = r.choice(one)
            body = r.choice(["", f"<h2>{words(1)}</h2>"]) * (t != "ol") + "".join(
                f'<{c}{named("comments") if r.random() < 0.7 else ""}><p>{words(r.randint(3, 40))}</p></{c}>' for _ in range(r.randint(1, 4)))
        elif kind == "form":
            body = f'<label>{words(2)}</label><input name="q"><button>{words(1)}</button>' + r.choice(["", f"<p>{words(8)}</p>"])
        elif kind == "footer":
            body = r.choice([f"&copy; {words(r.randint(2, 9))}", f"<p>{words(r.randint(2, 12))}</p>", links(3)])
        elif kind == "header":
            body = r.choice([f"<h1>{words(2)}</h1>", f'<a href="/">{words(2)}</a>', words(4)])
        elif kind == "aside":
            body = r.choice([f"<h3>{words(2)}</h3>" + links(4), f"<p>{words(r.randint(5, 40))}</p>", words(r.randint(5, 30))])
        else:
            body = r.choice([words(r.randint(2, 40)), f"<p>{words(r.randint(4, 40))}</p>"]) if t != "p" else words(r.randint(2, 40))
        return f'<{t}{name} data-label="0">{body}</{t}>'

    def block() -> str:
        return r.choice([
            *[lambda: f"<p>{words(r.randint(1, 90), True)}</p>"] * 6, lambda: f"<p><b>{words(r.randint(4, 60), True)}</b><br></p>",
            lambda: f"<p>{words(r.randint(90, 400), True)}</p>",
            lambda: f"<h2>{words(3, True)}</h2>", lambda: f"<blockquote><p>{words(15, True)}</p></blockquote>",
            lambda: r.choice(["<ul>%s</ul>", "<ol>%s</ol>"]) % "".join(f"<li>{words(r.randint(2, 12), True)}</li>" for _ in range(3)),
            lambda: f"<p>{words(12, True)} <a href='/y'>{words(2)}</a> {words(5, True)}</p>",
            lambda: "<table>" + "".join(f"<tr><td>{words(2)}</td><td>{words(2)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>",
            lambda: f"<pre>{words(6, True)}</pre>", lambda: f"<div>{words(r.randint(4, 60), True)}</div>",
            lambda: f"<section><h3>{words(2)}</h3><p>{words(30, True)}</p></section>",
            lambda: f"<details><summary>{words(3)}</summary><p>{words(r.randint(3, 40), True)}</p></details>",
            lambda: f"<figure><img src=x><figcaption>{words(r.randint(3, 12), True)}</figcaption></figure>",
            lambda: "<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", lambda: f"<noscript><p>{words(r.randint(3, 12), True)}</p></noscript>",
            lambda: f"<dl><dt>{words(1)}</dt><dd>{words(8, True)}</dd></dl>",
        ])()

    alone = r.random() < 0.2  # nothing but the core
    inner = [f"<h1>{words(r.randint(1, 6), True)}</h1>"] * (r.random() < 0.7) + [block() for _ in range(r.randint(0 if r.random() < 0.1 else 1, 9))]
    if r.random() < 0.15:
        inner = inner[:1] + [f"<p>{words(r.randint(1, 20), True)}</p>"]
    inner = inner or [f"<p>{words(9, True)}</p>"]
    for kind in r.sample(sorted(set(PARTS) - {"header"}), 0 if alone else r.choice([0, 0, 0, 1, 2])):
        inner.insert(r.randint(0, len(inner)), part(kind))
    if r.random() < 0.25 and not alone:
        inner.append(part("comments"))
    name = named("main") if r.random() < 0.5 else ""
    core = r.choice([f"<article{name}>%s</article>"] * 6 + [f"<main{name}>%s</main>"] * 2 + [f"<div{named('main')}>%s</div>"] * 2
                    + [f"<main><article{name}>%s</article></main>", "<div>%s</div>", "<div>%s</div>", "<section>%s</section>", "%s", "%s"])
    if core == "%s":
        core = "".join(x if " data-label=" in x[:x.index(">")] else re.sub(r"^<(\w+)", r'<\1 data-label="1"', x) for x in inner)
    else:
        core = re.sub(r"^<(\w+)", r'<\1 data-label="1"', core) % "".join(inner)
    often = r.choice([0.2, 0.45, 0.45, 0.6]) * (not alone)
    before = [part(k) for k in ("header", "nav", "notice", "ad", "aside", "form") if r.random() < often]
    after = [part(k) for k in ("share", "aside", "comments", "ad", "form", "notice", "footer") if r.random() < often]
    r.shuffle(before)
    page = "".join([*before, core, *after])
    if r.random() < 0.3:
        page = f"<div{r.choice(['', ' class=wrapper', ' id=page', ' class=container'])}>{page}</div>"
    if r.random() < 0.2:
        return page
    return f"<html><head><title>{words(3)}</title><script>var a = '<p>';</script></head><body>{page}</body></html>"


def fit(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES, composed: int = COMPOSED_PAGES) -> Model:
    """Weights from ``composed`` labelled pages and at most ``sample_pages`` pages of the table that have one article.

    The sample is chosen by a hash of the pages, equal pages once, so it depends neither on the
    order of the rows nor on copies, and only it is sent to the driver; nothing else is bounded
    here, every page is extracted.  Composed pages come first; what they teach decides which
    nodes of the sampled articles count as content, then learning goes on with both.
    """
    scale = 1 << 30
    share = min(scale, -(-scale * 2 * sample_pages // max(1, pages.count())))
    mark = F.pmod(F.xxhash64(quoted(html_col)), F.lit(scale))
    got = (pages.filter((mark < share) & quoted(html_col).contains("<article")).select(mark.alias("mark"), quoted(html_col).alias("html"))
           .distinct().orderBy("mark", "html").limit(sample_pages).collect())
    made = [(t, own_labels(t)) for t in (parse(composed_page(i)) for i in range(composed))]
    model = train(made)
    trees = [t for t in (parse(r.html) for r in got) if sum(n.tag == "article" for n in t.nodes) == 1]
    return train(made[::4] + [(t, own_labels(t, model)) for t in trees], epochs=3, rate=0.1, start=model) if trees else model


def extract(html: str | None, model: Model, threshold: float = 0.5) -> str:
    """The main text of one page: runs of nodes that are content, white space as single blanks, in page order."""
    tree = parse(html)
    if not tree.pieces:
        return ""
    prob = marginals(tree, model)
    keep = sorted(r for n, p in zip(tree.nodes, prob, strict=True) if p >= threshold for r in n.runs)
    return " ".join(x for x in (" ".join("".join(tree.pieces[r]).split()) for r in keep) if x)


def extract_text(pages: DataFrame, model: Model, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Every row of ``pages`` without the html, with the main text (empty for null, empty or all-boilerplate html).

    An input column called like the result is replaced.  Pages go whole, one by one, whatever
    their length or depth; repeated rows stay repeated.
    """
    keep = [c for c in pages.columns if c.lower() not in (html_col.lower(), out_col.lower())]
    html = free_prefix(keep, "html_to_read")
    rows = pages.select(*[quoted(c) for c in keep], quoted(html_col).alias(html))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _PART):
                b = whole.slice(at, _PART)
                text = [extract(h, m) for h in b.column(b.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(text, pa.string())], names=[*keep, out_col])

    return rows.mapInArrow(run, rows.drop(html).withColumn(out_col, F.lit("")).schema)


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages, fit(pages)).withColumn("n_chars", F.length("text").cast("long"))
