"""Line dedup: exact set-similarity join over the lines of all documents.

A line is the set of its runs of five words.  Its tokens are ordered by rarity; two lines
with a Jaccard similarity of at least t share a token among the first
``n - ceil(t n) + 1`` of each, at positions and lengths that still allow the overlap.  Pairs
that pass these filters are verified on the whole sets, and of two matching lines the later
one goes.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coverlens.llm.common import drop, free_prefix, quoted, store, with_seen

GRAM = 5
PERCENT = 80
#: Slots of the table of token counts that the rarity order is taken from (its size is fixed).
RARITY_SLOTS = 1 << 16
#: Bits of the tables of lines and sets to look at again: a fixed 512 KB, whatever the data.
WIDE_BITS = 22
#: Rounds that the lists of lines around a token are made in: only one round's tokens are in a shuffle at a time.
ROUNDS = 2
#: Bits of a set's length and of a token's place in it: an array of longs has fewer members than that.
_SIZE_BITS = 28
_BLANKS = r"[\x20\x09-\x0D]+"


def _words(line: Column) -> Column:
    """Words in lower case; only a line (that has no line feed) with a blank other than a space needs the regular expression."""
    low = F.lower(line)
    odd = F.lit(False)
    for c in "\t\v\f\r":
        odd = odd | F.contains(line, F.lit(c))
    # Without two blanks in a row or one at an end no piece is empty.
    gaps = F.contains(line, F.lit("  ")) | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" ")) | (line == "")
    return (F.when(odd, F.array_remove(F.split(low, _BLANKS), "")).when(gaps, F.array_remove(F.split(low, " "), ""))
            .otherwise(F.split(low, " ")))


def _run_hash(gram: int, word: Callable[[int], Column]) -> Column:
    """Hash of one run, given its k-th word: of the hashes of its words."""
    return F.xxhash64(*[F.xxhash64(word(k)) for k in range(gram)])


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once and goes through no row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _tokens(df: DataFrame, gram: int, *keep: str) -> DataFrame:
    """``keep`` and ``tokens`` from ``words``: the hashes of ``_run_hash`` for all runs, each word hashed once.

    A shorter line is one run, a blank one has none.
    """
    def runs(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - gram)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(gram)]))

    def tokens(words: Column) -> Column:
        whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(words) >= gram, _with(F.transform(words, lambda w: F.xxhash64(w)), runs)).otherwise(whole)

    return df.select(*keep, _with(F.col("words"), tokens).alias("tokens"))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, thash, line_no (from 0), line: one row per line; a null text has no lines."""
    return docs.select("doc_id", "thash", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def _rarity(lines: DataFrame, gram: int, slots: int) -> Column:
    """Array of ``slots`` small numbers: the logarithm of how many tokens of all lines fall on each slot.

    The counts cover every line; the table that comes back has ``slots`` rows whatever the data
    and goes into the plan as one constant.
    """
    slot = F.col("t").bitwiseAND(slots - 1).cast("int")
    # The tokens of _tokens, each in a row of its own: generated code is a tenth of an array function's cost here.
    words = _plain(lines, _words(F.col("line"))).withColumnRenamed("v", "words")
    at = words.filter(F.size("words") > 0).select("words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - gram, F.lit(0)))).alias("i"))
    token = F.when(F.size("words") >= gram, _run_hash(gram, lambda k: F.get("words", F.col("i") + k))).otherwise(F.xxhash64("words"))
    counts = (at.select(token.alias("t")).groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
              .select("slot", F.floor(F.log2(F.col("n") + 1)).cast("int").alias("level")))
    level = ["0"] * slots
    for r in counts.toLocalIterator():
        level[r.slot] = str(r.level)
    return F.split(F.lit(",".join(level)), ",").cast("array<bigint>")


def _plain(df: DataFrame, value: Column, *keep: str) -> DataFrame:
    """``keep`` and ``value`` as column ``v``: a generator between keeps the optimizer from copying a costly expression."""
    return df.select(*keep, F.explode(F.array(F.struct(value.alias("v")))).alias("s")).select(*keep, F.col("s.v").alias("v"))


def _ordered(df: DataFrame, rarity: Column, slots: int, *keep: str) -> DataFrame:
    """``keep`` and ``tokens``: distinct, rarest first (the count's logarithm in the top bits, the token's hash below)."""
    ranked = F.transform("tokens", lambda t: F.shiftleft(F.coalesce(F.get(rarity, t.bitwiseAND(slots - 1).cast("int")), F.lit(0).cast("bigint")), 57)
                         .bitwiseOR(F.shiftrightunsigned(t, 7)))
    got = df.select(*keep, ranked.alias("v"))
    return _plain(got, F.sort_array(F.array_distinct("v")), *keep).withColumnRenamed("v", "tokens")


def _need(n: Column, percent: int) -> Column:
    """ceil(percent / 100 * n)"""
    return F.floor((n * percent + 99) / 100).cast("int")


def line_marks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, percent: int = PERCENT,
               slots: int = RARITY_SLOTS) -> DataFrame:
    """One row per line of a document that loses lines: doc_id, thash, line_no, removed.

    Lines are what line feeds separate; words are what ASCII blanks separate, in lower case.
    Lines stand in the order of (doc_id, hash of the text, line number), null ids last.  A line
    is removed when an earlier line has a similarity ``100 * |x and y| >= percent * |x or y|``,
    whether or not that earlier line is removed itself.  Blank lines match nothing.  Repeated
    rows are one document: their lines are not later than themselves.  ``thash`` is Spark's
    xxhash64 of the text.  An empty table, or one without matches, gives no rows.

    Equal sets are one from the first aggregate on, combined before the shuffle, so a line that
    stands in a third of all documents is one row per task.  A list of lines that share a rare
    token is not paired out: all meet the list's most frequent set first, and only those that
    no earlier line has claimed by then are compared with the rest.
    """
    return _line_marks(docs, id_col, text_col, gram, percent, slots)[0]


def _line_marks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, percent: int = PERCENT,
                slots: int = RARITY_SLOTS, rounds: int = ROUNDS) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of ``line_marks``, and the stored tables that they are still read from."""
    base = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text")).withColumn("thash", F.xxhash64("text"))
    lines = _lines(base)
    rarity = _rarity(lines, gram, slots)
    of_line = ("doc_id", "thash", "line_no")
    full = _ordered(_tokens(lines.select(*of_line, _words(F.col("line")).alias("words")), gram, *of_line), rarity, slots, *of_line)
    n = F.size("tokens")
    # All texts are taken apart here, once; what follows reads these rows.
    marks = store(full.filter(n > 0).select("doc_id", "thash", "line_no", F.xxhash64("tokens").alias("key"), n.alias("n"),
                                            F.slice("tokens", F.lit(1), n - _need(n, percent) + 1).alias("front")))
    place = F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "thash", "line_no")
    sets = store(marks.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")))

    # A set of one line goes to its tokens as it is; only those of several lines are gathered first.
    known = with_seen(marks.select("key", "n", "front"), F.col("key"), sets.filter("times > 1").select(F.col("key").alias("h")), "seen", WIDE_BITS)
    whole = (known.filter("seen").groupBy("key").agg(F.first("n").alias("n"), F.first("front").alias("front"), F.count(F.lit(1)).alias("times"))
             .unionByName(known.filter(~F.col("seen")).select("key", "n", "front", F.lit(1).cast("long").alias("times"))))
    # A row of the shuffle is three longs: the token, the set, and its frequency (a logarithm), length and place in one.
    often = F.least(F.floor(4 * F.log2(F.col("times"))), F.lit(127)).cast("long")
    about = F.shiftleft(often, 2 * _SIZE_BITS).bitwiseOR(F.shiftleft(F.col("n").cast("long"), _SIZE_BITS)).alias("about")
    posts = whole.select("key", about, F.posexplode("front").alias("i", "t")).select("t", "key", F.col("about").bitwiseOR(F.col("i").cast("long")).alias("about"))
    by_token = Window.partitionBy("t")

    def size(about: str) -> Column:
        return F.shiftright(about, _SIZE_BITS).bitwiseAND((1 << _SIZE_BITS) - 1).cast("int")

    def at(about: str) -> Column:
        return F.col(about).bitwiseAND((1 << _SIZE_BITS) - 1).cast("int")

    def lists(part: int) -> DataFrame:
        """Sets that share a token of this round, each with its list's most frequent set (the hub); ``more`` tells lists of over two."""
        here = posts.filter(F.pmod("t", F.lit(rounds)) == part)
        # A set has a token once, so two rows of a token are two sets.
        return (here.withColumn("hub", F.max(F.struct(F.shiftright("about", 2 * _SIZE_BITS).alias("often"), "key", "about")).over(by_token))
                .withColumn("sets", F.count(F.lit(1)).over(by_token)).filter("sets > 1")
                .select("t", "key", size("about").alias("n"), at("about").alias("i"), F.col("hub.key").alias("hub"),
                        size("hub.about").alias("hub_n"), at("hub.about").alias("hub_i"), (F.col("sets") > 2).alias("more")))

    parts = [store(lists(k)) for k in range(rounds)]
    shared = reduce(DataFrame.unionByName, parts)
    places = store(marks.select("doc_id", "thash", "line_no", "key"))
    drop(marks)
    # Every token that the fronts of two sets have in common is in both sets' rows here.
    fronts = store(shared.groupBy("key").agg(F.first("n").alias("n"), F.collect_list("t").alias("front")))

    def passes(n: Column, i: Column, m: Column, j: Column) -> Column:
        """Length filter, and positional filter: the tokens from the shared one on must suffice for the overlap."""
        lengths = (100 * F.least(n, m) >= percent * F.greatest(n, m))
        enough = (100 + percent) * F.least(n - i, m - j) >= percent * (n + m)
        return lengths & enough

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs with enough tokens in common: of two fronts, the one that ends first in the order has all its common tokens
        in the other, so the overlap is at most theirs and what lies behind that front."""
        a, b = (fronts.select(F.col("key").alias(k), F.col("n").alias("n" + k), F.col("front").alias("f" + k)) for k in "xy")
        behind = F.greatest(_need(F.col("nx"), percent), _need(F.col("ny"), percent)) - 1
        most = F.size(F.array_intersect("fx", "fy")) + behind
        return (pairs.join(a, "x").join(b, "y").filter((100 + percent) * most >= percent * (F.col("nx") + F.col("ny"))).select("x", "y"))

    pair = [F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")]
    star = (shared.filter((F.col("key") != F.col("hub")) & passes(F.col("n"), F.col("i"), F.col("hub_n"), F.col("hub_i")))
            .select(F.col("key").alias("x"), F.col("hub").alias("y")).select(*pair).distinct())

    def whole_sets(keys: DataFrame) -> DataFrame:
        """key, tokens, first of some sets, read again from the line of their first occurrence; only such lines are shuffled."""
        wanted = store(keys.join(sets, "key").select("key", "first", F.col("first.doc_id").alias("m_id"),
                                                     F.col("first.thash").alias("m_thash"), F.col("first.line_no").alias("m_no")))
        texts = with_seen(base, F.col("thash"), wanted.select(F.col("m_thash").alias("h")), "seen", WIDE_BITS).filter("seen")
        there = texts.select("doc_id", "thash", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        there = with_seen(there, F.xxhash64("thash", "line_no"), wanted.select(F.xxhash64("m_thash", "m_no").alias("h")), "seen",
                          WIDE_BITS).filter("seen").drop("seen")
        found = (there.join(wanted, there["doc_id"].eqNullSafe(wanted["m_id"]) & (there["thash"] == wanted["m_thash"])
                            & (there["line_no"] == wanted["m_no"]))
                 .select("key", "first", "line").dropDuplicates(["key"]))
        words = found.select("key", "first", _words(F.col("line")).alias("words"))
        got = store(_ordered(_tokens(words, gram, "key", "first"), rarity, slots, "key", "first"))
        drop(wanted)
        return got

    def late(pairs: DataFrame, known: list[DataFrame]) -> DataFrame:
        """The later set of every pair that is similar.  ``known`` holds the whole sets read so far, and takes those read now."""
        pairs = store(likely(pairs))
        keys = pairs.select(F.col("x").alias("key")).unionByName(pairs.select(F.col("y").alias("key"))).distinct()
        known.append(whole_sets(reduce(lambda k, texts: k.join(texts, "key", "left_anti"), known, keys)))
        texts = reduce(DataFrame.unionByName, known)
        a = texts.select(F.col("key").alias("x"), F.col("tokens").alias("xt"), F.col("first").alias("xf"))
        b = texts.select(F.col("key").alias("y"), F.col("tokens").alias("yt"), F.col("first").alias("yf"))
        both = F.size(F.array_intersect("xt", "yt"))
        found = store(pairs.join(a, "x").join(b, "y")
                      .filter(100 * both >= percent * (F.size("xt") + F.size("yt") - both))
                      .select(F.when(F.col("xf") < F.col("yf"), F.col("y")).otherwise(F.col("x")).alias("key")).distinct())
        drop(pairs)
        return found

    texts: list[DataFrame] = []
    gone = late(star, texts)
    # All pairs with a list's hub are done, and so are lists of two.
    seen = (shared.filter(F.col("more") & (F.col("key") != F.col("hub"))).join(sets.select("key", "first"), "key")
            .select("t", "key", "n", "i", "first"))
    left = seen.join(gone, "key", "left_anti").select("t", *[F.col(c).alias("q_" + c) for c in ("key", "n", "i", "first")])
    rest = (left.join(seen, "t")
            .filter((F.col("first") < F.col("q_first")) & passes(F.col("q_n"), F.col("q_i"), F.col("n"), F.col("i")))
            .select(F.col("q_key").alias("x"), F.col("key").alias("y")).select(*pair).distinct())
    more = late(rest, texts)
    drop(fronts, *parts, *texts)

    # Every line of a set that goes, and every later line of a set that stays.
    out = gone.unionByName(more).distinct()
    verdict = store(sets.join(out.withColumn("late", F.lit(True)), "key", "left").filter("late or times > 1"))
    drop(sets, gone, more)
    decided = with_seen(places, F.col("key"), verdict.select(F.col("key").alias("h")), "seen", WIDE_BITS)
    removed = (decided.filter("seen").drop("seen").join(verdict, "key").withColumn("place", place)
               .filter(F.coalesce("late", F.lit(False)) | (F.col("place") != F.col("first")))
               .select("doc_id", "thash", "line_no").distinct())
    return removed, [places, verdict]


def removed_lines(docs: DataFrame, **options) -> DataFrame:
    """One row per document that loses lines: doc_id, thash, the sorted numbers of the lines that go."""
    marks, read = _line_marks(docs, **options)
    gone = store(marks.groupBy("doc_id", "thash").agg(F.sort_array(F.collect_list("line_no")).alias("gone")))
    drop(*read)
    return gone


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the removed lines, all columns kept; the text's other lines stand as they were.

    A document whose words are all removed goes; one that had none stays as it is.
    """
    t = free_prefix(docs.columns, "ld_")
    cut = removed_lines(docs, id_col=id_col, text_col=text_col, **options).select(
        F.col("doc_id").alias(t + "id"), F.col("thash").alias(t + "hash"), F.col("gone").alias(t + "gone"))
    # Documents that surely lose nothing are not shuffled.
    told = with_seen(docs, F.xxhash64(quoted(text_col)), cut.select(F.col(t + "hash").alias("h")), t + "loses")
    rows = told.filter(quoted(t + "loses")).join(
        cut, quoted(id_col).eqNullSafe(F.col(t + "id")) & (F.xxhash64(quoted(text_col)) == F.col(t + "hash")), "left")
    # The numbers are sorted, so each gap between two of them is a slice of the lines.
    gone = F.col(t + "gone")
    parts = F.split(quoted(text_col), "\n", -1)
    edges = F.arrays_zip(F.concat(F.array(F.lit(-1)), gone).alias("a"), F.concat(gone, F.array(F.size(parts))).alias("b"))
    kept = F.flatten(F.transform(edges, lambda e: F.slice(parts, e["a"] + 2, e["b"] - e["a"] - 1)))
    text = F.when(gone.isNull(), quoted(text_col)).otherwise(F.array_join(kept, "\n"))
    cleaned = (rows.withColumn(t + "new", text)
               .filter(gone.isNull() | F.col(t + "new").rlike(r"[^\x20\x09-\x0D]"))
               .select(*[F.col(t + "new").alias(c) if c.lower() == text_col.lower() else quoted(c) for c in docs.columns]))
    return told.filter(~quoted(t + "loses")).drop(t + "loses").unionByName(cleaned)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = removed_lines(docs)
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    own = docs.select("doc_id", F.xxhash64("text").alias("thash"),
                      F.when(F.col("text").isNull(), 0).otherwise(feeds + 1).cast("long").alias("n_lines"))
    return (own.join(cut, own["doc_id"].eqNullSafe(cut["doc_id"]) & (own["thash"] == cut["thash"]), "left")
            .select(own["doc_id"], "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("removed")))


OP6_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
w AS (SELECT doc_id, line_no, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS w FROM l),
s AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
         lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))) AS s
  FROM w WHERE len(w) > 0),
k AS (SELECT s, min((doc_id, line_no)) AS first, row_number() OVER () AS id, len(s) AS n FROM s GROUP BY s),
t AS (SELECT id, n, first, unnest(s) AS t FROM k),
p AS (
  SELECT a.id AS x, b.id AS y, a.first AS xf, b.first AS yf, count(*) AS o, any_value(a.n) AS n, any_value(b.n) AS m
  FROM t a JOIN t b ON a.t = b.t AND b.first < a.first GROUP BY ALL),
late AS (SELECT DISTINCT x FROM p WHERE 100 * o >= 80 * (n + m - o)),
g AS (
  SELECT s.doc_id, s.line_no FROM s JOIN k ON s.s = k.s
  WHERE k.id IN (SELECT x FROM late) OR (s.doc_id, s.line_no) <> k.first),
d AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS removed
      FROM g GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN d USING (doc_id)
"""
