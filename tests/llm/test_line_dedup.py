"""Line dedup against a brute-force comparison of all lines."""

import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from coverlens.llm import line_dedup
from coverlens.llm.common import save, store
from coverlens.llm.line_dedup import dedup_lines, removed_lines


def tokens(line):
    w = re.findall(r"[^\x20\x09-\x0D]+", line.lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    order = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    lines = [(d, k, tokens(x)) for d in order for k, x in enumerate(d[2].split("\n"))]
    gone = {}
    for a, (d, k, s) in enumerate(lines):
        if s and any(t and 100 * len(s & t) >= 80 * len(s | t) for *_, t in lines[:a]):
            gone.setdefault((None if d[0] else d[1], d[2]), []).append(k)
    return gone


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    pool = []
    for _ in range(25):
        w = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 6, 20, 45, 60]))]
        pool.append(" ".join(w))
        for _ in range(4):
            v = list(w)
            v[rng.randrange(len(v))] = f"x{rng.random()}"
            pool.append(" ".join(v))
    rows = []
    for i in range(60):
        text = "\n".join(rng.choice([rng.choice(pool), " ".join(rng.choice(vocab) for _ in range(30)), "", "common line of this corpus"])
                         for _ in range(rng.randint(0, 9)))
        rows.append((i, text))
    rows += [(60, None), (61, ""), (62, "\n\n"), (63, rows[3][1]), (64, rows[3][1].upper()), (65, "A b\r\na B")]
    return rows


def test_against_brute_force(spark):
    rows = corpus(3)
    want = brute(rows)
    df = spark.createDataFrame([(*r, i, "v") for i, r in enumerate(rows + [rows[3]])], "doc_id long, text string, key int, `ld_id` string")
    texts = dict(rows)
    got = {(r.doc_id, texts[r.doc_id]): r.gone for r in removed_lines(df.repartition(3)).collect()}
    assert got == want
    out = dedup_lines(df)
    assert out.columns == df.columns
    left = {r.doc_id: r.text for r in out.collect()}
    for i, t in rows:
        keep = None if t is None else [x for k, x in enumerate(t.split("\n")) if k not in want.get((i, t), [])]
        if (i, t) in want and not "".join(keep).strip():
            assert i not in left
        else:
            assert left[i] == (None if t is None else "\n".join(keep))


def test_null_ids_and_empty(spark):
    line = "one two three four five six seven"
    df = spark.createDataFrame([(None, line), (5, line + "\n" + line)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.gone) for r in removed_lines(df).collect()) == [("5", [1]), ("None", [0])]
    assert removed_lines(df.limit(0)).collect() == []


def test_texts_are_taken_apart_once(spark, tmp, monkeypatch):
    """One table is built from all texts; the others that read them take the lines of candidate pairs only."""
    spark.createDataFrame(corpus(5), "doc_id long, text string").write.parquet(f"{tmp}/d")
    read, keep = [], line_dedup.store
    monkeypatch.setattr(line_dedup, "store", lambda df: (read.append((df.columns, df.inputFiles())), keep(df))[1])
    removed_lines(spark.read.parquet(f"{tmp}/d"))
    of_texts = [columns for columns, files in read if any(f"{tmp}/d/" in f for f in files)]
    assert of_texts == [["doc_id", "thash", "line_no", "key", "n", "front"], ["key", "first", "tokens"], ["key", "first", "tokens"]]


@pytest.mark.parametrize("gram", [1, 2, 3, 5, 6, 8])
def test_counted_runs_are_the_tokens(spark, gram):
    words = [f"w{k}" for k in range(9)]
    df = spark.createDataFrame([(k, words[:k]) for k in range(10)], "k int, words array<string>")
    got = {r.k: r.tokens for r in line_dedup._tokens(df, gram, "k").collect()}
    one = line_dedup._run_hash(gram, lambda k: F.get("words", F.col("i") + k))
    runs = df.select("k", "words", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")).filter(F.col("i") + gram <= F.col("k"))
    want = {k: [] for k in range(10)}
    for r in runs.select("k", "i", one.alias("t")).orderBy("i").collect():
        want[r.k].append(r.t)
    assert all(got[k] == want[k] and len(want[k]) == k - gram + 1 for k in range(gram, 10))
    assert got[0] == [] and all(len(got[k]) == 1 for k in range(1, gram))


def test_blanks(spark):
    lines = ["", " ", "a  B\tc", "\ta\r", "\x0b\x0c", "É x\u00a0y ", None]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r.w for r in df.select(line_dedup._words(F.col("line")).alias("w")).collect()]
    assert got == [None if x is None else re.findall(r"[^\x20\x09-\x0D]+", x.lower()) for x in lines]


def test_tables_of_lines_are_no_part_of_a_plan(spark, monkeypatch):
    """The driver keeps descriptions of each plan, so only the table of token counts may stand in one as a constant."""
    plans, keep = [], line_dedup.store
    monkeypatch.setattr(line_dedup, "store", lambda df: (plans.append(df), keep(df))[1])
    df = spark.createDataFrame(corpus(7), "doc_id long, text string")
    slots = 1 << 8
    plans += [removed_lines(df, slots=slots), dedup_lines(df, slots=slots)]
    sizes = [len(p._jdf.queryExecution().optimizedPlan().toString()) for p in plans]
    assert len(sizes) > 10 and max(sizes) < 100_000


def test_line_counts(spark, tmp):
    rows = [(0, None), (1, ""), (2, "\n"), (3, "a"), (4, "\u00e9\n\r\n\n"), (5, "a\nb\nc")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    got = {r.doc_id: r.n_lines for r in line_dedup.op6_line_dedup(spark, tmp).collect()}
    assert got == {i: 0 if t is None else len(t.split("\n")) for i, t in rows}


def test_words_and_tokens_are_no_rows_of_their_own(spark, monkeypatch):
    """From a line to its ordered tokens only the lines and the sorted sets are rows; words and run hashes stay inside one expression."""
    plans, keep = [], line_dedup.store
    monkeypatch.setattr(line_dedup, "store", lambda df: (plans.append(df), keep(df))[1])
    removed_lines(spark.createDataFrame(corpus(9), "doc_id long, text string"), slots=1 << 8)
    marks = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert marks.count("Generate ") == 2 and marks.count("sort_array(") == 1


def test_gaps_between_words(spark):
    rng = random.Random(4)
    lines = ["".join(rng.choice(["a", "B", " ", " ", "\t", "É"][:k]) for _ in range(rng.randint(0, 9))) for k in (2, 3, 4, 6) for _ in range(60)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [(r.line, r.w) for r in df.select("line", line_dedup._words(F.col("line")).alias("w")).collect()]
    assert got == [(x, re.findall(r"[^\x20\x09-\x0D]+", x.lower())) for x in lines]


def folders(spark):
    return {p for p in os.listdir(spark.conf.get("spark.checkpoint.dir")) if p.startswith("store-")}


def test_steps_leave_no_tables(spark):
    """Of all tables between the steps only the result's is left."""
    before = folders(spark)
    gone = removed_lines(spark.createDataFrame(corpus(11), "doc_id long, text string"), slots=1 << 8)
    assert len(folders(spark) - before) == 1
    assert gone.count() > 0


def test_shuffle_files_go_with_their_step(spark):
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
        return {b for b in blocks if b.startswith("shuffle_")}

    before = shuffled()
    for keep in (store, save):
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        out = keep(df)
        for _ in range(50):
            if not shuffled() - before:
                break
            time.sleep(0.1)
        assert not shuffled() - before
        assert sorted(r.k for r in out.collect()) == list(range(7))
        before |= shuffled()


@pytest.mark.parametrize("rounds", [1, 3])
def test_lists_in_rounds_and_pairs_by_their_fronts(spark, monkeypatch, rounds):
    """Chains of lines that share tokens in long lists, each alike to some of the others only; few pairs come to the whole sets."""
    rng = random.Random(rounds)
    rows = []
    for _ in range(6):
        w = [f"a{rng.randrange(10**6)}" for _ in range(50)]
        for _ in range(14):
            w = list(w)
            for k in rng.sample(range(50), rng.choice([0, 1, 1, 2])):
                w[k] = f"b{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    want = brute(rows)
    pairs, keep = [], line_dedup.store

    def seen(df):
        out = keep(df)
        if df.columns == ["x", "y"]:
            pairs.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "store", seen)
    marks, _ = line_dedup._line_marks(spark.createDataFrame(rows, "doc_id long, text string"), rounds=rounds)
    got = {}
    for r in marks.collect():
        got.setdefault((r.doc_id, rows[r.doc_id][1]), []).append(r.line_no)
    assert got == want and 0 < len(want) < len(rows)
    shared = sum(bool(tokens(a) & tokens(b)) for i, (_, a) in enumerate(rows) for _, b in rows[:i])
    assert len(pairs) == 2 and sum(pairs) < shared / 2
