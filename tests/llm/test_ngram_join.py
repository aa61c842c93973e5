"""N-gram join and its helpers against brute force."""

import os
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from coverlens.llm.common import components
from coverlens.llm.ngram_join import first_of_class, linked_pairs, similar_classes
from coverlens.llm.words import ALNUM, BLANKS, distinct_sorted, gram_hashes, word_hashes


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()


def classes(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i in root}


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    shared = prose(30)
    rows = []
    for _ in range(12):
        base = prose(rng.choice([4, 5, 6, 9, 25, 80, 150]))
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], ["new" + str(rng.random())], [w[k], "ins"]])
            rows.append(" ".join(w))
    rows += [" ".join([*prose(25), *shared, *prose(25)]) for _ in range(70)]  # a passage many share
    rows += [None, "", " \t", "a", "A", "a b c d", "A  B\tc D", "x y", rows[0], rows[0].upper()]
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


def test_classes_against_brute_force(spark):
    rows = corpus(5)
    want = classes(rows)
    df = spark.createDataFrame([(*r, "z") for r in rows + [rows[0], (None, rows[1][1])]], "doc_id long, text string, COMPONENT_ID string")
    got = similar_classes(df.repartition(4), common=20, paired=5, block=8).collect()  # small blocks: groups are split
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert (r.n_shingles, r.component_id) == (len(shingles(rows[1][1])), None)
        else:
            text = dict(rows)[r.doc_id]
            assert (r.n_shingles, r.component_id) == (len(shingles(text)), want[r.doc_id])
    kept = first_of_class(df).select("doc_id").collect()
    assert {r.doc_id for r in kept if r.doc_id is not None} == {i for i, c in want.items() if i == c}


def test_empty(spark):
    assert similar_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_overlaps_by_fragment():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    got = linked_pairs(sets[:25], sets[25:], 50)
    for i, a in enumerate(sets[:25]):
        for j, b in enumerate(sets[25:]):
            o = len(np.intersect1d(a, b))
            assert got[i, j] == (100 * o >= 50 * (len(a) + len(b) - o))


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAé \t\n0-9zZ 😀.", max_size=60)), max_size=8))
@settings(max_examples=200, deadline=None)
def test_word_and_shingle_counts(texts):
    raw = [None if t is None else t.encode() for t in texts]
    h, b = word_hashes(raw, BLANKS)
    g, gb = distinct_sorted(*gram_hashes(h, b, 5))
    assert np.diff(gb).tolist() == [len(shingles(t)) for t in texts]
    _, b2 = word_hashes(raw, ALNUM)
    fold = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "") for t in texts]
    assert np.diff(b2).tolist() == [len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)) for t in fold]


def test_long_texts_go_in_pieces():
    text = " ".join(f"word{i % 977}" for i in range(200_000)) + " " + "q" * 9000
    h, b = word_hashes([text.encode(), text.encode()[:10], b"word5 " + b"q" * 9000])
    assert b.tolist() == [0, 200_001, 200_003, 200_005]
    assert h[5] == h[5 + 977] == h[200_003] and h[200_000] == h[200_004]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7), (1, 2), (2, 1)]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert components(df.limit(0)).collect() == []


def test_extra_columns_with_working_names(spark):
    same = "one two three four five six seven eight"
    df = spark.createDataFrame([(1, same, 7, "a"), (2, same, 8, "b"), (3, "other words stand here now", 9, "c")],
                               "doc_id long, text string, gone_id int, GONE_ID_ string")
    got = sorted(tuple(r) for r in first_of_class(df).collect())
    assert got == [(1, same, 7, "a"), (3, "other words stand here now", 9, "c")]


def test_steps_leave_no_tables(spark):
    """Of the tables between the steps only the documents' keys and the last links are left."""
    def folders():
        return {p for p in os.listdir(spark.conf.get("spark.checkpoint.dir")) if p.startswith("store-")}

    rng = random.Random(8)
    base = [" ".join(f"w{rng.randrange(300)}" for _ in range(40)) for _ in range(30)]
    rows = [(k, base[k % 30] + (" x" if k >= 30 else "")) for k in range(90)]
    before = folders()
    got = similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(folders() - before) == 2
    assert {r.doc_id: r.component_id for r in got.collect()} == {k: k % 30 for k in range(90)}
