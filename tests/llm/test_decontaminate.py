"""Decontamination: the Wu-Manber search against plain window sets."""

import random
import re

import numpy as np
import pytest

from coverlens.llm.decontaminate import build_sets, decontaminate, find_items, search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, width=10):
    w = words(text)
    hit, ids = set(), set()
    for item, t in items:
        v = words(t)
        m = min(width, len(v))
        if not m:
            continue
        wins = {tuple(v[i:i + m]) for i in range(len(v) - m + 1)}
        for i in range(len(w) - m + 1):
            if tuple(w[i:i + m]) in wins:
                hit.update(range(i, i + m))
                if item is not None:
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def fixture(seed):
    rng = random.Random(seed)
    def prose(n):
        return " ".join(rng.choice(["the", "of", "Was", "é", "thon", "re", "0x", "in"]) for _ in range(n))
    items = [(i, prose(rng.randint(1, 40))) for i in range(12)] + [(3, prose(15)), (None, prose(12)), (90, None), (91, ""), (92, "!?"),
                                                                   (93, "unique pair"), (10, "Zwei, drei; VIER!")]
    docs = [prose(rng.randint(0, 60)) for _ in range(20)]
    for k, t in items:
        if t:
            docs += [prose(5) + ". " + t.replace(" ", "\n-") + " " + prose(3), t, t.upper()]
    docs += [None, "", "   ", "x " * 700 + (items[0][1] or "") + " y" * 900, docs[0], docs[0]]
    return [(i, t, "k", 5) for i, t in enumerate(docs)] + [(None, docs[1], "k", 5)], items


@pytest.mark.parametrize("seed,set_words", [(1, 400_000), (2, 25)])
def test_against_brute_force(spark, seed, set_words):
    rows, items = fixture(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, ITEMS string, lane int").repartition(3)
    bench = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, doc_id int")
    got = find_items(docs, bench, set_words=set_words)
    assert got.columns == ["doc_id", "text", "lane", "n_words", "n_hit", "items", "spans"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_hit, r.items) == brute(r.text, items)
        covered = set()
        for a, b in zip(r.spans[::2], r.spans[1::2], strict=True):
            covered.update(range(a, b + 1))
        assert len(covered) == r.n_hit
    clean = decontaminate(docs, bench, set_words=set_words)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in got if not r.n_hit)


def test_search_finds_every_place():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 4, 5000).astype(np.uint64)
    pattern = rng.integers(1, 4, 30).astype(np.uint64)
    for width in (1, 2, 3, 7, 10):
        sets = build_sets([("a", pattern)], width)
        end, window = search(text, sets[0])
        want = {(i + width - 1, tuple(text[i:i + width])) for i in range(len(text) - width + 1)
                if any((text[i:i + width] == pattern[j:j + width]).all() for j in range(len(pattern) - width + 1))}
        assert {(int(e), tuple(sets[0].words[w])) for e, w in zip(end, window, strict=True)} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.items) for r in find_items(docs, none).collect()] == [(3, 0, [])]
    assert find_items(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
