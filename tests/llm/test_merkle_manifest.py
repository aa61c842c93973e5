"""Merkle manifest against a plain recursive tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from coverlens.llm.merkle_manifest import Appender, fold, levels_of, manifest, node_digest, siblings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, DIGEST string, tree int, leaf string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*(enc(v) for v in (r[0], r[3], r[2], r[4], text)))


def levels(hashes, fanout):
    out = [list(hashes)]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def brute(rows, fanout):
    """Multiset of (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[lang] = mine, levels([leaf_of(r, r[1]) for r in mine], fanout)
    top = levels([trees[x][1][-1][0] for x in langs], fanout)
    out = []
    for k, lang in enumerate(langs):
        mine, up = trees[lang]
        for pos, r in enumerate(mine):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if bad else r[1]
            given = cur = leaf_of(r, text)
            proof = ""
            for tree, at in ((up, pos), (top, k)):
                for row in tree[:-1]:
                    run = row[at // fanout * fanout:][:fanout]
                    proof += "".join(run[:at % fanout] + run[at % fanout + 1:])
                    cur = H(*run[:at % fanout], cur, *run[at % fanout + 1:])
                    at //= fanout
            out.append((r[0], leaf_of(r, r[1]), up[-1][0], top[-1][0], H(proof), cur, cur == top[-1][0]))
            assert (given == out[-1][1]) == (text == r[1])
    return sorted(out, key=repr)


def rows_of(n):
    rows = [(i * 3 % 101, None if i % 11 == 0 else f"Text {i} Ünï" * (i % 4), [None, "", "en", "é", "z"][i % 5] if i % 3 else "en",
             None if i % 7 == 0 else f"s{i % 3}", None if i % 13 == 0 else i, "x", 1, "y") for i in range(n)]
    return rows + [(None, "A", "en", None, 1, "x", 1, "y"), (None, None, None, None, None, None, None, None), rows[2], rows[2],
                   (5, "LONG " * 50_000, "en", "s", 9, "x", 1, "y")]


def run(df, **options):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    given = {"TEXT": F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))}
    return manifest(df, given=given, **options)


@pytest.mark.parametrize(("fanout", "block"), [(8, 4), (2, 2), (3, 1), (8, 1)])
def test_against_plain_tree(spark, fanout, block):
    rows = rows_of(150)
    got = run(spark.createDataFrame(rows, SCHEMA).repartition(3), fanout=fanout, levels=block).collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == brute(rows, fanout)
    assert {r.verified for r in got} == {True, False}
    for r in got:  # the witness itself is the proof
        assert fold(bytes.fromhex(r.leaf), r.witness).hex() == r.root


def test_small_and_empty(spark):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
    one = [(1, "Ab", "en", "s", 2, None, None, None)]
    got = run(spark.createDataFrame(one, SCHEMA)).collect()
    assert [tuple(r)[:7] for r in got] == brute(one, 8)
    assert got[0].leaf == got[0].subroot == got[0].root and got[0].proof_sha256 == H("")


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 200])
def test_witnesses_grow_with_later_siblings(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    a = Appender(levels_of(n))
    nodes = [a.append(x) for x in leaves]
    if n >= 64:
        first = list(siblings(nodes[0].witness()))
        assert len(first) >= 2 and len(first[0][1]) == 7 * 32  # closed levels are whole already
    root = a.finish()
    assert root.hex() == levels([x.hex() for x in leaves], 8)[-1][0]
    assert all(fold(x, s.witness()) == root for x, s in zip(leaves, nodes, strict=True))
    assert node_digest(leaves[:2]) != node_digest(leaves[1::-1]) or n < 2


def test_one_changed_row_changes_only_its_own_proof(spark):
    rows = rows_of(40)
    df = spark.createDataFrame(rows, SCHEMA)
    got = manifest(df, given={"source": F.when(F.col("doc_id") == 6, F.lit("other")).otherwise(F.col("source"))}).collect()
    assert {r.id for r in got if not r.verified} == {6}
