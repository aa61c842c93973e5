"""Chat formatting: exact round trips, order, and the state machine."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from coverlens.llm.chat_format import Template, format_chat, read_back

T = Template()
NASTY = ["", "plain", "\\", "\\\\", "### ", "####", "\\### Assistant: </turn> ok", "</turn>\n", "<<", ": :", "é\U0001f600\u0301", "a\x00b", "\n"]


@given(st.text(alphabet="\\#<:/> turn\nassistAé😀", max_size=40), st.text(alphabet="\\#<: ab\n", max_size=8))
@settings(max_examples=300, deadline=None)
def test_a_turn_reads_back(text, role):
    assert T.read_turn("".join(x for x, _ in T.segments(role, text))) == (role, text)


def test_conversations_read_back(spark):
    rng = random.Random(4)
    rows = []
    for c in [None, *range(30)]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", None, "a: b"]), rng.choice([*NASTY, None])))
    rows += [(99, None, "user", "x" * 200_000), (99, 1, "assistant", "# " * 100_000), (98, 0, "user", "q"), (98, 0, "user", "q"),
             (98, 0, "assistant", "b"), (98, 0, "assistant", "a")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position int")
    got = {r.conv_id: r for r in read_back(format_chat(df)).collect()}
    assert {r.conv_id: r for r in read_back(format_chat(df), in_order=True).collect()} == got
    want = {}
    for c in {r[0] for r in rows}:
        mine = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c)
        pairs = [(r[2], r[3]) for r in mine]
        want[c] = pairs
    assert set(got) == set(want)
    for c, pairs in want.items():
        r = got[c]
        loss = "".join(x for role, x in pairs if role == "assistant")
        assert r.n_turns == len(pairs)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in pairs).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        state = "start"
        for role, _ in pairs:
            state = T.moves.get(state, {}).get(role)
        assert r.valid == (state in T.accept)
    assert got[99].valid is True


def test_order_flags(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "user", "v"), (1, 3, "assistant", "a")],
                               "conv_id long, turn long, role string, text string")
    rows = sorted(format_chat(df).collect(), key=lambda r: r.position)
    assert [r.order_ok for r in rows] == [True, True, False, False]
    assert [[s.loss for s in r.segments] for r in rows][3] == [False, True, False]


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(format_chat(df)).collect() == []
