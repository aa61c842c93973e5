"""Chat formatting: a finite-state machine over roles and a declarative template.

A conversation is read in turn order.  The template names the marks around a turn, the
role changes that are allowed, and the roles whose text is trained on.  Each turn becomes
segments (text, loss); control strings inside texts are escaped, so the formatted text can
be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.common import quoted


@dataclass(frozen=True)
class Template:
    """Marks, escapes and turn order.  ``moves`` maps a state to {role: next state}."""

    head: str = "### "
    after_role: str = ": "
    close: str = "</turn>\n"
    escape: str = "\\"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    moves: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: {
        "start": {"system": "ready", "user": "asked"},
        "ready": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    accept: frozenset[str] = frozenset({"answered"})

    def special(self) -> str:
        """Characters that are escaped in texts and roles: the first of each mark, and the escape itself."""
        return "".join(dict.fromkeys(self.escape + self.head[0] + self.after_role[0] + self.close[0]))

    def escaped(self, text: str) -> str:
        return re.sub(f"([{re.escape(self.special())}])", lambda m: self.escape + m[1], text)

    def unescaped(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.S)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn as (formatted text, loss flag) pieces: head, text, close."""
        return [(self.head + self.escaped(role) + self.after_role, False),
                (self.escaped(text), role in self.loss_roles), (self.close, False)]

    def read_turn(self, formatted: str) -> tuple[str, str]:
        """(role, text) of one formatted turn; raises ValueError on anything else."""
        plain, esc = f"[^{re.escape(self.special())}]", f"{re.escape(self.escape)}."
        m = re.fullmatch(f"{re.escape(self.head)}((?:{plain}|{esc})*){re.escape(self.after_role)}"
                         f"((?:{plain}+|{esc})*){re.escape(self.close)}", formatted, re.S)
        if not m:
            raise ValueError("not a formatted turn")
        return self.unescaped(m[1]), self.unescaped(m[2])


SEGMENTS = "array<struct<text:string,loss:boolean>>"


def _ordered(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of a key side by side and in order; a partition holds many keys and is read as a stream."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def format_chat(df: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, position (0, 1, ...), state, order_ok, segments.

    ``state`` is the machine's state after the turn; after a move that the template does not
    name it is null, ``order_ok`` is false from there on, and the turns are formatted all the
    same.  Rows go by turn (null first), then role, then text, so ties and repeated rows have
    one order; repeated rows count as turns.  A null text or role is empty; a null conv_id is
    a conversation of its own.  Other columns are left out, empty input gives no rows.

    A conversation passes through one task as a stream, turn by turn, in the order the
    machine needs; only the current batch is in memory, whatever its length.
    """
    rows = df.select(quoted(conv_col).alias("conv_id"), quoted(turn_col).alias("turn"),
                     F.coalesce(quoted(role_col), F.lit("")).alias("role"),
                     F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        conv, state, position, fresh = None, template.start, 0, True
        for batch in batches:
            out: dict[str, list] = {"position": [], "state": [], "order_ok": [], "segments": []}
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
                if fresh or c != conv:
                    conv, state, position, fresh = c, template.start, 0, False
                state = template.moves.get(state, {}).get(role) if state is not None else None
                out["position"].append(position)
                out["state"].append(state)
                out["order_ok"].append(state is not None)
                out["segments"].append([{"text": t, "loss": x} for t, x in template.segments(role, text)])
                position += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(out["position"], pa.int64()), pa.array(out["state"], pa.string()),
                 pa.array(out["order_ok"], pa.bool_()),
                 pa.array(out["segments"], pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))],
                names=["conv_id", "position", "state", "order_ok", "segments"])

    return _ordered(rows, "conv_id", ["turn", "role", "text"]).mapInArrow(
        run, f"conv_id {kind}, position long, state string, order_ok boolean, segments {SEGMENTS}")


def read_back(turns: DataFrame, template: Template = Template(), in_order: bool = False) -> DataFrame:
    """One row per conversation, from formatted turns alone: turn count, digests, loss text, sizes, validity.

    Roles and texts are parsed out of the formatted text; digests are fed piece by piece, so a
    conversation of any length needs the memory of one turn.  ``in_order`` says that the rows come
    as ``format_chat`` leaves them, each conversation in one partition and in order; they are not
    dealt out a second time then.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        conv, acc = None, None

        def done() -> tuple:
            return conv, acc[0], acc[1].hexdigest(), acc[2], acc[3].hexdigest(), acc[4], acc[5] in template.accept

        types = None
        for batch in batches:
            types = types or [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(),
                              pa.int64(), pa.bool_()]
            rows = []
            for c, state, segments in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "state", "segments")),
                                          strict=True):
                if acc is None or c != conv:
                    if acc is not None:
                        rows.append(done())
                    conv, acc = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, None]
                formatted = "".join(s["text"] for s in segments)
                role, text = template.read_turn(formatted)
                acc[0] += 1
                acc[1].update(f"{role}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        plain = template.unescaped(s["text"])
                        acc[2] += len(plain)
                        acc[3].update(plain.encode())
                acc[4] += len(formatted)
                acc[5] = state
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(done(), types, strict=True)], names)

    return (turns if in_order else _ordered(turns, "conv_id", ["position"])).mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, valid boolean")


#: The contract's conversation -7: texts full of control strings.
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    rows = (spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(planted))
    return read_back(format_chat(rows), in_order=True)


OP2_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         length(regexp_replace(role, '[\\#:<]', '\\\0', 'g')) + length(regexp_replace(text, '[\\#:<]', '\\\0', 'g'))
           + length('### ' || ': ' || '</turn>' || chr(10)) AS formatted
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars,
       bool_and(CASE WHEN prev IS NULL THEN role IN ('system', 'user')
                     WHEN role = 'user' THEN prev IN ('system', 'assistant')
                     WHEN role = 'assistant' THEN prev = 'user' ELSE false END)
         AND arg_max(role, k) = 'assistant' AS valid
FROM o GROUP BY conv_id
"""
