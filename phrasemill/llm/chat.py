"""Chat formatting from a declarative template (operator 6).

A template says how each role's turn is marked and which turns carry loss. A finite-state
machine over roles checks the order of turns. Formatting emits text segments with a loss flag
each; control strings inside texts are broken by an escape character in a way that
``read_back`` undoes exactly.

Edge cases: turns are ordered by turn number (null first), then role, then text, so ties have a
fixed order; repeated rows are separate turns; null text is empty; a null role is the empty role;
roles that the template doesn't know are written in the generic form and make the conversation
invalid, as does any turn out of order (``valid`` false, ``bad_turn`` its place; it is formatted
all the same); rows with a null conv_id form one conversation; an empty table gives no rows;
other columns are ignored. A formatted conversation is one value, so it must fit in one row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``turns``: marks by role; at most one role may have an empty ``before``. ``follows``: the machine's arcs."""

    start: str = "<s>"
    turns: dict[str, Turn] = field(default_factory=lambda: {"system": Turn("<<SYS>>", "<</SYS>>"), "user": Turn("[INST] ", " [/INST]"), "assistant": Turn("", "</s>", loss=True)})
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[END]")
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("user", "assistant")
    escape: str = "\\"

    def controls(self) -> list[str]:
        marks = [self.start, *self.other]
        for t in self.turns.values():
            marks += [t.before.strip(), t.after.strip()]
        return sorted({m for m in marks if m}, key=lambda m: (-len(m), m))


class Formatter:
    def __init__(self, template: Template | None = None):
        self.t = template or Template()
        self.control = re.compile("|".join(map(re.escape, self.t.controls())))
        e = re.escape(self.t.escape)
        self.escaped = re.compile(f"{e}({e})?")

    def escape(self, text: str) -> str:
        e = self.t.escape
        return self.control.sub(lambda m: m[0][0] + e + m[0][1:], text.replace(e, e + e))

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[1] or "", text)

    def step(self, state: str, role: str) -> tuple[str, bool, Turn]:
        """The machine's arc for a turn of ``role``: next state, whether the template allows it, how the turn is written."""
        mark = self.t.turns.get(role)
        if mark is None:
            mark = Turn(self.t.other[0] + self.escape(role) + self.t.other[1], self.t.other[2])
        return role, role in self.t.follows.get(state, ()), mark

    def run(self, turns: list[tuple[str, str]]) -> tuple[list[tuple[str, bool]], int | None]:
        """(text, loss) segments whose concatenation is the formatted conversation, and the place of the first turn that
        the machine refuses (the number of turns, if it may not end there), else None."""
        out, state, bad = [(self.t.start, False)], "", None
        for i, (role, text) in enumerate(turns):
            state, allowed, mark = self.step(state, role)
            if not allowed and bad is None:
                bad = i
            if mark.before:
                out.append((mark.before, False))
            out += [(self.escape(text), mark.loss), (mark.after, False)]
        return out, len(turns) if bad is None and state not in self.t.final else bad

    def check(self, roles: list[str]) -> int | None:
        return self.run([(r, "") for r in roles])[1]

    def format(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]], int | None]:
        """The formatted text, its loss spans in code points, one for each loss segment (empty ones too), and the first bad turn."""
        segments, bad = self.run(turns)
        spans, at = [], 0
        for text, loss in segments:
            if loss:
                spans.append((at, at + len(text)))
            at += len(text)
        return "".join(text for text, _ in segments), spans, bad

    def read_back(self, formatted: str) -> list[tuple[str, str]]:
        """The (role, text) turns of a formatted conversation."""
        t, at, turns = self.t, len(self.t.start), []
        if not formatted.startswith(t.start):
            raise ValueError("no start mark")
        bare = next((r for r, m in t.turns.items() if not m.before), None)
        while at < len(formatted):
            role = next((r for r, m in t.turns.items() if m.before and formatted.startswith(m.before, at)), None)
            if role is not None:
                at += len(t.turns[role].before)
                after = t.turns[role].after
            elif formatted.startswith(t.other[0], at):
                at += len(t.other[0])
                end = self._control(formatted, at, t.other[1])
                role, at, after = self.unescape(formatted[at:end]), end + len(t.other[1]), t.other[2]
            elif bare is not None:
                role, after = bare, t.turns[bare].after
            else:
                raise ValueError(f"no turn at {at}")
            end = self._control(formatted, at, after.strip()) - (len(after) - len(after.lstrip()))
            turns.append((role, self.unescape(formatted[at:end])))
            at = end + len(after)
        return turns

    def _control(self, s: str, at: int, expected: str) -> int:
        m = self.control.search(s, at)
        if not m or m[0] != expected:
            raise ValueError(f"expected {expected!r} after {at}")
        return m.start()


FORMAT_SCHEMA = "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>, valid boolean, bad_turn int"


def format_chats(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """One row a conversation: formatted, loss_spans (code points), valid, bad_turn."""
    tune(conversations.sparkSession)
    turns = (
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Formatter(template)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, spans, bad = [], [], []
            for ts in batch.column(1).to_pylist():
                pairs = [(t["role"], t["text"]) for t in ts]
                text, loss, wrong = f.format(pairs)
                texts.append(text)
                spans.append([{"start": a, "end": b} for a, b in loss])
                bad.append(wrong)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(spans, kind), pa.array([b is None for b in bad]), pa.array(bad, pa.int32())], ["conv_id", "formatted", "loss_spans", "valid", "bad_turn"])

    return turns.mapInArrow(run, FORMAT_SCHEMA)


def digest(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Read formatted conversations back and digest their turns and what lies under the loss mask."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, bad_turn int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Formatter(template)
        for batch in batches:
            n, turn_sha, chars, loss_sha, size = [], [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = f.read_back(text)
                loss = "".join(f.unescape(text[s["start"] : s["end"]]) for s in spans)
                n.append(len(turns))
                turn_sha.append(hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest())
                chars.append(len(loss))
                loss_sha.append(hashlib.sha256(loss.encode()).hexdigest())
                size.append(len(text))
            big = lambda v: pa.array(v, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), big(n), pa.array(turn_sha), big(chars), pa.array(loss_sha), big(size), batch.column(3), batch.column(4)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "bad_turn"])

    return formatted.mapInArrow(run, schema)


#: The default template's digest in DuckDB SQL: escape by nested replace, then string_agg by turn.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'),
    '<</SYS>>', '<\</SYS>>'), '<<SYS>>', '<\<SYS>>'), '[/INST]', '[\/INST]'), '[/ROLE]', '[\/ROLE]'),
    '[INST]', '[\INST]'), '[ROLE]', '[\ROLE]'), '[END]', '[\END]'), '</s>', '<\/s>'), '<s>', '<\s>') AS x FROM c),
m AS (
  SELECT *, CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE 18 + length(role) END + length(x) AS n,
    row_number() OVER o - 1 AS i, lag(role, 1, '') OVER o AS state FROM e WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
f AS (SELECT *, coalesce(role = 'assistant' AND state = 'user' OR role = 'user' AND state IN ('', 'system', 'assistant') AND (i = 0 OR state <> '')
    OR role = 'system' AND i = 0, false) AS ok FROM m),
g AS (
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(n) AS BIGINT) AS formatted_chars,
  coalesce(min(i) FILTER (NOT ok), CASE WHEN arg_max(role, i) IN ('user', 'assistant') THEN NULL ELSE count(*) END) AS bad
FROM f GROUP BY conv_id)
SELECT * EXCLUDE (bad), bad IS NULL AS valid, CAST(bad AS INTEGER) AS bad_turn FROM g
"""
