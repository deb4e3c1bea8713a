"""Greedy leader clustering on a stream: each key joins the most similar leader that came before it, or leads.

What ``operators.cluster`` does by rank, done in the order of arrival, with the leaders kept as state between micro-batches. However
a stream is cut into micro-batches, keys get the leaders that one scan in order of arrival gives them.

State of a (tool, batch), all of it in the state store, none in memory between batches:

* ``known``: key -> number of its leader, so a key that came before is looked up and not compared;
* ``leaders``: number -> the leader's key and lead verb;
* ``posted``: token -> how many leaders have it in their prefix, and ``postings``: (token, block) -> up to ``POSTED`` numbers, so
  that a frequent token's list is never read or written whole for one change.

Only the first |k| - ceil(|k| num/den) + 1 tokens in alphabetical order are posted and looked up, as two keys that reach the threshold
share one of them. Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``). A (tool, batch) is settled by
one task, since each of its keys depends on those before; its micro-batch is sorted there, so ``maxFilesPerTrigger`` or its like bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import text as X
from ..functions.lexicon import DEFAULT, Lexicon
from ..operators.consolidate import LOW_THRESHOLD, STD_THRESHOLD
from ..plans.ship import ship
from .keywords import keyed_stream

POSTED = 64
OUT = "tool string, batch string, pos long, keyword string, key_str string, leader_key string"


class LeaderState(StatefulProcessor):
    def __init__(self, thresholds: dict[str, tuple[int, int]], never_merge: frozenset[frozenset[str]], posted: int = POSTED):
        self.thresholds, self.never, self.block = thresholds, never_merge, posted

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "key string", "leader long")
        self.leaders = handle.getMapState("leaders", "number long", "key string, lead string")
        self.posted = handle.getMapState("posted", "token string", "n long")
        self.postings = handle.getMapState("postings", "token string, block long", "numbers array<bigint>")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator, timerValues) -> Iterator:
        import pandas as pd

        tool, batch = key
        num, den = self.thresholds[batch]
        every = pd.concat(list(rows)).sort_values("pos", kind="stable")
        leader_of = {k: self._leader(k, lead, num, den) for k, lead in every.drop_duplicates("key_str")[["key_str", "lead"]].itertuples(index=False)}
        out = every[["pos", "keyword", "key_str"]].copy()
        out.insert(0, "tool", tool)
        out.insert(1, "batch", batch)
        out["leader_key"] = [leader_of[k] for k in every.key_str]
        yield out

    def _leader(self, key: str, lead: str | None, num: int, den: int) -> str:
        if self.known.containsKey((key,)):
            return self.leaders.getValue(self.known.getValue((key,)))[0]
        tokens = sorted(key.split(" "))
        prefix = tokens[: len(tokens) + (-len(tokens) * num // den) + 1]  # size - ceil(size * num / den) + 1
        best = None
        for number in sorted({n for t in prefix for n in self._numbers(t)}):
            other, verb = self.leaders.getValue((number,))
            mine, theirs = set(tokens), set(other.split(" "))
            inter, uni = len(mine & theirs), len(mine | theirs)
            if den * inter >= num * uni and not (lead and verb and frozenset((lead, verb)) in self.never):
                found = (inter / uni, -number, other)
                best = found if best is None or found > best else best
        if best is not None:
            self.known.updateValue((key,), (-best[1],))
            return best[2]
        number = self.count.get()[0] if self.count.exists() else 0
        self.count.update((number + 1,))
        self.leaders.updateValue((number,), (key, lead))
        self.known.updateValue((key,), (number,))
        for t in prefix:
            n = self.posted.getValue((t,))[0] if self.posted.containsKey((t,)) else 0
            block = (t, n // self.block)
            held = list(self.postings.getValue(block)[0]) if n % self.block else []
            self.postings.updateValue(block, ([*held, number],))
            self.posted.updateValue((t,), (n + 1,))
        return key

    def _numbers(self, token: str) -> Iterator[int]:
        if self.posted.containsKey((token,)):
            for block in range(-(-self.posted.getValue((token,))[0] // self.block)):
                yield from self.postings.getValue((token, block))[0]

    def close(self) -> None:
        pass


def leader_stream(keywords: DataFrame, std: tuple[int, int] = STD_THRESHOLD, low: tuple[int, int] = LOW_THRESHOLD, lex: Lexicon = DEFAULT, posted: int = POSTED) -> DataFrame:
    """tool, batch, pos, keyword, key_str, leader_key of every keyword (tool, batch, pos, keyword) that has a key; append mode."""
    ship(keywords.sparkSession)
    words = F.split("key_str", " ")
    rows = keyed_stream(keywords, lex).select("tool", "batch", "pos", "keyword", "key_str", X.lead_verb(words, lex).alias("lead"))
    state = LeaderState({"standard": std, "low_volume": low}, frozenset(map(frozenset, lex.never_merge)), posted)
    return rows.groupBy("tool", "batch").transformWithStateInPandas(state, OUT, "Append", "None")
