"""Token counts by a compiled finite-state transducer (operator 8).

A byte-level byte-pair tokenizer is compiled into a deterministic transducer over characters. Each
arc is annotated with the number of tokens that are certain once its character is read; a final
count per state covers what is still open at the end of a text.

States. A state says which kind of pre-token is running and which end of the text is *open*, that
is, may still be cut into tokens in more than one way:

* ``""``: between pre-tokens, nothing open;
* ``"?"``: one white-space character, or an apostrophe that may begin a contraction;
* ``L``, ``N``, ``O``, ``W``: a run of letters, numbers, others or white space, whose open end follows.

Which end is open. Let b be the bytes of a run so far. A prefix of a merge encoding that ends at a
token's edge is the encoding of that prefix, so whatever follows, the tokens of b begin with the
tokens of b[:p] for some p at which a token starts that reaches beyond b; b[p:] then is a proper
prefix of some token. An edge that the encodings of b[:p] have in common for all such p is fixed: its
tokens are emitted, and only what follows it stays in the state. So states don't grow with words: a
state is a few tokens long, and words share them.

There are too many states to build all ahead (README has counts), so arcs are compiled when first
walked and kept; the library's merge model cuts the open end when an arc is compiled, never a text.

Chunks. A text is cut into chunks of about ``chunk_chars`` where a pre-token ends whatever came before it: before white space that
follows another character, or (in stretches without white space) between letters, numbers and others. From such a place on
every entry state does the same: it closes what it has open, and the chunk is read from the state between pre-tokens. So the
map of a chunk over all entry states is two numbers, the tokens that it emits by itself and the tokens of what it leaves open,

    (n, open) of entry state s = (final(s) + n, open);   (n, open) then (m, rest) = (n + open + m, rest),

no text stays in a map, and maps compose associatively. The chunks of a batch's texts are mapped one by one and combined by a
segmented prefix scan in log2 steps over arrays, which gives the tokens before each chunk too. A stretch of one kind of character
(a megabyte of letters, say) can't be cut, so it is one chunk, walked in one task. Texts of more than
``long_chars`` are cut first and their pieces dealt to tasks; the pieces' maps meet in an aggregate.

Edge cases: null text counts as empty (0 bytes, 0 tokens); the string of an added token in a text is
one token and separates what stands around it, as the library has it; repeated rows give repeated
rows; texts of any length are read whole, very long ones by several tasks; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import tokenizer_path, tune
from .tokens import START, WHITE, byte_chars

#: Characters of a chunk (about), and of a text beyond which several tasks count it.
CHUNK_CHARS, LONG_CHARS = 256, 1 << 22
#: States kept by a worker (about 500 bytes each with their arcs); compiled anew beyond.
MAX_STATES = 200_000
BLANK = re.compile(f"[{WHITE}]")
#: Fixed values of the pre-tokenizer: contractions after an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

CHUNKS = "array<struct<start:bigint,tokens:bigint>>"
PIECES = pa.schema([*((c, pa.int64()) for c in ("row", "doc_id", "n_bytes", "place", "start", "added")), ("piece", pa.string())])

Arc = tuple["State", int]


class State(dict):
    """Arcs by character: (next state, tokens emitted). ``last[i]``: length of the last token of the first i + 1 open bytes."""

    __slots__ = ("machine", "kind", "open", "last")

    def __init__(self, machine: Transducer, kind: str, open_: str, last: tuple[int, ...]):
        super().__init__()
        self.machine, self.kind, self.open, self.last = machine, kind, open_, last

    def __missing__(self, c: str) -> Arc:
        arc = self[c] = self.machine.arc(self, c)
        return arc

    def final(self) -> int:
        """Tokens of the open end, if the text ends here."""
        if self.kind == "?" and len(self.open) == 2:  # an apostrophe, then a letter
            return 2
        return self.machine.steps(self.last, len(self.last))


@dataclass(frozen=True, slots=True)
class ChunkMap:
    """What a chunk does after any entry state's own final count: tokens emitted, and tokens of what it leaves open."""

    count: int
    open: int


class Transducer:
    def __init__(self, path: str, max_states: int = MAX_STATES):
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"] or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if spec["normalizer"] or any(kind.get(k) != v for k, v in plain.items()) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("only plain byte-level vocabularies are compiled")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.model = Tokenizer(models.BPE(spec["model"]["vocab"], merges, cache_capacity=0))
        self.cut = Tokenizer.from_file(path).pre_tokenizer
        self.added = re.compile("|".join(re.escape(t["content"]) for t in sorted(spec["added_tokens"], key=lambda t: -len(t["content"]))) or "(?!)")
        self.to_chars = byte_chars()
        back = {c: b for b, c in self.to_chars.items()}
        added = {t["content"] for t in spec["added_tokens"]}
        self.size = {i: len(t) for t, i in spec["model"]["vocab"].items()}
        self.tokens = sorted(bytes(back[c] for c in t) for t in spec["model"]["vocab"] if t not in added)
        self.longest = max(map(len, self.tokens))
        self.max_states = max_states
        self.classes: dict[str, str] = {}
        self.states: dict[tuple[str, str], State] = {}
        self.built = 0

    # Compiling

    def class_of(self, c: str) -> str:
        """L, N, O or W, as the library's pre-tokenizer has it."""
        k = self.classes.get(c)
        if k is None:
            if BLANK.match(c):
                k = "W"
            else:
                k = next((k for k, like in (("L", "a"), ("N", "1")) if len(self.cut.pre_tokenize_str(like + c)) == 1), "O")
            self.classes[c] = k
        return k

    def last_token(self, raw: bytes) -> int:
        return self.size[self.model.encode(raw.decode("latin-1").translate(self.to_chars), add_special_tokens=False).ids[-1]]

    def extended(self, last: tuple[int, ...], raw: bytes) -> tuple[int, ...]:
        """``last`` for ``raw``, of whose first bytes it is known."""
        return (*last, *(self.last_token(raw[:i]) for i in range(len(last) + 1, len(raw) + 1)))

    @staticmethod
    def steps(last: tuple[int, ...], p: int) -> int:
        """Tokens of the first ``p`` open bytes."""
        n = 0
        while p:
            p -= last[p - 1]
            n += 1
        return n

    def begins_token(self, raw: bytes) -> bool:
        """Whether ``raw`` is a proper prefix of a token."""
        i = bisect_right(self.tokens, raw)
        return i < len(self.tokens) and self.tokens[i].startswith(raw)

    def state(self, kind: str, open_: str, last: tuple[int, ...] = ()) -> State:
        s = self.states.get((kind, open_))
        if s is None:
            if len(self.states) >= self.max_states:
                self.states.clear()  # walks under way keep the states that they stand on
            s = self.states[kind, open_] = State(self, kind, open_, self.extended(last, open_.encode("utf-8", "surrogatepass")))
            self.built += 1
        return s

    def running(self, kind: str, text: str, last: tuple[int, ...]) -> Arc:
        """The state of a run whose open end and next character are ``text``, and the tokens that are certain now."""
        raw = text.encode("utf-8", "surrogatepass")
        last = self.extended(last, raw)
        n = len(raw)
        # The last white-space character of a run may belong to what follows.
        stop = n - len(text[-1].encode("utf-8", "surrogatepass")) if kind == "W" else n
        starts = {n, stop, *(p for p in range(max(0, n - self.longest), n) if self.begins_token(raw[p:]))}
        common: set[int] | None = None
        for p in starts:
            edges = set()
            while p > 0:
                edges.add(p)
                p -= last[p - 1]
            common = edges if common is None else common & edges
        fixed = max((e for e in common if e <= stop and (e == n or raw[e] & 0xC0 != 0x80)), default=0)
        if not fixed:
            return self.state(kind, text, last), 0
        return self.state(kind, raw[fixed:].decode("utf-8", "surrogatepass")), self.steps(last, fixed)

    def arc(self, s: State, c: str) -> Arc:
        kind, open_ = s.kind, s.open
        k = self.class_of(c)
        if kind == "":
            if k == "W" or c == "'":
                return self.state("?", c), 0
            return self.running(k, c, ())
        if kind == "?":
            if open_ == "'":
                if c in CONTRACTIONS:
                    return self._closed(open_ + c, "")
                if any(x[0] == c for x in CONTRACTIONS):
                    return self.state("?", open_ + c), 0
                return self.running(k, open_ + c, s.last) if k == "O" else self._closed(open_, c)
            if open_[0] == "'":
                if open_[1] + c in CONTRACTIONS:
                    return self._closed(open_ + c, "")
                return self._closed("'", open_[1] + c)
            if k == "W" or open_ == " ":
                return self.running(k, open_ + c, s.last)
            return self._closed(open_, c)
        if k == kind:
            return self.running(k, open_ + c, s.last)
        if kind == "W":
            nxt, n = self.state("?", open_[-1])[c]
            return nxt, n + self.steps(s.last, len(open_[:-1].encode("utf-8", "surrogatepass")))
        nxt, n = self.state("", "")[c]
        return nxt, n + self.steps(s.last, len(s.last))

    def _closed(self, piece: str, rest: str) -> Arc:
        """A pre-token ends; ``rest`` is read from the state between pre-tokens."""
        raw = piece.encode("utf-8", "surrogatepass")
        total, s = self.walk(self.state("", ""), rest)
        return s, total + self.steps(self.extended((), raw), len(raw))

    # Running

    @staticmethod
    def walk(s: State, text: str) -> tuple[int, State]:
        """(tokens emitted, exit state)."""
        total = 0
        for c in text:
            s, n = s[c]
            total += n
        return total, s

    def cuts(self, text: str, chunk_chars: int) -> list[int]:
        """Where chunks begin: 0 and, every ``chunk_chars`` or more, a place where a pre-token ends whatever came before."""
        out, n = [0], len(text)
        at = chunk_chars
        while at < n:
            found = START.search(text, at, min(n, at + chunk_chars))
            place = found.start() if found else next((i for i in range(at, n) if self.parted(text[i - 1], text[i])), n)
            if place >= n:
                break
            out.append(place)
            at = place + chunk_chars
        return out

    def parted(self, a: str, b: str) -> bool:
        """Whether a pre-token ends between two characters whatever came before. White space and apostrophes may go with what follows."""
        k, following = self.class_of(a), self.class_of(b)
        return k != "W" and (following == "W" or (k != following and a != "'"))

    def chunk_map(self, chunk: str) -> ChunkMap:
        n, s = self.walk(self.state("", ""), chunk)
        return ChunkMap(n, s.final())

    @staticmethod
    def compose(a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """First ``a``, then ``b``."""
        return ChunkMap(a.count + a.open + b.count, b.open)

    def chunks(self, text: str, chunk_chars: int) -> list[tuple[int, str, int]]:
        """(start, chunk, tokens before it) of a text; the string of an added token stands between chunks as one token."""
        out, added, at = [], 0, 0
        for found in [*self.added.finditer(text), None]:
            part = text[at : found.start() if found else len(text)]
            starts = self.cuts(part, chunk_chars)
            for a, b in zip(starts, [*starts[1:], len(part)]):
                out.append((at + a, part[a:b], added))
                added = 0
            if found:
                at, added = found.end(), 1
        return out

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        return int(self.counts([text], chunk_chars)[0][0])

    def counts(self, texts: list[str], chunk_chars: int = CHUNK_CHARS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(tokens of each text, (starts of its chunks, tokens before each))."""
        starts, emitted, left, size = [], [], [], []
        for text in texts:
            mine = self.chunks(text, chunk_chars)
            size.append(len(mine))
            for start, chunk, before in mine:
                m = self.chunk_map(chunk)
                starts.append(start)
                emitted.append(m.count + before)
                left.append(m.open)
        size = np.array(size, np.int64)
        ends = np.cumsum(size)
        place = np.arange(len(starts)) - np.repeat(ends - size, size)
        emitted, left = np.array(emitted, np.int64), np.array(left, np.int64)
        through = prefix_scan(emitted, left, place)
        cuts = [0, *ends.tolist()]
        starts, before = np.array(starts, np.int64), through - emitted
        return through[ends - 1] + left[ends - 1], [(starts[a:b], before[a:b]) for a, b in zip(cuts, cuts[1:])]


def prefix_scan(count: np.ndarray, left: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The count of the composition of each chunk's map with those of all chunks before it in its text; ``place``: its number there.

    In step k every place takes the composition of the 2^k maps before its own, so log2 steps do.
    """
    out, step = count.copy(), 1
    while len(own := np.flatnonzero(place >= step)):
        out[own] = out[own - step] + left[own - step] + out[own]
        step *= 2
    return out


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One machine a worker process, kept between tasks."""
    if path not in _TRANSDUCERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TRANSDUCERS[path] = Transducer(path)
    return _TRANSDUCERS[path]


def _whole(docs: DataFrame, path: str, limit: int, chunk_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("start", pa.int64()), ("tokens", pa.int64())]))
        for batch in batches:
            n, chunks = transducer(path).counts([t or "" for t in batch.column(1).to_pylist()], chunk_chars)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *(c[i] for c in chunks)])) for i in (0, 1)], names=["start", "tokens"])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(c[0]) for c in chunks)]), pa.int32()), flat).cast(shape)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_bytes": batch.column(2), "n_tokens": pa.array(n), "over_limit": pa.array(n > limit), "chunks": lists})

    return docs.select("doc_id", "text", "n_bytes").mapInArrow(run, f"doc_id long, n_bytes long, n_tokens long, over_limit boolean, chunks {CHUNKS}")


def _dealt(docs: DataFrame, path: str, limit: int, chunk_chars: int, piece_chars: int) -> DataFrame:
    """The same for texts that are cut into pieces for several tasks; a piece's chunks are counted from the tokens of the pieces before."""
    spec = "row long, doc_id long, n_bytes long, place long, start long, added long, piece string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, n_bytes, text in zip(*(c.to_pylist() for c in batch.columns)):
                for place, (start, piece, added) in enumerate(transducer(path).chunks(text, piece_chars)):
                    yield pa.RecordBatch.from_pylist([{"row": row, "doc_id": doc_id, "n_bytes": n_bytes, "place": place, "start": start, "added": added, "piece": piece}], PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, chunks = transducer(path).counts(batch.column("piece").to_pylist(), chunk_chars)
            lists = [[{"start": a + x, "tokens": b} for x, b in zip(s.tolist(), t.tolist())] for a, (s, t) in zip(batch.column("start").to_pylist(), chunks)]
            shape = pa.list_(pa.struct([("start", pa.int64()), ("tokens", pa.int64())]))
            kept = {c: batch.column(c) for c in ("row", "doc_id", "n_bytes", "place")}
            yield pa.RecordBatch.from_pydict({**kept, "n_tokens": pa.array(n + np.array(batch.column("added").to_pylist(), np.int64)), "added": batch.column("added"), "chunks": pa.array(lists, shape)})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_bytes", "text")
    pieces = rows.mapInArrow(cut, spec).repartition("row", "place")
    counted = pieces.mapInArrow(run, f"row long, doc_id long, n_bytes long, place long, n_tokens long, added long, chunks {CHUNKS}")
    before = F.coalesce(F.sum("n_tokens").over(W.partitionBy("row").orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col("added")
    moved = counted.withColumn("_before", before).withColumn("chunks", F.transform("chunks", lambda c: F.struct(c["start"].alias("start"), (c["tokens"] + F.col("_before")).alias("tokens"))))
    whole = moved.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "chunks"))), lambda p: p["chunks"])).alias("chunks"))
    return whole.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "chunks")


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, chunk_chars: int = CHUNK_CHARS, tokenizer_dir: str | None = None, long_chars: int = LONG_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and chunks (where each begins, and the tokens before it) of every row."""
    tune(docs.sparkSession)
    path = tokenizer_path(tokenizer, tokenizer_dir)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    is_long = F.length(F.coalesce("text", F.lit(""))) > long_chars
    return _whole(rows.where(~is_long), path, limit, chunk_chars).unionByName(_dealt(rows.where(is_long), path, limit, chunk_chars, long_chars))
