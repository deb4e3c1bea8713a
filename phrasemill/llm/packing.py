"""Best-fit packing of token sequences (operator 2).

Bounded-space online best-fit: at most ``open_bins`` sequences stay open. A bitset holds one
bit for each amount of free space that some open sequence has, so the tightest sequence that
still takes a piece is one shift and one lowest-set-bit away. When one more sequence would
exceed the bound, the fullest closes first.

Each task packs the pieces of its own input partition: nothing is shuffled, a lost task is
redone from its input alone, and the price is at most one part-filled sequence or so a task.
The packer itself is online: a piece is placed for good when it comes. Before it stands a bounded
look-ahead: pieces wait in blocks and come largest first, which fills sequences better than arrival
order (README has figures for both). A block ends before it can open more sequences than may stay
open (best-fit leaves at most one of them half empty, so half their room in tokens is the limit),
else its large pieces would close sequences that its small ones still fit; ``BLOCK`` pieces bound
the memory besides.

Edge cases: of equal free spaces the sequence that got it last is filled; texts of any length are
encoded whole, in slices; null text is empty and is one piece (the end id alone); a document of exactly
``max_tokens`` ids is one piece; repeated rows and repeated or null doc_ids are packed as the
separate rows they are; an empty table gives no rows; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tokenizer_path, tune

MAX_TOKENS = 4096
OPEN_BINS = 2048
BLOCK = 20_000
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class BestFit:
    """The packer: ``place(length)`` gives (sequence number, offset)."""

    def __init__(self, capacity: int = MAX_TOKENS, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: dict[int, list[int]] = {}
        self.bits = 0
        self.n_open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        n = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return n

    def place(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece has 1 to {self.capacity} tokens, not {length}")
        fits = self.bits >> length
        if fits:
            free = (fits & -fits).bit_length() - 1 + length
            n = self._take(free)
        else:
            free, n = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.n_open >= self.open_bins:  # only a new sequence can get here
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest > left:
                    return n, self.capacity - free  # the new one is the fullest and closes at once
                self._take(fullest)
            self.by_free.setdefault(left, []).append(n)
            self.bits |= 1 << left
            self.n_open += 1
        return n, self.capacity - free


class Blocks:
    """Pieces (tuples whose field ``at`` is the length) until their block is full."""

    def __init__(self, fit: BestFit, most: int = BLOCK, at: int = 3):
        self.fit, self.most, self.at = fit, most, at
        self.tokens = fit.open_bins * fit.capacity // 2
        self.held: list[tuple] = []
        self.size = 0

    def add(self, piece: tuple) -> bool:
        """Whether the block is full now."""
        self.held.append(piece)
        self.size += piece[self.at]
        return len(self.held) >= self.most or self.size >= self.tokens

    def flush(self) -> tuple[list[tuple], list[tuple[int, int]]]:
        """The block's pieces, largest first, and their places."""
        held, self.held, self.size = sorted(self.held, key=lambda p: -p[self.at]), [], 0
        return held, [self.fit.place(p[self.at]) for p in held]


def pieces(n_ids: int, max_tokens: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    return [(s, min(max_tokens, n_ids - s)) for s in range(0, n_ids, max_tokens)]


def pack(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1,
    max_tokens: int = MAX_TOKENS,
    open_bins: int = OPEN_BINS,
    with_ids: bool = False,
    tokenizer_dir: str | None = None,
) -> DataFrame:
    """One row a piece with its place. ``with_ids`` adds the piece's ids (array of int)."""
    tune(docs.sparkSession)
    path = tokenizer_path(tokenizer, tokenizer_dir)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .tokens import encoder

        enc = encoder(path)
        block = Blocks(BestFit(max_tokens, open_bins))
        base = TaskContext.get().partitionId() << 40

        def flush() -> pa.RecordBatch:
            held, places = block.flush()
            cols = list(zip(*held))
            arrays = [pa.array(cols[i], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            arrays += [pa.array([base + p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype("i4") for x in cols[5]], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            ids, at = enc.encode_column(batch.column(1), end_id)
            raw, at = memoryview(ids.astype("<u4", copy=False).tobytes()), at.tolist()
            for doc_id, first, last in zip(batch.column(0).to_pylist(), at, at[1:]):
                for k, (s, n) in enumerate(pieces(last - first, max_tokens)):
                    part = raw[4 * (first + s) : 4 * (first + s + n)]
                    if block.add((doc_id, k, s, n, zlib.crc32(part), bytes(part) if with_ids else None)):
                        yield flush()
        if block.held:
            yield flush()

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
