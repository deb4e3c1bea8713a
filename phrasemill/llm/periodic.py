"""Periodic runs of words by the runs theorem (operator 12).

A run is a stretch with smallest period p that repeats at least twice and can't be extended without
breaking the period. Bannai, I, Inenaga, Nakashima, Takeda and Tsuruta ("The runs theorem", SIAM J.
Comput. 46(5), 2017): for one of the two orders of the alphabet, every place of a run where a
Lyndon rotation of its period begins has that rotation as its *longest* Lyndon word. So the two
longest Lyndon words of each place are all the roots there can be, and every run has such a root
within its first period.

All documents of a batch are handled at once in arrays. Their words become numbers, a word of
another document being another number, so nothing compares equal across documents, and a unique end
mark that is smallest follows each document.

1. The suffix array: three words a key are sorted first, then places that are still tied by prefix doubling.
2. The longest Lyndon word of a place ends before the next smaller value of the inverse suffix
   array; under the reversed order (end mark included), before the next greater one.
3. LCP values: places whose predecessor in the suffix array has another word before it are compared
   directly (their sum is O(n log n)), all others are one less than their left neighbour's.
4. Common extensions are range minima over LCP, by a sparse table over blocks. A root of period p
   is extended to the right by one query, to the left by bisection over such queries.

Cases: null and wordless texts have no runs and collapse to an empty text (null text to an empty one
too); a text is held whole by its task (about 60 bytes a word, a batch at most 16 MB or one text);
rows are independent, so repeated rows get the same; an empty table gives none; doc_id of any type is
handed through; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tune

#: Least repeats and least words of the runs that are reported.
MIN_EXPONENT, MIN_LENGTH = 4, 6
#: Places of one block of the sparse table.
BLOCK = 16
#: Words that are compared place by place before whole slices are.
STEPS = 16
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


class RangeMin:
    """Minima of ranges of an array: within blocks by looking, over blocks by a sparse table."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n = -(-max(len(values), 1) // BLOCK)
        padded = np.full(n * BLOCK, np.iinfo(values.dtype).max, values.dtype)
        padded[: len(values)] = values
        self.padded = padded
        self.levels = [padded.reshape(n, BLOCK).min(axis=1)]
        while 2 << len(self.levels) - 1 <= n:
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The minimum of values[first:stop] for each pair; ranges aren't empty."""
        out = np.full(len(first), np.iinfo(self.values.dtype).max, self.values.dtype)
        a, b = -(-first // BLOCK), stop // BLOCK
        inner = np.flatnonzero(a < b)
        if len(inner):
            level = np.frexp((b - a)[inner].astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                own = inner[level == k]
                out[own] = np.minimum(self.levels[k][a[own]], self.levels[k][b[own] - (1 << k)])
        for k in range(BLOCK):
            left, right = first + k, stop - 1 - k
            np.minimum(out, np.where(left < np.minimum(stop, a * BLOCK), self.padded[np.minimum(left, stop - 1)], out), out)
            np.minimum(out, np.where(right >= np.maximum(first, b * BLOCK), self.padded[np.maximum(right, first)], out), out)
        return out


def suffix_array(symbols: np.ndarray, doc: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, its inverse) of documents in a row; ``symbols`` are word numbers from 1, 0 ends a document, ``doc`` rises."""
    n = len(symbols)
    bits = int(kinds).bit_length()
    padded = np.concatenate([symbols, np.zeros(2, symbols.dtype)])
    second, third = padded[1 : n + 1].copy(), padded[2 : n + 2].copy()
    second[symbols == 0] = 0  # nothing of the next document
    third[second == 0] = 0
    width = 3 if int(doc[-1]).bit_length() + 3 * bits <= 63 else 1
    if width == 3:
        key = (((doc << bits | symbols) << bits | second) << bits) | third
    else:
        key = doc << bits | symbols
    order = np.argsort(key)
    sorted_key = key[order]
    fresh = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    # A group's rank is the place of its last member, so a rank is final once its group is a single one.
    rank = np.empty(n, np.int64)
    tops = np.concatenate([np.flatnonzero(fresh)[1:], [n]]) - 1
    rank[order] = np.repeat(tops, np.diff(np.concatenate([[-1], tops])))
    tied = np.flatnonzero(~(fresh & np.concatenate([fresh[1:], [True]])))
    h = width
    while len(tied):
        at = order[tied]
        group = rank[at]
        pair = group * np.int64(n + 1) + rank[at + h]
        by = np.argsort(pair, kind="stable")
        at, pair, group = at[by], pair[by], group[by]
        order[tied] = at
        fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
        tops = np.concatenate([np.flatnonzero(fresh)[1:], [len(at)]]) - 1
        sizes = np.diff(np.concatenate([[-1], tops]))
        rank[at] = np.repeat(tied[tops], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order, rank


def lcp_array(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """LCP of each suffix in the array with the one before it; 0 for the first. End marks (0) match nothing."""
    n = len(symbols)
    before = np.empty(n, np.int64)  # the suffix before, by place
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    place = np.arange(n)
    has = before >= 0
    left = np.where(has & (place > 0) & (before > 0), symbols[before - 1] == symbols[place - 1], False) & (symbols[place - 1] != 0)
    own = np.flatnonzero(~left)
    plcp = np.zeros(n, np.int64)
    active = own[has[own]]
    for k in range(STEPS):
        if not len(active):
            break
        a, b = active + k, before[active] + k
        same = (symbols[a] == symbols[b]) & (symbols[a] != 0)
        plcp[active] = k
        active = active[same]
    for i in active.tolist():
        a, b, k, step = i, int(before[i]), STEPS, 64
        while True:
            x, y = symbols[a + k : a + k + step], symbols[b + k : b + k + step]
            m = min(len(x), len(y))
            stop = np.flatnonzero((x[:m] != y[:m]) | (x[:m] == 0))
            if len(stop):
                k += int(stop[0])
                break
            k, step = k + m, 2 * step
        plcp[i] = k
    source = np.maximum.accumulate(np.where(left, -1, place))
    plcp = plcp[source] - (place - source)
    return np.maximum(plcp, 0)[order]


def next_beyond(rank: np.ndarray, smaller: bool) -> np.ndarray:
    """For each place the next one whose rank is smaller (or greater); the array's length where there is none."""
    n = len(rank)
    values = rank if smaller else -rank
    out = np.full(n, n, np.int64)
    open_ = np.arange(n)
    for k in range(1, STEPS + 1):
        open_ = open_[open_ + k < n]
        if not len(open_):
            return out
        found = values[open_ + k] < values[open_]
        out[open_[found]] = open_[found] + k
        open_ = open_[~found]
    # The others go over aligned blocks of growing size, then back down to the place.
    levels, size = [values], 1
    while len(levels[-1]) > 1:
        last = levels[-1]
        if len(last) % 2:
            last = np.append(last, np.iinfo(np.int64).max)
        levels.append(np.minimum(last[::2], last[1::2]))
    at, mine = open_ + STEPS + 1, values[open_]
    keep = at < n
    at, mine, open_ = at[keep], mine[keep], open_[keep]
    level = np.zeros(len(at), np.int64)
    going_up = np.ones(len(at), bool)
    while len(at):
        value = np.empty(len(at), np.int64)
        inside = np.zeros(len(at), bool)
        for k in np.unique(level).tolist():
            own = level == k
            block = at[own]
            inside[own] = block < len(levels[k])
            value[own] = levels[k][np.minimum(block, len(levels[k]) - 1)]
        hit = inside & (value < mine)
        done = hit & (level == 0)
        out[open_[done]] = at[done]
        down = hit & ~done
        going_up[down] = False
        miss = inside & ~hit
        # A miss goes to the block after it, one level up where that block is aligned (and the way leads up).
        after = at + 1
        up = miss & going_up & (after % 2 == 0)
        at = np.where(down, at * 2, np.where(up, after // 2, np.where(miss, after, at)))
        level = np.where(down, level - 1, np.where(up, level + 1, level))
        rest = inside & ~done
        at, mine, open_, level, going_up = at[rest], mine[rest], open_[rest], level[rest], going_up[rest]
    return out


def runs(symbols: np.ndarray, doc: np.ndarray, kinds: int, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs with ``min_exponent`` repeats (2 or more) and ``min_length`` symbols, by start and period.

    ``symbols`` are documents in a row, each a few numbers from 1 and a 0; ``doc`` numbers them in rising order.
    """
    n = len(symbols)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none
    order, rank = suffix_array(symbols, doc, kinds)
    starts, periods = [], []
    for smaller in (True, False):
        end = next_beyond(rank, smaller)
        at = np.flatnonzero((end < n) & (symbols != 0))
        at = at[doc[end[at]] == doc[at]]
        at = at[symbols[end[at]] == symbols[at]]  # else the root doesn't repeat
        starts.append(at)
        periods.append(end[at] - at)
    both = np.unique(np.concatenate(starts) * np.int64(n) + np.concatenate(periods))
    i, p = both // n, both % n
    if not len(i):
        return none, none, none
    least = RangeMin(lcp_array(symbols, order))

    def extension(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The common extension of the suffixes at a and b > a of one document."""
        x, y = rank[a], rank[b]
        return least(np.minimum(x, y) + 1, np.maximum(x, y) + 1)

    right = extension(i, i + p)
    # The root that lies in a run's first period repeats this often after itself.
    keep = right >= np.maximum((min_exponent - 2) * p, 1)
    i, p, right = i[keep], p[keep], right[keep]
    # The least place from which period p reaches i, by bisection: it does from s if the extension of s and s + p passes i.
    first = np.searchsorted(doc, doc[i])
    low, high = np.maximum(first, i - p), i.copy()
    while (todo := low < high).any():
        at = np.flatnonzero(todo)
        mid = (low[at] + high[at]) // 2
        reaches = extension(mid, mid + p[at]) >= i[at] - mid
        high[at] = np.where(reaches, mid, high[at])
        low[at] = np.where(reaches, low[at], mid + 1)
    # A root that begins a whole period or more behind its run's start has another before it.
    length = i + p + right - high
    keep = (i - high < p) & (length >= np.maximum(min_length, min_exponent * p))
    found = np.unique(np.stack([high[keep], p[keep], length[keep]], axis=1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def runs_of(texts: list[bytes], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs as (start, length, period), kept words joined by one space) of each text.

    A word is dropped if a run holds it behind its first period.
    """
    words = [t.split() for t in texts]  # bytes are split at the six ASCII white-space characters
    numbers: dict[bytes, int] = {}
    size = np.array([len(w) for w in words], np.int64)
    flat = np.zeros(int(size.sum()) + len(words), np.int64)
    ends = np.cumsum(size + 1)
    room = np.ones(len(flat), bool)
    room[ends - 1] = False
    flat[room] = np.fromiter((numbers.setdefault(x, len(numbers) + 1) for w in words for x in w), np.int64, int(size.sum()))
    doc = np.repeat(np.arange(len(words)), size + 1)
    start, length, period = runs(flat, doc, len(numbers), min_exponent, min_length)
    of = doc[start]
    first = ends - size - 1
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    cuts = np.searchsorted(of, np.arange(len(words) + 1))
    out = []
    for d, w in enumerate(words):
        a, b = int(cuts[d]), int(cuts[d + 1])
        if a == b:
            out.append((len(w), [], b" ".join(w)))
        else:
            own = list(zip((start[a:b] - first[d]).tolist(), length[a:b].tolist(), period[a:b].tolist()))
            keep = (~gone[first[d] : first[d] + len(w)]).tolist()
            out.append((len(w), own, b" ".join([x for x, k in zip(w, keep) if k])))
    return out


def find_runs(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (by start, then period; starts are word numbers from 0) and the collapsed text of every whole text."""
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    tune(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            found = runs_of([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()], min_exponent, min_length)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "n_words": pa.array([n for n, _, _ in found], pa.int64()),
                "runs": pa.array([[{"start": s, "length": e, "period": p} for s, e, p in r] for _, r, _ in found], shape),
                "collapsed": pa.array([c for _, _, c in found], pa.binary()).cast(pa.string()),
            })

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, n_words long, runs {RUN}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` in which one document in ten is made periodic from some word on: the query's test cases.

    With h the CRC-32 of the decimal doc_id and n words, where h % 10 = 0 and n > 0 the words from a = (h div 10) % n on become
    the first p of them over and over, p = 1 + (n - a) div (3 + (h div 10) % 8). A null doc_id changes nothing.
    """
    g = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = F.floor(1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        kept = F.slice(words, F.lit(1), a)
        again = F.transform(F.sequence(a, n - 1), lambda i: F.element_at(words, (a + (i - a) % p + 1).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(kept, again), " ")).otherwise("")

    words = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    # The array is made once: a lambda over a one-element array binds it.
    return docs.select("doc_id", F.when(hit & F.col("text").isNotNull(), F.element_at(F.transform(F.array(words), repeated), 1)).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from what ``find_runs`` gives."""
    best = F.reduce(
        F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.floor(F.lit(1000).cast("long") * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
