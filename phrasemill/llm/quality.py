"""Quality classifier by importance resampling (operator 5).

Two pairs of generative models over hashed word 1-grams and 2-grams are fitted: the target (text
labelled good: quality 1 and toxic 0) and the raw text (every document). One pair counts every
occurrence, the other at most ``MAX_TF`` a document, so that a burst in one text isn't taken for many texts.
A document's log weight is the log ratio of target to raw likelihood,

    sum over its bounded counts of shrunk log((target + prior) / (expected + prior))
    + BURST * the mean over all its n-grams of log((target + 1) / (expected + 1)),

where ``expected`` is the raw count (without the occurrence itself) times the share of documents that
are target. The first term adds up what single n-grams say; the second, normalized by length, is the
ratio for a stretch of ``BURST`` average n-grams and shows texts that repeat themselves or are made of marks.
So that thousands of rare n-grams don't add up to noise, the first term's logs are shrunk by
max(0, 1 - c^2 / z^2), z being the distance of target from expected in standard deviations. How much noise there is
depends on the table, so c is not fixed: each of ``SHRINKS`` is scored on labelled documents and
the one that separates good from bad best is taken. A labelled document's own counts are taken out of the
target, so it is weighed as if it had no label: labelled documents are held out for that choice.

The sample is drawn by Gumbel top-k: k documents with the largest log weight + Gumbel noise (a
function of doc_id, text and seed, so runs agree). k is ``share`` of all documents where that is given. Otherwise it is the
number of documents whose log weight passes the threshold that best separates labelled good from labelled bad documents
while it keeps at least ``MIN_KEPT`` of the good. The k-th largest key is found exactly by counting, 16 bits a pass,
never by sorting on one machine.

Labelled rows: at most ``max_labelled``, those whose hash of doc_id is smallest. The raw models
count every document, whole.

Edge cases: null or wordless text has weight 0; labels with null quality count as quality 0, null toxic as
0, null doc_id not at all, repeated labels by their worst; of rows that repeat a labelled doc_id the one with the smallest text
key helps choose; no good or no bad labels: every document is kept; ties at the k-th key are all kept; repeated rows
are scored alike and kept alike; texts of any length are counted whole; an empty
table gives no rows; ``keep`` keeps all columns of its input, ``sample`` none but doc_id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shielded, split_text_key, stored, tune
from .tokens import Ragged

BUCKETS = 1 << 18
MAX_TF = 3
PRIOR = 0.5
BURST = 10
#: Candidates of the shrinkage, in standard deviations; the labels decide.
SHRINKS = (1.5, 2.0, 2.5, 3.0, 4.0, 6.0)
MIN_KEPT = 0.97
MAX_LABELLED = 50_000
SEED = 5
GRAM = re.compile(r"[^\W_]+|[^\w\s]+|_+")
#: Distinct pieces kept by a worker; the table starts anew beyond.
MAX_PIECES = 300_000
#: Characters counted together; a longer text is counted by itself.
SLICE_CHARS = 1 << 21


class GramHasher:
    """The hashed n-grams of a column of texts; each distinct blank-separated piece is cut into words once."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = buckets
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = Ragged(np.uint32)

    def _rows(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > MAX_PIECES or self.table.used > 16 * MAX_PIECES:
            self._forget()
            known = self.known
        rows = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
        missing = np.flatnonzero(rows < 0).tolist()
        if missing:
            todo = [pieces[i] for i in missing]
            words = [GRAM.findall(p.lower()) for p in todo]
            flat = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for ws in words for w in ws], np.uint32)
            new = self.table.add(flat, np.fromiter(map(len, words), np.int64, len(words)))
            known.update(zip(todo, new))
            rows[missing] = new
        return rows

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, bucket, count) of every distinct bucket of every text, in that order. Null is empty."""
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = cut.values.dictionary_encode()
        rows = self._rows(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        words, size = self.table.gather(rows)
        owner = np.repeat(np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy())), size)
        h = words.astype(np.uint64)
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)
        inside = owner[:-1] == owner[1:]
        bucket = np.concatenate([h * np.uint64(0x9E3779B1) >> np.uint64(8), pairs[inside]]) % np.uint64(self.buckets)
        key, count = np.unique(np.concatenate([owner, owner[:-1][inside]]) * self.buckets + bucket.astype(np.int64), return_counts=True)
        return key // self.buckets, key % self.buckets, count

    def slices(self, *columns: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
        """The columns, of which the first holds texts, in slices of about ``SLICE_CHARS``."""
        sizes = pc.fill_null(pc.binary_length(columns[0]), 0).to_pylist()
        at = 0
        while at < len(sizes):
            stop, total = at, 0
            while stop < len(sizes) and (stop == at or total + sizes[stop] <= SLICE_CHARS):
                total += sizes[stop]
                stop += 1
            yield tuple(c.slice(at, stop - at) for c in columns)
            at = stop


def chosen_labels(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, good: at most ``max_labelled`` rows."""
    each = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(((F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("good"))
    )
    return each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)


def tagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, _k, text, good (null: not labelled). ``labels`` is bounded by ``max_labelled``, so it is broadcast."""
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), split_text_key(F.col("text")).alias("_k"), "text")
    return mine.join(F.broadcast(labels), "doc_id", "left").select("doc_id", "_k", "text", "good")


@dataclass(frozen=True)
class Model:
    """Documents and target documents in all; by bucket, occurrences in both: bounded by ``MAX_TF`` a document, and all."""

    n_raw: int
    n_target: int
    raw: np.ndarray
    target: np.ndarray
    raw_all: np.ndarray
    target_all: np.ndarray
    prior: float = PRIOR
    shrinks: tuple[float, ...] = SHRINKS

    @property
    def share(self) -> float:
        return self.n_target / max(self.n_raw, 1)

    def evidence(self, target: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Shrunk log ratios (n-gram, shrinkage)."""
        expected = self.share * np.maximum(raw - 1, 0)
        z2 = (target - expected) ** 2 / np.maximum(expected * (1 - self.share), 1e-9)
        ratio = np.where(raw > 1, np.log((target + self.prior) / (expected + self.prior)), 0.0)
        return ratio[:, None] * np.maximum(0.0, 1 - np.square(self.shrinks) / np.maximum(z2, 1e-9)[:, None])

    def ratio(self, target: np.ndarray, raw: np.ndarray) -> np.ndarray:
        return np.log((target + 1) / (self.share * np.maximum(raw - 1, 0) + 1))

    def weigher(self):
        """(text number, bucket, count, which texts are target) -> log weights (text, shrinkage)."""
        bounded, full = self.evidence(self.target, self.raw).astype(np.float32), self.ratio(self.target_all, self.raw_all)

        def weights(owner: np.ndarray, bucket: np.ndarray, count: np.ndarray, good: np.ndarray) -> np.ndarray:
            few = np.minimum(count, MAX_TF)
            e, r = bounded[bucket], full[bucket]
            own = np.flatnonzero(good[owner])  # without their own counts in the target
            b = bucket[own]
            e[own] = self.evidence(self.target[b] - few[own], self.raw[b])
            r[own] = self.ratio(self.target_all[b] - count[own], self.raw_all[b])
            total = lambda w: np.bincount(owner, w, len(good))
            mean = total(count * r) / np.maximum(total(count), 1)
            return np.stack([total(few * e[:, i]) + BURST * mean for i in range(len(self.shrinks))], axis=1)

        return weights


def fit(rows: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR, shrinks: tuple[float, ...] = SHRINKS) -> Model:
    """Counts by one pass over all rows (text, good); a table of ``buckets`` + 1 rows comes to the driver."""
    names = ["raw", "target", "raw_all", "target_all"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = GramHasher(buckets)
        table = np.zeros((4, buckets + 1), np.int64)  # the last bucket counts documents
        for batch in batches:
            for texts, labels in hasher.slices(batch.column(0), batch.column(1)):
                good = pc.fill_null(pc.equal(labels, 1), False).to_numpy(zero_copy_only=False)
                owner, bucket, count = hasher.counts(texts)
                of_good = good[owner]
                for i, c in ((0, np.minimum(count, MAX_TF)), (2, count)):
                    table[i, :-1] += np.bincount(bucket, c, buckets).astype(np.int64)
                    table[i + 1, :-1] += np.bincount(bucket[of_good], c[of_good], buckets).astype(np.int64)
                table[0, -1] += len(good)
                table[1, -1] += int(good.sum())
        used = np.flatnonzero(table[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(t[used]) for t in table)], ["bucket", *names])

    made = rows.select("text", "good").mapInArrow(run, "bucket long, " + ", ".join(f"{n} long" for n in names))
    counts = made.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names))
    table = np.zeros((4, buckets + 1), np.int64)
    for batch in counts.toArrow().to_batches():
        table[:, batch.column(0).to_numpy()] = [batch.column(i).to_numpy() for i in range(1, 5)]
    return Model(int(table[0, -1]), int(table[1, -1]), *(t[:-1] for t in table), prior, tuple(shrinks))


def threshold(scores: np.ndarray, good: np.ndarray, min_kept: float = MIN_KEPT) -> float:
    """The log weight that separates labelled good from bad best, of those that keep ``min_kept`` of the good.

    Best: the largest share of good kept plus share of bad gone. Minus infinity without both kinds.
    """
    if not good.any() or good.all():
        return float("-inf")
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    # Cutting below s[i] keeps i and all after it.
    kept = (g.sum() - np.cumsum(g) + g) / g.sum()
    gone = (np.cumsum(~g) - ~g) / (~g).sum()
    first = np.concatenate([[True], s[1:] > s[:-1]])
    i = int(np.where(first & (kept >= min_kept), kept + gone, -1).argmax())
    return float((s[i] + s[i - 1]) / 2) if i else float("-inf")


def separation(scores: np.ndarray, good: np.ndarray, cut: float) -> float:
    """Share of good kept plus share of bad gone."""
    return float((scores[good] >= cut).mean() + (scores[~good] < cut).mean()) if good.any() and not good.all() else 0.0


def chosen_shrink(weights: np.ndarray, good: np.ndarray) -> tuple[int, float]:
    """(column, threshold) of the shrinkage that separates the labelled documents best; of equals the strongest."""
    cuts = [threshold(w, good) for w in weights.T]
    gains = [separation(w, good, c) for w, c in zip(weights.T, cuts)]
    best = max(range(len(cuts)), key=lambda i: (gains[i], i))
    return best, cuts[best]


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, buckets: int = BUCKETS, prior: float = PRIOR, shrinks: tuple[float, ...] = SHRINKS) -> DataFrame:
    """doc_id, _k, good, log_weights (one a shrinkage) of every row, stored in the shared folder."""
    tune(docs.sparkSession)
    rows = tagged(docs, stored(chosen_labels(labels, max_labelled), "quality-labels"))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, buckets, prior, shrinks))  # 32 bytes a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        hasher, weights = GramHasher(buckets), m.weigher()
        for batch in batches:
            for texts, doc_id, k, labels in hasher.slices(batch.column(2), batch.column(0), batch.column(1), batch.column(3)):
                good = pc.fill_null(pc.equal(labels, 1), False).to_numpy(zero_copy_only=False)
                w = weights(*hasher.counts(texts), good)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * len(m.shrinks), pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([doc_id, k, labels, lists], ["doc_id", "_k", "good", "log_weights"])

    return stored(rows.mapInArrow(run, "doc_id long, _k long, good int, log_weights array<double>"), "quality-scores")


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest long of column ``key``, exactly: four passes that count 16 bits each."""
    low, rest = None, k
    prefix = 0
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-(2**63))), shift).bitwiseAND(0xFFFF)
        here = keys if shift == 48 else keys.where(F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-(2**63))), shift + 16) == prefix)
        counts = sorted(here.groupBy(digit.alias("d")).count().collect(), reverse=True)  # at most 65,536 rows
        for d, n in counts:
            if rest <= n:
                prefix = prefix << 16 | d
                break
            rest -= n
        else:
            return low
    return prefix - 2**63


def sample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    max_labelled: int = MAX_LABELLED,
    buckets: int = BUCKETS,
    prior: float = PRIOR,
    shrinks: tuple[float, ...] = SHRINKS,
    seed: int = SEED,
) -> DataFrame:
    """The sampled rows: doc_id, _k, log_weight, gumbel_key, selected (always true)."""
    weighed = score(docs, labels, max_labelled, buckets, prior, shrinks)
    one = weighed.where("good is not null").groupBy("doc_id").agg(F.min(F.struct("_k", "good", "log_weights")).alias("m"))
    known = one.select("m.log_weights", "m.good").toArrow()  # at most max_labelled rows
    held_out = known["log_weights"].combine_chunks().flatten().to_numpy().reshape(known.num_rows, len(shrinks))
    column, cut = chosen_shrink(held_out, known["good"].to_numpy() == 1)
    scores = weighed.withColumn("log_weight", F.col("log_weights")[column]).drop("log_weights")
    k = scores.where(F.col("log_weight") >= cut).count() if share is None else round(share * scores.count())
    # A uniform in (0, 1) from 52 bits of a hash; -log(-log u) is Gumbel noise.
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "_k", F.lit(seed)), 12).cast("double") + 0.5) / F.lit(float(1 << 52))
    # Rounded to 2**-20, so that the key is a whole number that counts exactly.
    key = F.round((F.col("log_weight") - F.log(-F.log(u))) * (1 << 20)).cast("long")
    keyed = scores.withColumn("key", key)
    least = kth_largest(keyed.select("key"), k) if k else None
    chosen = keyed.where(F.lit(False) if least is None else F.col("key") >= least)
    return chosen.select("doc_id", "_k", "log_weight", (F.col("key") / (1 << 20)).alias("gumbel_key"), F.lit(True).alias("selected"))


def keep(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the sample holds."""
    chosen = sample(docs, labels, **how).select(F.col("doc_id").alias("_id"), "_k").distinct()

    def held(mine: DataFrame) -> DataFrame:
        keyed = mine.withColumn("_key", split_text_key(F.col("text")))
        return keyed.join(chosen, keyed["doc_id"].cast("long").eqNullSafe(chosen["_id"]) & (keyed["_key"] == chosen["_k"]), "left_semi").drop("_key")

    return shielded(docs, ("_key", "_id", "_k"), held)
