"""Near copies by fingerprint links, MinHash bands and exact Jaccard (the near_dedup stage of the pipeline).

Two documents are near copies if the sets of their five-word shingles have a Jaccard similarity of
0.8 or more. Candidates are, first, what operator 4 links: fingerprints of the shingle sets within two
bits. Such links miss most pairs near 0.8 (README has figures), so, second, candidates share one of
``BANDS`` bands of ``ROWS`` minima each: a pair at 0.8 does with probability 0.998. Every candidate
is then verified by the exact similarity of its shingle sets, so documents that are merely alike stay.

Documents with the same shingle set are one set from the start. A large group would give pairs with
the square of its size, so the first pass compares each set of a bucket with one of the bucket,
another one in each band. What it leaves, one set a component, is compared in pairs within buckets of at most
``MAX_BUCKET``. Sets of larger buckets (texts from one template, say, that are less alike than near copies) go through an
exact similarity join instead: only pairs that share one of their rarest shingles are compared. So no two
documents that stay are near copies (but for the 0.2 % above), and each that goes is linked to
one that stays by verified pairs.

Edge cases: null or wordless texts have the empty set and are copies of each other; texts of fewer
words are one shingle; null doc_ids come last when the smallest doc_id is chosen; repeated rows
go; texts of any length are hashed whole; an empty table gives no rows; all columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.setsim import similar_pairs
from .common import split_text_key, stored, tune
from .simhash import components, majority, only, shard_edges, shingle_hashes

SHINGLE = 5
BANDS = 20
ROWS = 6
#: The least similarity, as a fraction.
NEAR = (4, 5)
#: Sets of a bucket that are compared in pairs; those of larger ones are joined by their rarest shingles.
MAX_BUCKET = 50
#: Shingles that are permuted at once.
LOT = 1024

_RNG = np.random.default_rng(4)
PERMUTE = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = _RNG.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(text or "", SHINGLE))


def bands(shingles: np.ndarray) -> np.ndarray:
    """One key a band, from the minima of its permutations."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), LOT):
        least = np.minimum(least, (shingles[i : i + LOT, None] * PERMUTE).min(axis=0))
    return (least.reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, _k (text key), set_key, n (distinct shingles), fp (fingerprint), bands of every row."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(2).to_pylist()]
            keys = np.array([xxh64_intdigest(s.tobytes(), 7) for s in sets], np.uint64).view(np.int64)
            fps = np.array([majority(s) for s in sets], np.uint64).view(np.int64)
            flat = np.concatenate([*map(bands, sets), np.zeros(0, np.uint64)]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys), pa.array([len(s) for s in sets], pa.int64()), pa.array(fps), lists], ["doc_id", "_k", "set_key", "n", "fp", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), split_text_key(F.col("text")).alias("_k"), "text")
    return rows.mapInArrow(run, "doc_id long, _k long, set_key long, n long, fp long, bands array<long>")


def linked(sets: DataFrame) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of sets with one fingerprint, and of fingerprints that operator 4 links (a forest of them)."""
    each = sets.where("n > 0").select("fp", F.col("set_key").alias("a"), F.col("n").alias("n_a"))
    heads = stored(each.groupBy("fp").agg(F.min(F.struct("a", "n_a")).alias("m")).select("fp", F.col("m.a").alias("b"), F.col("m.n_a").alias("n_b")), "minhash-heads")
    one = each.join(heads, "fp").select("a", "b", "n_a", "n_b")
    ends = shard_edges(heads.select("fp")).select(F.col("a").alias("fp_a"), F.col("b").alias("fp"))
    first = heads.select(F.col("fp").alias("fp_a"), F.col("b").alias("a"), F.col("n_b").alias("n_a"))
    return one.unionByName(ends.join(heads, "fp").join(first, "fp_a").select("a", "b", "n_a", "n_b"))


def fitting(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of those (a, b, n_a, n_b) whose sizes allow the similarity; stored."""
    p, q = NEAR
    fits = (F.col("a") != F.col("b")) & (q * F.least("n_a", "n_b") >= p * F.greatest("n_a", "n_b"))
    return stored(pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "minhash-pairs")


def banded(sets: DataFrame) -> DataFrame:
    return sets.where("n > 0").select(F.col("set_key").alias("a"), F.col("n").alias("n_a"), F.posexplode("bands").alias("band", "value"))


def starred(sets: DataFrame) -> DataFrame:
    """Candidates: each set with one set of each of its buckets, and what fingerprints link."""
    each = banded(sets)
    head = F.min(F.struct(F.xxhash64("a", "band").alias("h"), "a", "n_a"))
    buckets = each.groupBy("band", "value").agg(head.alias("head"), F.count("*").alias("size")).where("size > 1")
    mine = each.join(buckets.select("band", "value", F.col("head.a").alias("b"), F.col("head.n_a").alias("n_b")), ["band", "value"])
    return fitting(mine.select("a", "b", "n_a", "n_b").unionByName(linked(sets)))


def paired(sets: DataFrame, docs: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Verified pairs (a, b) of all sets that share a bucket."""
    each = banded(sets)
    # Few buckets are left with more than one set, so this table is small beside the sets.
    sizes = stored(each.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1"), "minhash-buckets")
    small = each.join(sizes.where(F.col("size") <= max_bucket).select("band", "value"), ["band", "value"])
    both = small.join(small.withColumnsRenamed({"a": "b", "n_a": "n_b"}), ["band", "value"]).where("a < b")  # at most max_bucket a set and band
    found = verified(fitting(both.select("a", "b", "n_a", "n_b")), sets, docs)
    crowded = stored(each.join(sizes.where(F.col("size") > max_bucket).select("band", "value"), ["band", "value"], "left_semi").select(F.col("a").alias("set_key")).distinct(), "minhash-crowded")
    if crowded.isEmpty():
        return found
    side = shingles_of(crowded, sets, docs).select(F.col("set_key").alias("id"), F.col("s").alias("key"))
    near = similar_pairs(side, side, [], *NEAR, F.col("l_id") < F.col("r_id"), long_keys=True)
    return found.unionByName(near.select(F.col("l_id").alias("a"), F.col("r_id").alias("b")))


def shingles_of(keys: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """set_key, s (the shingles) of the sets that ``keys`` names; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = [shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shingles, pa.list_(pa.int64()))], ["set_key", "s"])

    first = sets.join(keys, "set_key").select("set_key", F.col("first.doc_id").alias("_id"), F.col("first._k").alias("_key"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), split_text_key(F.col("text")).alias("_k"), "text")
    found = texts.join(first, texts["doc_id"].eqNullSafe(first["_id"]) & (texts["_k"] == first["_key"])).select("set_key", "text")
    return stored(found.mapInArrow(run, "set_key long, s array<long>").dropDuplicates(["set_key"]), "minhash-shingles")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose exact similarity is ``NEAR`` or more."""
    shingles = shingles_of(pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct(), sets, docs)
    both = pairs.join(shingles.withColumnsRenamed({"set_key": "a", "s": "s_a"}), "a").join(shingles.withColumnsRenamed({"set_key": "b", "s": "s_b"}), "b")
    inter = F.size(F.array_intersect("s_a", "s_b"))
    p, q = NEAR
    return both.where((p + q) * inter >= p * (F.size("s_a") + F.size("s_b"))).select("a", "b")


def survivors(sets: DataFrame, near: DataFrame) -> DataFrame:
    """Of each component of verified pairs the set with the smallest doc_id."""
    roots = components(near)
    named = sets.join(roots.withColumnRenamed("fp", "set_key"), "set_key", "left")
    # ``first`` differs between sets, so its minimum names one set of the component.
    kept = named.groupBy(F.coalesce("root", "set_key").alias("root")).agg(F.min(F.struct("first", "set_key", "n", "fp", "bands")).alias("m"))
    return stored(kept.select("m.*"), "minhash-sets")


def keep_one(docs: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies its smallest doc_id, once."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_k")).alias("first")
    rows = stored(sketches(docs), "minhash-sketches")
    sets = stored(rows.groupBy("set_key").agg(first, F.min("n").alias("n"), F.min("fp").alias("fp"), F.min("bands").alias("bands")), "minhash-sets")
    sets = survivors(sets, verified(starred(sets), sets, docs))
    sets = survivors(sets, paired(sets, docs, max_bucket))
    return only(docs, sets.select(F.col("first.doc_id").alias("_keep_id"), F.col("first._k").alias("_keep_k")))
