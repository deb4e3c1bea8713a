"""SimHash near-duplicates by BK-trees (operator 4).

Fingerprints: 64-bit majority vote over the XXH64 hashes of a text's word shingles. Two
documents link when their fingerprints differ in at most ``radius`` bits; groups are the
connected components.

Search. By the pigeonhole principle, fingerprints within radius r share one of r+1 bit blocks.
Distinct fingerprints are dealt into shards by (block, value of the block). Shards of more than
``MAX_SHARD`` are dealt again by blocks of their other bits, and once more: after ``LEVELS`` dealings at most
20 bits are free for radius 2, so no shard has more than 2^20 members, whatever the data. Each shard is a
BK-tree whose children are keyed by their integer Hamming distance to the parent, and a query
follows only the edges within the radius of its own distance. Trees of all shards of a task are
built and searched together, level by level, in numpy. A shard's trees reach the tasks by
shuffle rather than by broadcast, because the set of all fingerprints has no size bound, and because a tree of
all of them would be followed along far more edges (README has figures).
A fingerprint has at most 2,080 others within two bits, so links are linear in fingerprints, and a
task hands on a spanning forest of each shard, not its pairs.

Components: min-label propagation over forest edges, by joins with partial aggregation; each
round's labels are written to the shared folder, which cuts the lineage.

Edge cases: null or wordless text has fingerprint 0 and links like any other; null doc_ids get
the component of their fingerprint and never name one (null if no document of the component has
an id); repeated rows stay; an empty table gives no rows; other columns are ignored by ``groups``
and kept by ``keep_one``; texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shielded, split_text_key, stored, tune

SHINGLE = 3
RADIUS = 2
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Members of a shard beyond which it is dealt again, and how often that is done.
MAX_SHARD = 20_000
LEVELS = 3
#: Pairs of (query, node) that a search holds at once.
FRONTIER = 1 << 21


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 (seed 42) of each shingle; bytes.split splits at U+0020 and U+0009..U+000D."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = (ends[size - 1 :] if len(words) >= size else ends[-1:]).tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i : i + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    return majority(shingle_hashes(text or "", size))


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, _k (text key), fp (the fingerprint as a signed long)."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, size) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "_k", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), split_text_key(F.col("text")).alias("_k"), "text").mapInArrow(run, "doc_id long, _k long, fp long")


def bk_forest(values: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of all shards at once: (parent, edge, root) of every value; a shard's first value is its root.

    Level by level: the values that reached a node form a group; its first becomes the child there,
    and the rest go on under it, grouped by their distance to it.
    """
    n = len(values)
    parent, edge = np.full(n, -1), np.full(n, -1)
    _, root_of, shard_no = np.unique(shard, return_index=True, return_inverse=True)
    root = root_of[shard_no]
    rest = np.setdiff1d(np.arange(n), root_of)
    at = root[rest]
    while len(rest):
        d = np.bitwise_count(values[rest] ^ values[at]).astype(np.int64)
        slot = at * 65 + d
        _, first, back = np.unique(slot, return_index=True, return_inverse=True)
        child = rest[first]
        parent[child], edge[child] = at[first], d[first]
        go_on = np.ones(len(rest), bool)
        go_on[first] = False
        at, rest = child[back][go_on], rest[go_on]
    return parent, edge, root


def bk_links(values: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of one shard within the radius, by walking its tree for every value."""
    if not len(values):
        return
    parent, edge, root = bk_forest(values, shard)
    child = np.flatnonzero(parent >= 0)
    slot = parent[child] * 65 + edge[child]
    order = np.argsort(slot, kind="stable")
    child, slot = child[order], slot[order]
    stack = [(part, root[part]) for part in np.array_split(np.arange(len(values)), len(values) // FRONTIER + 1)]
    while stack:
        query, node = stack.pop()
        if len(query) > FRONTIER:
            half = len(query) // 2
            stack += [(query[:half], node[:half]), (query[half:], node[half:])]
            continue
        d = np.bitwise_count(values[query] ^ values[node]).astype(np.int64)
        hit = (d <= radius) & (query != node)
        if hit.any():
            yield query[hit], node[hit]
        a = np.searchsorted(slot, node * 65 + np.maximum(d - radius, 0), side="left")
        b = np.searchsorted(slot, node * 65 + np.minimum(d + radius, 64), side="right")
        n = b - a
        if n.any():
            total = int(n.sum())
            place = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            stack.append((np.repeat(query, n), child[place]))


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            jump = self.up[self.up]
            if (jump == self.up).all():
                return self.up
            self.up = jump

    def union(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            up = self.roots()
            a, b = up[i], up[j]
            differ = a != b
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def dealt(fps: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """path, v, fp: every fingerprint once a shard (path, v). Two within the radius share a shard.

    ``path`` names the blocks that were dealt by, ``v`` the fingerprint's bits in them.
    """
    free = {"": list(range(64))}
    rows, done = fps.select(F.lit("").alias("path"), "fp"), None
    for level in range(LEVELS):
        shares, left = {}, {}
        for path, bits in free.items():
            cuts = [len(bits) * i // (radius + 1) for i in range(radius + 2)]
            for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                left[f"{path}{i}"] = bits[:lo] + bits[hi:]
                used = [b for b in range(64) if b not in left[f"{path}{i}"]]
                shares.setdefault(path, []).append(F.struct(F.lit(f"{path}{i}").alias("path"), F.col("fp").bitwiseAND(F.lit(_mask(used))).alias("v")))
        options = [F.when(F.col("path") == path, F.array(*s)) for path, s in shares.items()]
        rows, free = rows.select("fp", F.explode(F.coalesce(*options)).alias("s")).select("s.path", "s.v", "fp"), left
        if level == LEVELS - 1:
            break
        hot = stored(rows.groupBy("path", "v").count().where(F.col("count") > max_shard).select("path", "v"), "simhash-hot")
        if hot.isEmpty():
            break
        cold = rows.join(hot, ["path", "v"], "left_anti")
        done = cold if done is None else done.unionByName(cold)
        rows = rows.join(hot, ["path", "v"], "left_semi")
    return rows if done is None else done.unionByName(rows)


def shard_edges(fps: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """A spanning forest (a, b) of every shard's links, over the distinct fingerprints ``fps`` (column fp)."""
    ordered = dealt(fps, radius, max_shard).select(F.xxhash64("path", "v").alias("shard"), "fp").repartition("shard").sortWithinPartitions("shard", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def search(shard: np.ndarray, values: np.ndarray) -> pa.RecordBatch | None:
            _, no, size = np.unique(shard, return_inverse=True, return_counts=True)
            paired = size[no] > 1  # a tree of one has no links
            shard, values = shard[paired], values[paired]
            forest = Forest(len(values))
            for i, j in bk_links(values, shard, radius):
                forest.union(i, j)
            up = forest.roots()
            linked = np.flatnonzero(up != np.arange(len(up)))
            if len(linked):
                return pa.RecordBatch.from_arrays([pa.array(values[linked].view(np.int64)), pa.array(values[up[linked]].view(np.int64))], ["a", "b"])
            return None

        kept = 0
        for batch in batches:
            no, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            held.append((no, fp.view(np.uint64)))
            kept += len(fp)
            if kept >= 200_000:  # whole shards only: the last one may go on
                shard, values = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(shard, shard[-1]))
                if cut:
                    if (out := search(shard[:cut], values[:cut])) is not None:
                        yield out
                    shard, values = shard[cut:], values[cut:]
                held, kept = [(shard, values)], 0
        if held:
            shard, values = (np.concatenate(x) for x in zip(*held))
            if len(shard) and (out := search(shard, values)) is not None:
                yield out

    return ordered.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """fp, root: the smallest fingerprint that each fingerprint with a link reaches.

    Each round, a fingerprint takes the smallest label among itself and its neighbours, then the
    label of that label, so chains shorten by doubling. Ends when a round changes nothing.
    """
    both = stored(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "simhash-edges")
    labels = table = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("fp"), "label"), "simhash-labels")
    while True:
        near = both.join(labels.withColumnRenamed("fp", "b"), "b").groupBy(F.col("a").alias("fp")).agg(F.min("label").alias("near"))
        step = labels.join(near, "fp").select("fp", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("fp").alias("next"), F.col("label").alias("far"))
        done = stored(step.join(jump, "next").select("fp", "label", F.least("next", "far").alias("next")), "simhash-labels")
        changed = not done.where("next <> label").isEmpty()
        discard(table)  # the labels before
        table = done
        labels = done.select("fp", F.col("next").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "root")


def groups(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row a document: doc_id, _k, fp, component_id (smallest doc_id reachable)."""
    fps = stored(fingerprints(docs, size), "simhash-fingerprints")
    least = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(shard_edges(least.select("fp"), radius))
    named = least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = named.where("root is not null").groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = stored(named.join(linked, "root").select("fp", "component_id"), "simhash-components")
    return fps.join(of_fp, "fp").select("doc_id", "_k", "fp", "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component its smallest doc_id, once.

    Rows of a component without any id: the one with the smallest text key stays.
    """
    found = groups(docs, size, radius).withColumn("component_id", F.coalesce("component_id", F.xxhash64("fp")))
    keep = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_k")).alias("m")).select(F.col("m.doc_id").alias("_keep_id"), F.col("m._k").alias("_keep_k"))
    return only(docs, keep)


def only(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id and text key ``keep`` (_keep_id, _keep_k) names, each once."""

    def held(mine: DataFrame) -> DataFrame:
        keyed = mine.withColumn("_keep_key", split_text_key(F.col("text")))
        joined = keyed.join(keep, keyed["doc_id"].cast("long").eqNullSafe(keep["_keep_id"]) & (keyed["_keep_key"] == keep["_keep_k"]), "left_semi")
        return joined.dropDuplicates(["doc_id", "_keep_key"]).drop("_keep_key")

    return shielded(docs, ("_keep_key", "_keep_id", "_keep_k"), held)
