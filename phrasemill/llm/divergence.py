"""Source divergence audit by two-dimensional group-block tiling (operator 11).

How far the sources of a language are from each other and from the language as a whole, by the
integer statistic f = floor((p - q)^2 / q) over smoothed term shares p and q in billionths. All
arithmetic is exact.

1. Tasks count the terms of their documents, whole blocks of texts at once, so what is shuffled is
   one row a (task's block, language, source, term). Terms that enough documents of the language
   hold are kept; their counts are stored.
2. The vocabulary is dealt into chunks by hash, and each source's counts of a chunk are packed into
   one row: term numbers and counts as little-endian arrays.
3. The sources of a language, in order, form blocks of ``BLOCK``. A packed vector is replicated to the
   tiles (block by block) that its block is part of; a tile is further dealt into stripes of ``STRIPE``
   successive chunks. A task unpacks one chunk after the other and adds up its submatrix of pairs; sums
   of stripes are added by an ordinary aggregate. Terms that no source of a tile has need no visit:
   stripes add f less the f of two absent terms, and every pair gets the number of kept terms times that.

What a tile's task holds is bounded: 2 ``BLOCK`` sources times ``STRIPE`` chunks of about ``CHUNK_TERMS`` terms.
Pairs between all sources of a language are the result itself, so its size is their square.

Cases: a null text, lang or source counts as an empty one; a group without terms takes part with count 0 for
each kept term; a language without kept terms has pairs of value 0 and no terms; a language with one source has no
pairs; repeated rows are documents of their own; equal values rank by item; very long texts are counted whole, in
one task; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, tune

MIN_DOCS, TOP = 3, 200
SCALE = 1_000_000_000
#: Sources a block; terms a chunk (about: terms are dealt by hash); chunks a stripe.
BLOCK, CHUNK_TERMS, STRIPE = 16, 4096, 8
#: Bytes of text that are counted together, and rows of a chunk that are packed together.
COUNT_BYTES, PACK_ROWS = 24 << 20, 1 << 20
#: Groups that may be broadcast; more are joined by shuffles.
MAX_BROADCAST = 50_000
#: Bytes that separate terms: all ASCII but letters. A-Z are lowered, bytes of other characters stay.
FOLD = bytes(b | 0x20 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _folded(texts: pa.Array) -> pa.Array:
    """Lower-case terms, each between blanks; the same offsets, so one pass over the bytes."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    texts = pa.concat_arrays([texts])  # offsets from 0
    _, offsets, data = texts.buffers()
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(FOLD))], offset=texts.offset)


def _count(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """lang, source, term, tf, df of some documents."""
    cut = pc.split_pattern(_folded(texts), " ")
    sizes = np.diff(cut.offsets.to_numpy())
    coded = cut.values.dictionary_encode()
    terms, n = coded.dictionary, max(len(coded.dictionary), 1)
    term = coded.indices.to_numpy().astype(np.int64)
    lang, source = pc.fill_null(langs, "").dictionary_encode(), pc.fill_null(sources, "").dictionary_encode()
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    term = np.repeat(np.arange(len(sizes)), sizes) * n + term
    del cut, coded
    # Once a document and term, with the occurrences; then once a group and term.
    held, tf = np.unique(term, return_counts=True)
    key = group[held // n] * n + held % n
    del term, held
    order = np.argsort(key, kind="stable")
    key, tf = key[order], tf[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    df = np.diff(np.append(first, len(key)))
    tf = np.add.reduceat(tf, first) if len(first) else tf
    key = key[first]
    which, of = key % n, key // n
    out = pa.RecordBatch.from_pydict({
        "lang": lang.dictionary.take(pa.array(of // max(len(source.dictionary), 1))),
        "source": source.dictionary.take(pa.array(of % max(len(source.dictionary), 1))),
        "term": terms.take(pa.array(which)).cast(pa.string()),
        "tf": pa.array(tf.astype(np.int64)), "df": pa.array(df.astype(np.int64)),
    })
    return out.filter(pc.not_equal(out.column("term"), ""))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, tf (occurrences), df (documents), aggregated within tasks only."""
    tune(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            out = _count(*(t.column(c).combine_chunks() if t.column(c).num_chunks != 1 else t.column(c).chunk(0) for c in range(3)))
            for i in range(0, len(out), 100_000):
                yield out.slice(i, 100_000)

        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= COUNT_BYTES:
                yield from counted()
                held, size = [], 0
        if held:
            yield from counted()

    texts = docs.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")))
    return texts.mapInArrow(work, "lang string, source string, term string, tf long, df long")


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """lang, source, term, tf, total (tf in the language), first (one row a term) of the terms that ``min_docs`` documents of their language hold."""
    # Dealt by language and term, so the sums by source, the totals and the choice need no other shuffle. A key has at most a row a (block, source).
    dealt = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    w = W.partitionBy("lang", "term")
    rows = dealt.select("lang", "source", "term", "tf", F.sum("tf").over(w).alias("total"), F.sum("df").over(w).alias("held"), (F.min("source").over(w) == F.col("source")).alias("first"))
    return rows.where(F.col("held") >= min_docs).drop("held")


def groups_of(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, source, n (occurrences of kept terms), v (kept terms of the language), lang_n, block, at (place within the block), n_blocks."""
    seen = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("tf").alias("n"), F.count_if("first").alias("firsts"))
    w = W.partitionBy("lang")
    place = F.row_number().over(w.orderBy("source")) - 1
    return (
        seen.join(sums, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(F.sum("firsts").over(w), F.lit(0)).alias("v"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("lang_n"), place.alias("place"), F.count("*").over(w).alias("size"))
        .select("lang", "source", "n", "v", "lang_n", F.floor(F.col("place") / BLOCK).cast("int").alias("block"), (F.col("place") % BLOCK).alias("at"), F.ceil(F.col("size") / BLOCK).cast("int").alias("n_blocks"))
    )


def packed(counts: DataFrame, n_chunks: int) -> DataFrame:
    """lang, source, chunk, terms, counts: term numbers within the chunk (32 bits) and counts (64 bits), little-endian."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None  # language and chunk that are being read
        last, number = None, -1  # its last term and that term's number
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def emitted() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            source = pa.chunked_array([s for s, _, _ in held]).combine_chunks()
            coded = (source.combine_chunks() if isinstance(source, pa.ChunkedArray) else source).dictionary_encode()
            which = coded.indices.to_numpy()
            numbers, tf = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            order = np.argsort(which, kind="stable")
            ends = np.cumsum(np.bincount(which, minlength=len(coded.dictionary)))
            numbers, tf = numbers[order].astype("<u4"), tf[order].astype("<i8")
            cuts = [0, *ends.tolist()]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([at[0]] * len(ends), pa.string()), "source": coded.dictionary, "chunk": pa.array([at[1]] * len(ends), pa.int32()),
                "terms": pa.array([numbers[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                "counts": pa.array([tf[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            })

        for batch in batches:
            lang, chunk, term = (batch.column(c) for c in ("lang", "chunk", "term"))
            n = len(batch)
            new_part = np.ones(n, bool)
            new_term = np.ones(n, bool)
            if n > 1:
                changed = pc.or_(pc.not_equal(lang.slice(1), lang.slice(0, n - 1)), pc.not_equal(chunk.slice(1), chunk.slice(0, n - 1)))
                new_part[1:] = changed.to_numpy(zero_copy_only=False)
                new_term[1:] = new_part[1:] | pc.not_equal(term.slice(1), term.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            cuts = [*np.flatnonzero(new_part).tolist(), n]
            for a, b in zip(cuts, cuts[1:]):
                here = (lang[a].as_py(), chunk[a].as_py())
                if here != at:
                    yield from emitted()
                    at, last, number, held = here, None, -1, []
                fresh = new_term[a:b].copy()
                fresh[0] = term[a].as_py() != last
                numbers = number + np.cumsum(fresh)
                last, number = term[b - 1].as_py(), int(numbers[-1])
                held.append((batch.column("source").slice(a, b - a), numbers, batch.column("tf").slice(a, b - a).to_numpy()))
                if sum(len(h[1]) for h in held) >= PACK_ROWS:  # a source may get several rows a chunk
                    yield from emitted()
                    held = []
        yield from emitted()

    chunk = F.pmod(F.xxhash64("term"), F.lit(n_chunks)).cast("int")
    rows = counts.select("lang", chunk.alias("chunk"), "term", "source", "tf").repartition("lang", "chunk").sortWithinPartitions("lang", "chunk", "term")
    return rows.mapInArrow(work, "lang string, source string, chunk int, terms binary, counts binary")


def shares(counts: np.ndarray, total: int, v: int) -> np.ndarray:
    """p = 1 + floor(SCALE (count + 1) / (total + v)), exactly."""
    more = counts + 1
    if int(more.max(initial=0)) * SCALE < 1 << 63:
        return 1 + more * SCALE // (total + v)
    return np.array([1 + int(c) * SCALE // (total + v) for c in more.tolist()], np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = np.abs(p - q).astype(np.uint64)
    return (gap * gap // q.astype(np.uint64)).astype(np.int64)


def tile_sums(lang: str, a: int, b: int, stripe: int, head, rows) -> list[tuple[str, str, str, int]]:
    """(lang, source, item, value) of a tile's pairs over one stripe. ``head``: the tile's groups; ``rows``: their packed vectors."""
    v = int(head.v.iloc[0])
    members = sorted(zip(head.block.tolist(), head["at"].tolist(), head.source.tolist(), head.n.tolist()))
    place = {s: i for i, (_, _, s, _) in enumerate(members)}
    left = [i for i, m in enumerate(members) if m[0] == a]
    right = [i for i, m in enumerate(members) if m[0] == b]
    both = {(i, j) for i in left for j in right} | {(j, i) for i in left for j in right}
    if not v:
        return [(lang, members[i][2], members[j][2], 0) for i, j in both if i != j]
    absent = np.array([shares(np.zeros(1, np.int64), m[3], v)[0] for m in members])
    base = divergence(absent[:, None], absent[None, :])
    total = base * v if stripe == 0 else np.zeros_like(base)
    for _, part in sorted(rows.groupby("chunk"), key=lambda x: x[0]):
        unpacked = [(place[s], np.frombuffer(t, "<u4"), np.frombuffer(c, "<i8")) for s, t, c in zip(part.source, part.terms, part.counts)]
        used, column = np.unique(np.concatenate([t for _, t, _ in unpacked]), return_inverse=True)
        p = np.repeat(absent[:, None], len(used), axis=1)
        end = 0
        for i, t, c in unpacked:
            start, end = end, end + len(t)
            p[i, column[start:end]] = shares(c, members[i][3], v)
        for i in left:
            total[i, right] += divergence(p[i], p[right]).sum(axis=1) - base[i, right] * len(used)
            if a != b:
                total[right, i] += divergence(p[right], p[i]).sum(axis=1) - base[right, i] * len(used)
    return [(lang, members[i][2], members[j][2], int(total[i, j])) for i, j in both if i != j]


def pair_values(vectors: DataFrame, groups: DataFrame, n_chunks: int) -> DataFrame:
    """lang, source, item, value of every ordered pair of a language's sources."""
    n_stripes = -(-n_chunks // STRIPE)

    def tiled(df: DataFrame) -> DataFrame:
        """Each row to every tile that its block is part of."""
        other = df.select("*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("_other"))
        return other.withColumns({"a": F.least("block", "_other"), "b": F.greatest("block", "_other")}).drop("_other", "n_blocks")

    head = tiled(groups.select("lang", "source", "n", "v", "block", "at", "n_blocks"))
    head = head.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.when(F.col("v") > 0, n_stripes - 1).otherwise(0))))
    known = groups.select("lang", "source", "block", "n_blocks")
    rows = tiled(vectors.join(known, ["lang", "source"])).withColumn("stripe", F.floor(F.col("chunk") / STRIPE).cast("int")).drop("block")

    def work(key: tuple, head, rows):
        import pandas as pd

        return pd.DataFrame(tile_sums(key[0], int(key[1]), int(key[2]), int(key[3]), head, rows), columns=["lang", "source", "item", "value"])

    by = ["lang", "a", "b", "stripe"]
    sums = head.groupBy(*by).cogroup(rows.groupBy(*by)).applyInPandas(work, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def share(count: Column, total: Column, v: Column) -> Column:
    """The same p as a Column; counts whose product leaves 64 bits go through decimals."""
    wide = (F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")).cast("decimal(38,0)")
    quotient = F.call_function("div", wide, (total + v).cast("decimal(20,0)"))
    return 1 + F.when(count < F.lit((1 << 63) // SCALE - 1), F.call_function("div", F.lit(SCALE).cast("long") * (count + 1), total + v)).otherwise(quotient)


def term_values(counts: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value, rank of the terms that a source has more of than its language, the first ``top`` of each."""
    side = groups.select("lang", "source", "n", "v", "lang_n")
    if side.count() <= MAX_BROADCAST:
        side = F.broadcast(side)
    rows = counts.join(side, ["lang", "source"])
    both = rows.select("lang", "source", F.col("term").alias("item"), share(F.col("tf"), F.col("n"), F.col("v")).alias("p"), share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q")).where("p > q")
    gap = F.col("p") - F.col("q")
    value = both.select("lang", "source", "item", F.call_function("div", gap * gap, F.col("q")).alias("value"))
    # Each task keeps its first ``top`` rows a source before the shuffle.
    place = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return value.withColumn("rank", place).where(F.col("rank") <= top)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    counts = stored(kept_counts(docs, min_docs), "divergence-counts")
    groups = stored(groups_of(docs, counts), "divergence-groups")
    most = groups.agg(F.max("v")).first()[0] or 0
    n_chunks = max(1, -(-most // CHUNK_TERMS))
    pairs = pair_values(packed(counts, n_chunks), groups, n_chunks)
    place = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair = pairs.withColumn("rank", place).withColumn("part", F.lit("pair")).select(*columns)
    return pair.unionByName(term_values(counts, groups, top).withColumn("part", F.lit("term")).select(*columns))


#: One statement over ``documents``; cross products of sources within a language are the result itself.
ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
t AS (SELECT n, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT n) >= 3),
c AS (SELECT t.lang, t.source, t.term, count(*) AS tf FROM t JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, coalesce(sum(c.tf), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT s.lang, s.source, kept.term, coalesce(c.tf, 0) AS tf,
    (1 + 1000000000::HUGEINT * (coalesce(c.tf, 0) + 1) // (s.n + v.v))::HUGEINT AS p,
    (1 + 1000000000::HUGEINT * (kept.total + 1) // (v.n + v.v))::HUGEINT AS q
  FROM s JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE tf > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM every
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
