"""Greedy leader clustering of keys.

Keys come by rank. A key joins the earlier leader that is most similar to it (ties: the lowest
rank), if that reaches the threshold and their lead verbs aren't opposites; else it leads.

Who leads is the lexicographically first maximal independent set of the similarity graph (Blelloch,
Fineman and Shun, SPAA 2012). ``iterated`` settles it by joins over the graph's edges: a few rounds
in which every key without earlier unsettled neighbours leads and its neighbours follow, which is
nearly all in graphs without long chains; then what is left goes by blocks of ranks, each settled by
one scan of its inner edges and one join with the edges that leave it. So the rounds are bounded by
the number of blocks, whatever the graph. ``local`` scans one partition's keys in order.
``leader_clusters`` uses ``local`` for partitions of at most ``max_local`` keys, whose memory is
thereby bounded, and ``iterated`` for the others. Both give the same clusters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import DEFAULT, Lexicon
from ..plans.ship import ship
from ..plans.storage import discard, stored
from .ranks import numbered
from .setsim import POSTING, similar_pairs

SCOPE = ["tool", "batch"]
MAX_LOCAL = 20_000
#: Rounds that settle keys side by side, before blocks of so many keys are settled one after the other.
ROUNDS, BLOCK = 4, 20_000


def opposed(a: Column, b: Column, lex: Lexicon = DEFAULT) -> Column:
    """Whether two lead verbs (null: none) must never merge."""
    pair = F.concat(F.least(a, b), F.lit(" "), F.greatest(a, b))
    return F.coalesce(a.isNotNull() & b.isNotNull() & pair.isin(*[" ".join(p) for p in lex.never_merge]), F.lit(False))


#: A part of a threshold: one number, or one a batch.
ByBatch = int | dict[str, int]


def of_batch(part: ByBatch) -> int | Column:
    """``part`` as similarity joins take it."""
    return part if isinstance(part, int) else F.coalesce(*(F.when(F.col("batch") == b, n) for b, n in part.items()))


def edges(groups: DataFrame, num: ByBatch, den: ByBatch, lex: Lexicon = DEFAULT) -> DataFrame:
    """tool, batch, i, j (earlier), score: every mergeable pair."""
    side = groups.select(*SCOPE, F.col("group_rank").alias("id"), "key")
    pairs = similar_pairs(side, side, SCOPE, of_batch(num), of_batch(den), F.col("r_id") < F.col("l_id"), posting=POSTING)
    verbs = groups.select(*SCOPE, "group_rank", "lead")
    l = verbs.select(*SCOPE, F.col("group_rank").alias("l_id"), F.col("lead").alias("l_lead"))  # noqa: E741
    r = verbs.select(*SCOPE, F.col("group_rank").alias("r_id"), F.col("lead").alias("r_lead"))
    return (
        pairs.join(l, [*SCOPE, "l_id"])
        .join(r, [*SCOPE, "r_id"])
        .where(~opposed(F.col("l_lead"), F.col("r_lead"), lex))
        .select(*SCOPE, F.col("l_id").alias("i"), F.col("r_id").alias("j"), (F.col("inter") / F.col("uni")).alias("score"))
    )


def _without(links: DataFrame, followers: DataFrame) -> DataFrame:
    """``links`` (i, j) between keys that don't follow."""
    gone = followers.select(*SCOPE, F.col("id").alias("i"))
    return links.join(gone, [*SCOPE, "i"], "left_anti").join(gone.withColumnRenamed("i", "j"), [*SCOPE, "j"], "left_anti")


def _settled_at_once(links: DataFrame) -> DataFrame:
    """scope..., id of the keys that follow one without earlier neighbours."""
    leaders = links.select(*SCOPE, "j").join(links.select(*SCOPE, F.col("i").alias("j")), [*SCOPE, "j"], "left_anti").distinct()
    return links.join(leaders, [*SCOPE, "j"], "left_semi").select(*SCOPE, F.col("i").alias("id")).distinct()


def _scanned(links: DataFrame) -> DataFrame:
    """scope..., id of the followers that a scan of ``links`` (earlier ones first) finds. A task keeps the followers of one scope; links stream by."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scope, follows = None, set()
        for batch in batches:
            out = []
            for *here, i, j in zip(*(c.to_pylist() for c in batch.columns)):
                if here != scope:
                    scope, follows = here, set()
                if i not in follows and j not in follows:
                    follows.add(i)
                    out.append((*here, i))
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], t) for n, t in enumerate((pa.string(), pa.string(), pa.int64()))], [*SCOPE, "id"])

    ship(links.sparkSession)
    rows = links.select(*SCOPE, F.col("i").cast("long"), F.col("j").cast("long")).repartition(*SCOPE).sortWithinPartitions(*SCOPE, "i", "j")
    return rows.mapInArrow(scan, "tool string, batch string, id long")


def _blocked(links: DataFrame, block: int) -> tuple[DataFrame, int]:
    """``links`` with block_i and block_j (blocks of ``block`` linked keys by rank), and the number of blocks."""
    nodes = links.select(*SCOPE, F.col("i").alias("id")).union(links.select(*SCOPE, "j")).distinct()
    placed = numbered(nodes, SCOPE, [F.col("id").alias("o1")], "place")
    placed = stored(placed.select(*SCOPE, "id", F.floor((F.col("place") - 1) / block).cast("int").alias("block")), "cluster-blocks")
    for side in ("i", "j"):
        links = links.join(placed.withColumnsRenamed({"id": side, "block": f"block_{side}"}), [*SCOPE, side])
    return stored(links, "cluster-links"), (placed.agg(F.max("block")).first()[0] or 0) + 1


def followers(near: DataFrame, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """scope..., id of the keys that follow, from the graph's edges (i, earlier j)."""
    found, links = [], near.select(*SCOPE, "i", "j")

    def settle(fresh: DataFrame, rest: DataFrame, links: DataFrame) -> DataFrame:
        found.append(stored(fresh, "cluster-followers"))
        left = stored(_without(rest, found[-1]), "cluster-links")
        if links is not near:
            discard(links)
        return left

    links = settle(_settled_at_once(links), links, near)
    for _ in range(rounds - 1):
        if links.isEmpty():
            break
        links = settle(_settled_at_once(links), links, links)
    if not links.isEmpty():
        links, n = _blocked(links, block)
        for k in range(n):
            # Earlier blocks are settled: what is left of this one depends on its inner links alone.
            inner = stored(_scanned(links.where((F.col("block_i") == k) & (F.col("block_j") == k))), "cluster-scanned")
            lead = links.where((F.col("block_j") == k) & (F.col("block_i") > k)).join(inner.withColumnRenamed("id", "j"), [*SCOPE, "j"], "left_anti")
            fresh = inner.unionByName(lead.select(*SCOPE, F.col("i").alias("id")).distinct())
            links = settle(fresh, links.where(F.col("block_j") > k), links)
            discard(inner)
    return reduce(DataFrame.unionByName, found)


def iterated(groups: DataFrame, num: ByBatch, den: ByBatch, lex: Lexicon = DEFAULT, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """tool, batch, group_rank, leader_rank by joins over the similarity graph."""
    near = stored(edges(groups, num, den, lex), "cluster-edges")
    follow = stored(followers(near, rounds, block), "cluster-followers")
    best = (
        near.join(follow.withColumnRenamed("id", "i"), [*SCOPE, "i"], "left_semi")
        .join(follow.withColumnRenamed("id", "j"), [*SCOPE, "j"], "left_anti")
        .groupBy(*SCOPE, F.col("i").alias("group_rank"))
        .agg((-F.max(F.struct("score", (-F.col("j")).alias("j")))["j"]).alias("leader_rank"))
    )
    return groups.join(best, [*SCOPE, "group_rank"], "left").select(*SCOPE, "group_rank", F.coalesce("leader_rank", "group_rank").alias("leader_rank"))


def local(groups: DataFrame, num: ByBatch, den: ByBatch, lex: Lexicon = DEFAULT) -> DataFrame:
    """tool, batch, group_rank, leader_rank by one scan a partition, with an inverted index of leaders."""
    opposites = {frozenset(p) for p in lex.never_merge}

    def scan(pdf):
        import pandas as pd

        pdf = pdf.sort_values("group_rank")
        least, whole = (n if isinstance(n, int) else n[pdf.batch.iloc[0]] for n in (num, den))
        by_word: dict[str, list[int]] = {}
        leaders: list[tuple[int, int, str | None]] = []  # rank, size, lead verb
        out = []
        for rank, key, lead in zip(pdf.group_rank, pdf.key, pdf.lead):
            shared: dict[int, int] = {}
            for w in key:
                for n in by_word.get(w, ()):
                    shared[n] = shared.get(n, 0) + 1
            best = None
            for n, inter in shared.items():
                r, size, verb = leaders[n]
                uni = len(key) + size - inter
                if whole * inter >= least * uni and not (lead and verb and frozenset((lead, verb)) in opposites):
                    found = (inter / uni, -r)
                    best = found if best is None or found > best else best
            if best is None:
                for w in key:
                    by_word.setdefault(w, []).append(len(leaders))
                leaders.append((rank, len(key), lead))
                out.append(rank)
            else:
                out.append(-best[1])
        return pd.DataFrame({"tool": pdf.tool, "batch": pdf.batch, "group_rank": pdf.group_rank, "leader_rank": out})

    return groups.select(*SCOPE, "group_rank", "key", "lead").groupBy(*SCOPE).applyInPandas(scan, "tool string, batch string, group_rank long, leader_rank long")


def leader_clusters(groups: DataFrame, num: ByBatch, den: ByBatch, lex: Lexicon = DEFAULT, max_local: int = MAX_LOCAL) -> DataFrame:
    """tool, batch, group_rank, leader_rank. ``groups`` has tool, batch, group_rank, key, lead."""
    sizes = groups.groupBy(*SCOPE).agg(F.count("*").alias("size"))
    large = sizes.where(F.col("size") > max_local).select(*SCOPE)
    if large.isEmpty():
        return local(groups, num, den, lex)
    small = local(groups.join(large, SCOPE, "left_anti"), num, den, lex)
    return small.unionByName(iterated(groups.join(large, SCOPE, "left_semi"), num, den, lex))


