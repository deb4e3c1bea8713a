"""Set-similarity joins over token arrays: Jaccard with prefix and position filters.

Two sets with Jaccard >= num/den share a token among the first |k| - ceil(|k| num/den) + 1 tokens of
either, if tokens are ordered by one global order (here rarest first, ties by token). Joining
those prefixes by equality finds every candidate. A pair that shares several prefix tokens counts where the
first of them meet, so no pair has to be deduplicated; from the two places of that token follows how
large the overlap can still become (Xiao, Wang, Lin and Yu, "Efficient similarity joins for near
duplicate detection", WWW 2008). Only what passes is compared whole, in integers.

A token that many keys share makes one long posting list. With ``posting`` each list of more than so many
keys is cut into blocks and every pair of blocks is a join key of its own, so no task meets more than a
block of either side for it; no pair is lost or found twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A part of a threshold: a number, or a Column over the scope's columns.
Part = int | Column

#: Keys of a token that one join key holds, of either side, where posting lists are cut.
POSTING = 10_000


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def at_least(a: Column, b: Column, num: int, den: int) -> Column:
    """Jaccard(a, b) >= num/den in integers; false if either is empty."""
    i = overlap(a, b)
    return (i > 0) & (den * i >= num * (F.size(a) + F.size(b) - i))


def prefixes(df: DataFrame, key: str, scope: list[str], num: Part, den: Part, order: DataFrame, freq: bool = False) -> DataFrame:
    """``df`` exploded to its prefix tokens: columns token, pos (from 0) and prefix (all of them, in order), with ``freq`` the token's too. ``order``: scope..., token, freq."""
    rid = [c for c in df.columns if c != key]
    words = df.select("*", F.explode(key).alias("token")).join(order, [*scope, "token"], "left")
    ranked = words.groupBy(*rid, key).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "token"))).alias("_t"))
    need = F.size(key) - F.ceil(F.size(key) * num / den).cast("int") + 1
    kept = [*rid, key, "_t"] if freq else [*rid, key]
    found = ranked.withColumn("prefix", F.slice("_t.token", F.lit(1), need)).select(*kept, "prefix", F.posexplode("prefix").alias("pos", "token"))
    return found.withColumn("freq", F.get("_t.freq", F.col("pos"))).drop("_t") if freq else found


def postings(df: DataFrame, side: str, posting: int) -> DataFrame:
    """Rows of one side (l or r) with l_block and r_block: its own block of the token's list, beside each block of the other side's."""
    blocks = F.greatest(F.ceil(F.col("freq") / posting), F.lit(1).cast("long"))
    own, other = ("l_block", "r_block") if side == "l" else ("r_block", "l_block")
    mine = df.withColumn(own, F.pmod(F.xxhash64(f"{side}_id"), blocks)).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return mine.drop("freq")


def frequencies(df: DataFrame, key: str, scope: list[str]) -> DataFrame:
    return df.select(*scope, F.explode(key).alias("token")).groupBy(*scope, "token").agg(F.count("*").alias("freq"))


def candidates(left: DataFrame, right: DataFrame, scope: list[str], num: Part, den: Part, extra: Column | None = None, long_keys: bool = False, posting: int | None = None) -> DataFrame:
    """scope..., l_id, l_key, r_id, r_key: each pair that the filters leave, once. ``posting``: where posting lists are cut (None: nowhere).

    Short keys travel with their tokens, so one shuffle does, and a pair is taken where its first common token meets. With ``long_keys``
    only ids, sizes and places travel; pairs are then made distinct and get their keys by two joins.
    """
    order = frequencies(left.select(*scope, "key").unionByName(right.select(*scope, "key")), "key", scope)
    wide = ("id", "n", "pos") if long_keys else ("id", "n", "pos", "key", "prefix")

    def side(df: DataFrame, s: str) -> DataFrame:
        rows = prefixes(df.select(*scope, "id", "key"), "key", scope, num, den, order, freq=posting is not None).withColumn("n", F.size("key"))
        own = [F.col(c).alias(f"{s}_{c}") for c in wide]
        return rows.select(*scope, "token", *own) if posting is None else postings(rows.select(*scope, "token", "freq", *own), s, posting)

    n_l, n_r = F.col("l_n"), F.col("r_n")
    sizes = (den * n_l >= num * n_r) & (den * n_r >= num * n_l)
    # At a pair's first common token, no more than what stands from there on can be common.
    room = (num + den) * F.least(n_l - F.col("l_pos"), n_r - F.col("r_pos")) >= num * (n_l + n_r)
    blocks = [] if posting is None else ["l_block", "r_block"]
    found = side(left, "l").join(side(right, "r"), [*scope, "token", *blocks]).where(sizes & room)
    if extra is not None:
        found = found.where(extra)
    if not long_keys:
        first = F.get(F.array_intersect("l_prefix", "r_prefix"), F.lit(0)) == F.col("token")
        return found.where(first).select(*scope, "l_id", "l_key", "r_id", "r_key")
    pairs = found.select(*scope, "l_id", "r_id").distinct()
    for s, df in (("l", left), ("r", right)):
        pairs = pairs.join(df.select(*scope, F.col("id").alias(f"{s}_id"), F.col("key").alias(f"{s}_key")), [*scope, f"{s}_id"])
    return pairs.select(*scope, "l_id", "l_key", "r_id", "r_key")


def similar_pairs(left: DataFrame, right: DataFrame, scope: list[str], num: Part, den: Part, extra: Column | None = None, long_keys: bool = False, posting: int | None = None) -> DataFrame:
    """Pairs with Jaccard >= num/den: scope..., l_id, r_id, inter, uni.

    Both sides have scope..., ``id`` and ``key``; an id has one key. ``extra`` is a further condition over l_id and r_id. ``long_keys``, ``posting``: see ``candidates``.
    """
    return (
        candidates(left, right, scope, num, den, extra, long_keys, posting)
        .withColumn("inter", overlap(F.col("l_key"), F.col("r_key")))
        .withColumn("uni", F.size("l_key") + F.size("r_key") - F.col("inter"))
        .where(den * F.col("inter") >= num * F.col("uni"))
        .select(*scope, "l_id", "r_id", "inter", "uni")
    )


def similar_ids(left: DataFrame, right: DataFrame, scope: list[str], num: Part, den: Part) -> DataFrame:
    """scope..., id of left rows with a similar right row (a semi join on ids)."""
    return similar_pairs(left, right, scope, num, den, posting=POSTING).select(*scope, F.col("l_id").alias("id")).distinct()
