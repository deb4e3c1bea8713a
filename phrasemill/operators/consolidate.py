"""Grouping, coverage, ranking: everything between keys and result rows.

``tool`` and ``batch`` are columns, so all tools run in one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import DEFAULT, Lexicon
from ..plans.storage import stored
from .ranks import numbered
from .setsim import similar_ids

SCOPE = ["tool", "batch"]
#: Thresholds as fractions, so that comparison is exact.
STD_THRESHOLD, LOW_THRESHOLD, COVERED, CROSS = (7, 10), (13, 20), (4, 5), (3, 4)
MIN_STD, MIN_FREQ = 2, 6
SHOWN = 15
CHUNK = 25


def marked(keywords: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """``keywords`` with relevant: whether the keyword is about more than its tool's name."""
    return keywords.withColumn("relevant", ~X.is_irrelevant(F.col("keyword"), F.col("tool"), lex))


def relevant(keywords: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    return keywords.where(~X.is_irrelevant(F.col("keyword"), F.col("tool"), lex))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed where it stands, once a row.

    A filter on a plain projection is pushed below it (and below a distinct), with a second copy of the expression;
    it can't pass the row that inline makes.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def keyed(keywords: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """``keywords`` with key and key_str; keyless rows go. Each distinct (tool, keyword) is normalized once."""
    distinct = keywords.select("tool", "keyword").distinct()
    keys = _once(distinct, "key", X.keyword_key(F.col("keyword"), F.col("tool"), lex)).where("size(key) > 0")
    return keywords.join(keys, ["tool", "keyword"]).withColumn("key_str", X.key_string(F.col("key")))


def intent_groups(rows: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """One row a key: n, first_pos, group_rank (larger first, then earlier), lead. Members stay in ``rows``."""
    groups = rows.groupBy(*SCOPE, "key_str").agg(F.first("key").alias("key"), F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    ranked_groups = numbered(groups, SCOPE, [(-F.col("n")).alias("o1"), F.col("first_pos").alias("o2")], "group_rank")
    return ranked_groups.withColumn("lead", X.lead_verb(F.col("key"), lex))


def title_index(titles: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """key_str, key, n_titles of the published titles that have a key."""
    keys = _once(titles, "key", X.title_key(F.col("title"), lex)).where("key is not null")
    return keys.groupBy(X.key_string(F.col("key")).alias("key_str")).agg(F.first("key").alias("key"), F.count("*").alias("n_titles"))


def covered_exact(groups: DataFrame, index: DataFrame) -> DataFrame:
    return groups.join(index.select("key_str"), "key_str", "left_semi")


def covered(groups: DataFrame, index: DataFrame) -> DataFrame:
    """key_str of groups that equal or resemble (Jaccard 4/5) a published key. An equal key has Jaccard 1.

    Keys are compared once, whatever tools and batches hold them.
    """
    left = groups.select(F.col("key_str").alias("id"), "key").distinct()
    right = index.select(F.col("key_str").alias("id"), "key")
    return similar_ids(left, right, [], *COVERED).withColumnRenamed("id", "key_str")


def uncovered(groups: DataFrame, index: DataFrame) -> DataFrame:
    return groups.join(covered(groups, index), "key_str", "left_anti")


def canonical_tier(keyword: Column) -> Column:
    """0 how-to with an article, 1 how-to, 2 integration, 3 other."""
    c = F.lower(keyword)
    howto = c.startswith("how to")
    return F.when(howto & (c.contains(" a ") | c.contains(" an ")), 0).when(howto, 1).when(c.contains("integration"), 2).otherwise(3)


def canonical(keyword: Column, *order: Column) -> Column:
    """Aggregate: the shortest keyword of the best tier, the earliest of equals."""
    return F.min(F.struct(canonical_tier(keyword).alias("tier"), F.length(keyword).alias("n"), *order, keyword.alias("kw")))["kw"]


def first_variants(keyword: Column, *order: Column, shown: int = SHOWN) -> Column:
    """Aggregate: the first keywords in order, joined by " | "."""
    members = F.array_sort(F.collect_list(F.struct(*order, keyword.alias("kw"))))
    return F.array_join(F.transform(F.slice(members, 1, shown), lambda m: m["kw"]), " | ")


def shown_variants(members: DataFrame, by: list[str], order: list[str], shown: int = SHOWN) -> DataFrame:
    """by..., all_variants: the first keywords of each group. Ranks come first (each task keeps ``shown`` a group before the shuffle), so no group is collected whole."""
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    first = members.withColumn("place", place).where(F.col("place") <= shown)
    return first.groupBy(*by).agg(first_variants(F.col("keyword"), *map(F.col, order), shown=shown).alias("all_variants"))


def led(groups: DataFrame, clusters: DataFrame, index: DataFrame) -> DataFrame:
    """One row a cluster: tool, batch, leader_rank, n_groups, size (keywords), covered (whether a title covers its leader's key)."""
    of_group = groups.join(clusters, [*SCOPE, "group_rank"])
    heads = of_group.where("group_rank = leader_rank").select(*SCOPE, "leader_rank", "key_str", "key")
    found = covered(heads, index).withColumn("covered", F.lit(True))
    marked = heads.join(found, "key_str", "left").select(*SCOPE, "leader_rank", F.coalesce("covered", F.lit(False)).alias("covered"))
    sizes = of_group.groupBy(*SCOPE, "leader_rank").agg(F.count("*").alias("n_groups"), F.sum("n").alias("size"))
    return sizes.join(marked, [*SCOPE, "leader_rank"])


def qualifying(leaders: DataFrame, minimum: Column) -> DataFrame:
    """Leaders of clusters that are large enough and not covered."""
    return leaders.where((F.col("size") >= minimum) & ~F.col("covered"))


def cluster_rows(rows: DataFrame, groups: DataFrame, clusters: DataFrame, kept: DataFrame) -> DataFrame:
    """One row a surviving cluster: tool, batch, leader_rank, n, canonical_keyword, all_variants.

    Sizes and coverage are known from ``kept``, so members of clusters that go are never gathered.
    Variants: at most ``SHOWN`` members a cluster are collected.
    """
    of_group = groups.join(clusters, [*SCOPE, "group_rank"]).select(*SCOPE, "group_rank", "key_str", "leader_rank")
    wanted = of_group.join(kept.select(*SCOPE, "leader_rank", "size"), [*SCOPE, "leader_rank"])
    members = rows.join(wanted, [*SCOPE, "key_str"]).select(*SCOPE, "leader_rank", "group_rank", "pos", "keyword", "size")
    at = [F.col("group_rank"), F.col("pos")]
    shown = shown_variants(members, [*SCOPE, "leader_rank"], ["group_rank", "pos"])
    best = members.groupBy(*SCOPE, "leader_rank").agg(F.max("size").alias("n"), canonical(F.col("keyword"), *at).alias("canonical_keyword"))
    return best.join(shown, [*SCOPE, "leader_rank"])


def results(c: DataFrame) -> DataFrame:
    """Report rows of clusters; strength, source and frequency are a batch's own."""
    standard = F.col("batch") == "standard"
    return c.select(
        "tool", "batch", "leader_rank", "canonical_keyword",
        X.category(F.col("canonical_keyword")).alias("category"),
        F.col("n").alias("variant_count"), F.when(standard, X.signal(F.col("n"))).otherwise("frequency").alias("signal_strength"),
        F.when(standard, "volume_10+").otherwise("frequency_matched").alias("source"),
        F.when(standard, "").otherwise(F.col("n").cast("string")).alias("frequency_count"), "all_variants",
    )


def cross_dedup(results: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """Without low-volume rows that resemble (Jaccard 3/4) a standard row of their tool, by the keys of canonical keywords."""
    keys = results.select("tool", "batch", F.col("leader_rank").alias("id"), X.keyword_key(F.col("canonical_keyword"), F.col("tool"), lex).alias("key"))
    keys = stored(keys, "result-keys")  # read four times below; the key expression runs once
    low, std = (keys.where(F.col("batch") == b).select("tool", "id", "key") for b in ("low_volume", "standard"))
    drop = similar_ids(low, std, ["tool"], *CROSS).select("tool", F.lit("low_volume").alias("batch"), F.col("id").alias("leader_rank"))
    return results.join(drop, ["tool", "batch", "leader_rank"], "left_anti")


def ranked(results: DataFrame) -> DataFrame:
    """``results`` with final_rank in its tool: larger first, category, standard before low volume, leader rank."""
    order = [(-F.col("variant_count")).alias("o1"), F.col("category").alias("o2"), F.when(F.col("batch") == "standard", 0).otherwise(1).alias("o3"), F.col("leader_rank").alias("o4")]
    return numbered(results, ["tool"], order, "final_rank")


def cross_tool_duplicates(results: DataFrame) -> DataFrame:
    """``results`` with cross_tool_dup: the first tool (in name order) that has the same canonical keyword, if it's another."""
    same = X.strip(F.lower("canonical_keyword"))
    first = results.groupBy(same.alias("_k")).agg(F.min("tool").alias("_owner"))
    return results.withColumn("_k", same).join(first, "_k").withColumn("cross_tool_dup", F.when(F.col("_owner") != F.col("tool"), F.col("_owner"))).drop("_k", "_owner")


def chunked(results: DataFrame, size: int = CHUNK) -> DataFrame:
    """``results`` with chunk and idx_in_chunk by final_rank."""
    at = F.col("final_rank") - 1
    return results.withColumn("chunk", F.floor(at / size)).withColumn("idx_in_chunk", at % size)


def apply_fixes(results: DataFrame, fixes: DataFrame) -> DataFrame:
    """Apply enrichment records (tool, idx, fixed_title, irrelevant, duplicate_of); idx counts a tool's rows from 0.

    The last record of an index counts (largest title); flagged rows go, titles replace keywords.
    """
    idx = F.col("final_rank") - 1
    one = fixes.groupBy("tool", "idx").agg(F.max("fixed_title").alias("fixed_title"), F.bool_or(F.coalesce("irrelevant", F.lit(False)) | F.col("duplicate_of").isNotNull()).alias("gone"))
    joined = results.withColumn("idx", idx).join(one, ["tool", "idx"], "left").where(~F.coalesce("gone", F.lit(False)))
    title = F.when(F.length("fixed_title") > 0, F.col("fixed_title"))
    return joined.withColumn("canonical_keyword", F.coalesce(title, "canonical_keyword")).drop("idx", "fixed_title", "gone")


def summary(results: DataFrame) -> DataFrame:
    """Rows a tool and by source, and a total (tool null)."""
    return results.rollup("tool").agg(
        F.count("*").alias("n_keywords"), F.count_if(F.col("source") == "volume_10+").alias("n_volume"), F.count_if(F.col("source") == "frequency_matched").alias("n_frequency")
    )
