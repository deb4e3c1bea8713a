"""Source divergence against plain arithmetic and the query's SQL."""

import re
from collections import Counter

import numpy as np
import pytest

from phrasemill.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SCHEMA = "doc_id long, text string, lang string, source string"


def slow(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, ts in mine for t in set(ts))
        kept = sorted(t for t, n in held.items() if n >= min_docs)
        counts = {s: Counter() for _, s, _ in mine}
        for _, s, ts in mine:
            counts[s].update(t for t in ts if held[t] >= min_docs)
        whole = sum(counts.values(), Counter())

        def p(c, t, v=len(kept)):
            return 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + v)

        for s, c in counts.items():
            pairs = [(o, sum((p(c, t) - p(d, t)) ** 2 // p(d, t) for t in kept)) for o, d in counts.items() if o != s]
            terms = [(t, (p(c, t) - p(whole, t)) ** 2 // p(whole, t)) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def run(spark, rows, **k):
    return sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA), **k).collect())


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    words = ["Alpha", "beta", "gÄmma", "δ", "été", "ZULU", "x", "the"] + [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = []
    for i in range(400):
        n = int(rng.choice([0, 1, 5, 60]))
        w = rng.choice(words, n, p=np.array([1 / (k + 1) for k in range(len(words))]) / sum(1 / (k + 1) for k in range(len(words))))
        rows.append((i, "  ".join(w) + "; 12_" * (n % 3), ["en", "fr", None][i % 3], f"s{int(rng.zipf(1.3)) % 40}"))
    return rows + [(400, None, "xx", "only"), (401, "lonely words here", "yy", None), (402, "", "yy", "b"), (402, "", "yy", "b")]


@pytest.mark.parametrize("block, chunk", [(16, 4096), (3, 8), (64, 16)])
def test_audit_equals_plain_arithmetic(spark, corpus, monkeypatch, block, chunk):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK_TERMS", chunk)
    monkeypatch.setattr(divergence, "STRIPE", 2)
    assert run(spark, corpus) == slow(corpus)


def test_other_thresholds(spark, corpus):
    assert run(spark, corpus, min_docs=1, top=3) == slow(corpus, 1, 3)


def test_small_blocks_of_text_give_the_same(spark, corpus, monkeypatch):
    docs = spark.createDataFrame(corpus, SCHEMA)
    whole = {tuple(r)[:3]: (r.tf, r.df) for r in divergence.kept_counts(docs, 1).selectExpr("lang", "source", "term", "tf", "total as df").collect()}
    monkeypatch.setattr(divergence, "COUNT_BYTES", 200)
    assert whole == {tuple(r)[:3]: (r.tf, r.df) for r in divergence.kept_counts(docs, 1).selectExpr("lang", "source", "term", "tf", "total as df").collect()}


def test_packing_in_parts_keeps_every_count(spark, corpus):
    counts = divergence.kept_counts(spark.createDataFrame(corpus, SCHEMA), 1)
    got = Counter()
    for r in divergence.packed(counts, 3).collect():
        t, c = np.frombuffer(r.terms, "<u4"), np.frombuffer(r.counts, "<i8")
        assert len(t) == len(c) == len(set(t.tolist()))
        got[r.lang, r.source] += int(c.sum())
    assert got == Counter({(r.lang, r.source): r.n for r in counts.groupBy("lang", "source").agg({"tf": "sum"}).toDF("lang", "source", "n").collect()})


def test_shares_of_counts_beyond_64_bits(spark):
    big = np.array([0, 9_223_372_034, 9_223_372_035, 10**12, 10**15], np.int64)
    want = [1 + 10**9 * (int(c) + 1) // (3 * 10**15 + 7) for c in big]
    assert divergence.shares(big, 3 * 10**15, 7).tolist() == want
    df = spark.createDataFrame([(int(c), 3 * 10**15, 7) for c in big], "c long, n long, v long")
    from pyspark.sql import functions as F

    assert sorted(r[0] for r in df.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).collect()) == sorted(want)


def test_empty_table_clashing_names_and_join_beyond_the_broadcast(spark, corpus, monkeypatch):
    assert run(spark, []) == []
    monkeypatch.setattr(divergence, "MAX_BROADCAST", 0)
    docs = spark.createDataFrame(corpus, SCHEMA).selectExpr("*", "'x' as term", "1 as tf", "2 as block", "3 as value", "4 as rank")
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == slow(corpus)
