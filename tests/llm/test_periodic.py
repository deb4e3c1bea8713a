"""Runs against a quadratic search, and the query's columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from phrasemill.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(w, min_exponent=4, min_length=6):
    """(start, length, period) by trying every period at every place."""
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i >= p:
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items() if n >= max(min_length, min_exponent * p)), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c"]), max_size=40), max_size=6), st.sampled_from([(4, 6), (2, 2), (3, 1)]))
def test_runs_of_small_alphabets(docs, least):
    got = periodic.runs_of([" ".join(w).encode() for w in docs], *least)
    assert [r for _, r, _ in got] == [slow(w, *least) for w in docs]


def test_long_periods_nested_runs_and_fibonacci_words():
    a, b = ["x"], ["x", "y"]
    while len(b) < 2000:
        a, b = b, b + a
    rng = random.Random(2)
    base = [str(rng.randrange(50)) for _ in range(150)]
    nested = (["p", "p", "p", "p", "p", "p", "q"] * 5 + ["z"]) * 6
    docs = [b, base * 7 + base[:31], nested, ["one"] * 1500, base + nested * 3]
    got = periodic.runs_of([" ".join(w).encode() for w in docs], 2, 2)
    assert [r for _, r, _ in got] == [slow(w, 2, 2) for w in docs]


def test_range_minima_and_next_values():
    rng = np.random.default_rng(1)
    for n in (1, 2, 15, 16, 17, 100, 1000):
        v = rng.integers(0, 50, n)
        a = rng.integers(0, n, 200)
        b = np.array([rng.integers(x + 1, n + 1) for x in a])
        assert periodic.RangeMin(v)(a, b).tolist() == [int(v[x:y].min()) for x, y in zip(a, b)]
        r = rng.permutation(n)
        for smaller in (True, False):
            want = [next((j for j in range(i + 1, n) if (r[j] < r[i]) == smaller), n) for i in range(n)]
            assert periodic.next_beyond(r, smaller).tolist() == want
    falling = np.arange(5000)[::-1].copy()
    assert periodic.next_beyond(falling, False).tolist() == [5000] * 5000


def test_suffix_and_lcp_arrays():
    rng = np.random.default_rng(3)
    for k in (1, 2, 5, 3000):
        docs = [list(rng.integers(1, k + 1, int(rng.integers(0, 30)))) + [0] for _ in range(6)]
        symbols, doc = np.array(sum(docs, []), np.int64), np.repeat(np.arange(6), [len(d) for d in docs])
        order, rank = periodic.suffix_array(symbols, doc, k)
        suffixes = sorted((d, docs[d][i:], i) for d in range(6) for i in range(len(docs[d])))
        first = np.cumsum([0] + [len(d) for d in docs])
        assert order.tolist() == [first[d] + i for d, _, i in suffixes] and rank[order].tolist() == list(range(len(order)))
        lcp = periodic.lcp_array(symbols, order).tolist()
        for i in range(1, len(order)):
            (d, x, _), (e, y, _) = suffixes[i - 1], suffixes[i]
            if d == e:
                assert lcp[i] == next((n for n, (p, q) in enumerate(zip(x, y)) if p != q or p == 0), min(len(x), len(y)))


def expected(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = slow(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    kept = [x for i, x in enumerate(w) if not any(s + p <= i < s + m for s, m, p in runs)]
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest(),
    )


def test_query_on_awkward_rows(spark):
    rng = random.Random(7)
    texts = [None, "", " \t\r\n ", "one", "é\x85é é \x1c\x1c", "a a a a a a b b b b b b", "x " * 9, "\x0bu\x0c v\tu\nv\ru v u v"]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(80))) for _ in range(300)]
    rows = list(enumerate(texts)) * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "'x' as collapsed")
    got = periodic.digest(periodic.find_runs(periodic.planted(df)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    assert periodic.find_runs(df.where("false")).count() == 0
    assert periodic.planted(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).first().text == "a b"


def test_general_interface(spark):
    df = spark.createDataFrame([("k", "go go stop a b a b")], "doc_id string, text string")
    row = periodic.find_runs(df, min_exponent=2, min_length=2).first()
    assert (row.doc_id, row.n_words, [tuple(r) for r in row.runs], row.collapsed) == ("k", 7, [(0, 2, 1), (3, 4, 2)], "go stop a b")
    with pytest.raises(ValueError):
        periodic.find_runs(df, min_exponent=1)


def test_a_long_text_without_end_of_repeats():
    n, runs, kept = periodic.runs_of([b"ab cd " * 300_000 + b"end"])[0]
    assert n == 600_001 and runs == [(0, 600_000, 2)] and kept == b"ab cd end"
