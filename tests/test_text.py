"""Scalar operators against values written by hand."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from phrasemill.functions import text as X
from phrasemill.functions.lexicon import DEFAULT


def test_lexicon_sizes():
    d = DEFAULT
    assert (len(d.stop_words), len(d.verbs), len(d.canonical_verbs), len(d.never_merge)) == (144, 287, 76, 14)
    assert [len(d.phrases(t)) for t in (d.verbs, d.objects)] == [20, 15]
    assert d.phrases(d.verbs)[0][0] == "bulk upload" and d.phrases(d.objects)[0][0] == "service level agreement"
    assert d.objects["chart"] == "chart" and d.verbs["upload"] == "import" and "we" not in d.stop_words


def check(spark, f, cases):
    df = spark.createDataFrame([(i, *c[:-1]) for i, c in enumerate(cases)], "i int, " + ", ".join(f"c{k} string" for k in range(len(cases[0]) - 1)))
    got = {r[0]: r[1] for r in df.select("i", f(*[F.col(c) for c in df.columns[1:]])).collect()}
    assert [got[i] for i in range(len(cases))] == [c[-1] for c in cases]


def test_strip_and_split(spark):
    check(spark, X.strip, [(" a b\x1c\n", "a b"), ("", ""), (None, None), (" ", "")])
    check(spark, lambda c: F.array_join(X.split_words(c), "|"), [("  a b\x1fc ", "a|b|c"), ("", "")])


def test_looks_like_keyword(spark):
    check(
        spark,
        X.cell_is_keyword,
        [("ab", False), ("Name", False), ("done", False), ("http request", False), ("<loc>x", False), ("**bold**", False), ("=A1+B1", False), ("12.5", False), ("a/b/c/d/e", False), ("x" * 201, False), ("x" * 200, True)]
        + [("True", True), ("#REF!", True), ("#N/A", False), ("é1é2é", True), ("ANTHROPIC_API_KEY=x", False), ("python3 run", False), ("pass 1", False)],
    )


def test_tool_name(spark):
    check(spark, X.tool_name, [("Jira - below 10", "Jira"), ("Jira - less than 10", "Jira"), ("Jira < 10", "Jira < 10"), ("Jira - < 10", "Jira"), ("Jira 10+", "Jira"), ("Notion (old)", "Notion"), ("(x)", ""), ("Mix of Tools", "Mix of Tools"), (" A - 10+ b", "A")])
    check(spark, X.is_low_volume, [("Jira - below 10", True), ("Jira <10", True), ("Jira - less than 10", False)])
    check(spark, X.is_skipped_tab, [("CleanX", True), ("Jira", False), ("PayPal (ignore)", True)])


def test_singular(spark):
    check(spark, X.singular, [("ties", "tie"), ("stories", "story"), ("cases", "cas"), ("uses", "use"), ("status", "status"), ("access", "access"), ("bus", "bus"), ("gas", "gas"), ("cards", "card"), ("buses", "bus")])


def test_keyword_key(spark):
    key = lambda k, t: X.key_string(X.keyword_key(k, t))
    check(
        spark,
        key,
        [
            ("how to add a card in Jira?", "Jira", "add issue"), ("create tickets", "x1", "create ticket"), ("create ticket", "x1", "create issue"), ("add plan", "x1", "add schedule"),
            ("connector", "x1", "integration"), ("integration", "x1", "integrate"), ("reset upload", "x1", "recreateload"), ("set  up board", "x1", "board configure"),
            ("notion how can we add row", "notion", "add row we"), ("how can we add row", "notion", "add row"), ("Node.js Pro nodejs pro table", "node.js pro", "table"), ("hard reset row", "r", "eset ha ow"),
            ("anything", "", ""), ("use the", "x1", ""), (None, "x1", None), ("get rid of user story cards", "x1", "card remove story"), ("single sign-on", "x1", "sso"),
        ],
    )


def test_title_key(spark):
    check(spark, lambda c: X.key_string(X.title_key(c)), [("How to Add Columns in Notion?", "add column in notion"), ("How do I", "how do i".replace("how do i", "") or None), ("Delete a  file", "file remove"), (None, None)])


def test_labels(spark):
    check(spark, X.category, [("Connect x", "integration"), ("how do i", "howto"), ("a Tutorial", "tutorial"), ("x", "other"), ("synced", "integration")])
    check(spark, X.is_irrelevant, [("How to use JIRA ", "Jira", True), ("jira vs trello", "Jira", True), ("he does it", "Jira", True), ("add row", "Jira", False), ("a tutorial español", "x", True)])
    check(spark, X.suggested_title, [("how to  add $5 in JIRA", "Ji$ra", "How to add $5 in JIRA"), ("how to add in c++ now", "C++", "How to add in C++ now"), ("add x", "X", "add x"), ("How To go", "g\\o", "How To go")])
    check(spark, X.safe_name, [("C++ tools", "C_tools"), (" a/b: c.d-e ", "ab_c.d-e"), ("é ü", "é_ü")])
    check(spark, X.without_fence, [("```json\n[1]\n```", "[1]"), (" [1] ", "[1]")])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abs e?-' the")), max_size=25), min_size=20, max_size=20))
def test_keys_are_sorted_sets(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "k string").select(X.keyword_key(F.col("k"), F.lit("zz")).alias("key"))
    for r in df.collect():
        assert r.key == sorted(set(r.key)) and all(len(w) > 1 or w for w in r.key)


@pytest.mark.parametrize("word", ["upload", "nothing", "set up"])
def test_lookup(spark, word):
    assert spark.range(1).select(X.lookup(DEFAULT.verbs, F.lit(word))).collect()[0][0] == DEFAULT.verbs.get(word, word)
