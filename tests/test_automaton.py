"""Large lexicons: the automaton against plain containment and plain folds."""

from functools import reduce

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from phrasemill.functions import automaton
from phrasemill.functions import text as X
from phrasemill.functions.lexicon import DEFAULT, IRRELEVANT_PATTERNS, Lexicon
from phrasemill.operators import consolidate

SHORT = st.text("ab \u00e9\U0001f600", max_size=4)


@given(st.lists(SHORT, max_size=8, unique=True), st.lists(st.text("ab \u00e9\U0001f600x", max_size=12), max_size=6))
def test_automaton_equals_containment(phrases, texts):
    auto = automaton.build(phrases)
    assert automaton.found(auto, texts).tolist() == [any(p and p in t for p in phrases) for t in texts]


@given(st.lists(st.tuples(SHORT, SHORT), max_size=8, unique_by=lambda p: p[0]), st.lists(st.text("ab \u00e9", max_size=12), max_size=6))
def test_replacing_in_turn_equals_a_fold(pairs, texts):
    auto = automaton.build([p for p, _ in pairs])
    assert automaton.in_turn(auto, pairs, texts) == [reduce(lambda t, p: t.replace(*p) if p[0] else t, pairs, t) for t in texts]


def large() -> Lexicon:
    """The default lexicon and many entries made by rule, which change no text of the test."""
    verbs = {**DEFAULT.verbs, **{f"zz{i} yy{i}": f"zz{i}" for i in range(5000)}}
    return Lexicon(verbs=verbs, irrelevant=(*IRRELEVANT_PATTERNS, *(f"no such phrase {i}" for i in range(50_000))))


def test_large_lexicons_give_the_same_rows(spark):
    """Keys and relevance by automata equal those of the expressions; an entry beyond ``FEW`` counts."""
    rows = [(i, w, "Jira") for i, w in enumerate(["How to get rid of jira issues", "tutorial pdf jira", "set up a user story", "jira vs trello", "", None, "add \u00e9t\u00e9 ticket", "turn off sub-task", "add zz4999 yy4999 row", "see no such phrase 49999"])]
    df = spark.createDataFrame(rows, "pos int, keyword string, tool string")
    lex = large()
    got, want = (df.select("pos", X.is_irrelevant(F.col("keyword"), F.col("tool"), x).alias("gone")).orderBy("pos").collect() for x in (lex, DEFAULT))
    assert got[:9] == want[:9] and got[9].gone and not want[9].gone
    got, want = ({r.pos: r.key for r in consolidate.keyed(df, x).collect()} for x in (lex, DEFAULT))
    assert {k: v for k, v in got.items() if k != 8} == {k: v for k, v in want.items() if k != 8}
    assert "zz4999" in got[8] and "yy4999" not in got[8] and "yy4999" in want[8]


def test_states_grow_with_the_phrases_alone():
    phrases = [f"phrase {i}" for i in range(50_000)]
    auto = automaton.build(phrases)
    assert len(auto.fail) == len(auto.goto) + 1 and len(auto.ends[auto.ends >= 0]) == len(phrases)
    assert automaton.least_from(auto, ["a phrase 49999 and phrase 12"], np.array([13]), 50_000).tolist() == [49]
