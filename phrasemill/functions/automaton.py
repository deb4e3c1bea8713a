"""Large phrase lists: one pass of an Aho-Corasick automaton over a text, whatever the number of phrases.

A goto array (states by character class) and each state's phrases are built once on the driver, with the
failure links folded in (Aho and Corasick, "Efficient string matching", CACM 1975), and broadcast, so their
size is the lexicon's. The texts of an Arrow batch take their steps side by side in numpy. Lists of at most
``FEW`` phrases stay expressions on the JVM.

Null texts give null; empty phrases occur nowhere; of equal phrases all count.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..plans.ship import ship

FEW = 500


@dataclass(frozen=True)
class Automaton:
    """``row``/``keys``/``goto``: edges sorted by (state, class), looked up by bisection; ``fail``: the state of the longest proper suffix;
    ``ends``: the smallest phrase that ends in the state itself (or -1); ``up``: the next state on the failure path with a phrase (0: none)."""

    classes: np.ndarray
    keys: np.ndarray
    goto: np.ndarray
    fail: np.ndarray
    ends: np.ndarray
    up: np.ndarray

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The states after one more character each; those without an edge go along their failure links."""
        known = char < len(self.classes)
        cls = np.where(known, self.classes[np.where(known, char, 0)], -1)
        state, out = state.copy(), np.zeros(len(state), np.int64)
        live = np.flatnonzero(cls >= 0)
        while len(live):
            key = state[live] * WIDTH + cls[live]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            out[live[found]] = self.goto[at[found]]
            live = live[~found]
            live = live[state[live] > 0]
            state[live] = self.fail[state[live]]
        return out


#: Character classes at most: code points.
WIDTH = 1 << 21


def build(phrases: Iterable[str]) -> Automaton:
    edges: list[dict[int, int]] = [{}]
    ends, order = [-1], [0]
    for i, phrase in enumerate(phrases):
        at = 0
        for char in map(ord, phrase):
            if char not in edges[at]:
                edges[at][char] = len(edges)
                edges.append({})
                ends.append(-1)
            at = edges[at][char]
        if at and ends[at] < 0:
            ends[at] = i
    fail, up = [0] * len(edges), [0] * len(edges)
    for state in order:  # breadth first: links of shorter states are known
        for char, new in edges[state].items():
            order.append(new)
            link = fail[state]
            while link and char not in edges[link]:
                link = fail[link]
            fail[new] = edges[link].get(char, 0) if state else 0
            up[new] = fail[new] if ends[fail[new]] >= 0 else up[fail[new]]
    chars = sorted({c for e in edges for c in e})
    classes = np.full((chars[-1] if chars else 0) + 1, -1, np.int64)
    classes[chars] = np.arange(len(chars))
    flat = sorted((s * WIDTH + int(classes[c]), t) for s, e in enumerate(edges) for c, t in e.items()) or [(-1, 0)]
    keys, goto = np.array(flat, np.int64).T
    return Automaton(classes, keys, goto, np.array(fail, np.int64), np.array(ends, np.int64), np.array(up, np.int64))


def walk(auto: Automaton, texts: list[str]) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """(indices of texts, their states) after each character; longest first, so finished texts fall off the end."""
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    at = (np.cumsum(sizes) - sizes)[order]
    live = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), side="left")
    state = np.zeros(len(texts), np.int64)
    for i, n in enumerate(live.tolist()):
        state = auto.step(state[:n], codes[at[:n] + i])
        yield order[:n], state


def found(auto: Automaton, texts: list[str]) -> np.ndarray:
    """Whether each text holds a phrase."""
    out = np.zeros(len(texts), bool)
    for of, state in walk(auto, texts):
        out[of] |= (auto.ends[state] >= 0) | (auto.up[state] > 0)
    return out


def least_from(auto: Automaton, texts: list[str], start: np.ndarray, none: int) -> np.ndarray:
    """The smallest phrase number of at least ``start`` that each text holds, else ``none``."""
    out = np.full(len(texts), none, np.int64)
    for of, state in walk(auto, texts):
        while len(of):
            i = auto.ends[state]
            hit = (i >= start[of]) & (i < out[of])
            out[of[hit]] = i[hit]
            more = auto.up[state] > 0
            of, state = of[more], auto.up[state[more]]
    return out


def in_turn(auto: Automaton, pairs: list[tuple[str, str]], texts: list[str]) -> list[str]:
    """Pair after pair replaced everywhere, as a fold would: the next pair that counts is the first later one that the text now holds."""
    texts, start, open_ = list(texts), np.zeros(len(texts), np.int64), np.arange(len(texts))
    while len(open_):
        nxt = least_from(auto, [texts[i] for i in open_], start[open_], len(pairs))
        open_, nxt = open_[nxt < len(pairs)], nxt[nxt < len(pairs)]
        for i, n in zip(open_.tolist(), nxt.tolist()):
            texts[i] = texts[i].replace(*pairs[n])
        start[open_] = nxt + 1
    return texts


@lru_cache(maxsize=8)
def _sent(spark: SparkSession, phrases: tuple[str, ...]) -> Broadcast:
    ship(spark)
    return spark.sparkContext.broadcast(build(phrases))


def holds_any(c: Column, phrases: tuple[str, ...]) -> Column:
    auto = _sent(SparkSession.active(), phrases)

    @F.pandas_udf("boolean")
    def held(texts: pd.Series) -> pd.Series:
        null = texts.isna()
        return pd.Series(found(auto.value, texts.where(~null, "").tolist()), texts.index, dtype="object").where(~null, None)

    return held(c)


def replaced_in_turn(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """As a fold of ``replace`` over the pairs, each of which needs a phrase of its own."""
    if len({p for p, _ in pairs}) < len(pairs):
        raise ValueError("a phrase stands in the list twice")
    auto = _sent(SparkSession.active(), tuple(p for p, _ in pairs))

    @F.pandas_udf("string")
    def turned(texts: pd.Series) -> pd.Series:
        null = texts.isna()
        return pd.Series(in_turn(auto.value, pairs, texts.where(~null, "").tolist()), texts.index, dtype="object").where(~null, None)

    return turned(c)
