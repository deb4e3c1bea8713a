"""The whole job as one DataFrame graph over all tools."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import DEFAULT, Lexicon
from ..operators import cluster as C
from ..operators import consolidate as O
from .storage import Scope, stored


@dataclass(frozen=True)
class Settings:
    std_threshold: tuple[int, int] = O.STD_THRESHOLD
    low_threshold: tuple[int, int] = O.LOW_THRESHOLD
    min_std: int = O.MIN_STD
    min_freq: int = O.MIN_FREQ
    max_local: int = C.MAX_LOCAL
    lexicon: Lexicon = DEFAULT


class Consolidation:
    """Named steps from ``keywords(tool, batch, pos, keyword)`` and ``titles(title_pos, title)``.

    Both batches go through one plan; thresholds and least sizes depend on the batch column. Steps that several others read
    are stored once. ``close`` (or the end of a ``with`` block) deletes all that the job has stored, so results must be
    written, or collected, before.
    """

    def __init__(self, keywords: DataFrame, titles: DataFrame, settings: Settings | None = None):
        self.keywords, self.titles, self.s = keywords, titles, settings or Settings()
        self.scope = Scope(keywords.sparkSession)
        self._made: dict[str, DataFrame] = {}

    def __enter__(self) -> Consolidation:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        self._made.clear()
        self.scope.close()

    def _once(self, label: str, make: Callable[[], DataFrame]) -> DataFrame:
        if label not in self._made:
            with self.scope.open():
                self._made[label] = stored(make(), label)
        return self._made[label]

    def _by_batch(self, standard: int, low: int) -> dict[str, int]:
        return {"standard": standard, "low_volume": low}

    def marked(self) -> DataFrame:
        """All keywords with ``relevant``. Stored, since keys are made of the distinct keywords and joined back, and the report counts all: the source is read once."""
        return self._once("marked", lambda: O.marked(self.keywords, self.s.lexicon))

    def relevant(self) -> DataFrame:
        return self.marked().where("relevant").drop("relevant")

    def rows(self) -> DataFrame:
        """Relevant keywords with their keys."""
        return self._once("keyed", lambda: O.keyed(self.relevant(), self.s.lexicon))

    def groups(self) -> DataFrame:
        return self._once("groups", lambda: O.intent_groups(self.rows(), self.s.lexicon))

    def index(self) -> DataFrame:
        return self._once("title-index", lambda: O.title_index(self.titles, self.s.lexicon))

    def clusters(self) -> DataFrame:
        (a, b), (c, d) = self.s.std_threshold, self.s.low_threshold
        return self._once("clusters", lambda: C.leader_clusters(self.groups(), self._by_batch(a, c), self._by_batch(b, d), self.s.lexicon, self.s.max_local))

    def leaders(self) -> DataFrame:
        """One row a cluster, with its size and whether a title covers it."""
        return self._once("leaders", lambda: O.led(self.groups(), self.clusters(), self.index()))

    def results(self) -> DataFrame:
        def made() -> DataFrame:
            minimum = C.of_batch(self._by_batch(self.s.min_std, self.s.min_freq))
            return O.results(O.cluster_rows(self.rows(), self.groups(), self.clusters(), O.qualifying(self.leaders(), minimum)))

        return self._once("results", made)

    def combined(self) -> DataFrame:
        return self._once("combined", lambda: O.cross_dedup(self.results(), self.s.lexicon))

    def final(self) -> DataFrame:
        with self.scope.open():
            ranked = O.ranked(self.combined())
        return ranked.withColumn("suggested_title", X.suggested_title(F.col("canonical_keyword"), F.col("tool")))

    def stage_counts(self) -> DataFrame:
        """tool, batch, stage, n: the run report as a table, from what is stored. ``covered`` are clusters that a title covers, ``results`` those that qualify."""

        def count(df: DataFrame, *stages: tuple[str, Column]) -> DataFrame:
            """A row a stage that has any."""
            named = F.array(*(F.struct(F.lit(s).alias("stage"), n.alias("n")) for s, n in stages))
            return df.groupBy("tool", "batch").agg(named.alias("_s")).select("tool", "batch", F.inline("_s")).where("n > 0")

        every = F.count("*")
        steps = [(self.marked(), ("raw", every), ("relevant", F.count_if("relevant"))), (self.groups(), ("groups", every))]
        steps += [(self.leaders(), ("clusters", every), ("covered", F.count_if("covered"))), (self.results(), ("results", every)), (self.combined(), ("kept", every))]
        return reduce(DataFrame.unionByName, (count(*s) for s in steps))

    def title_counts(self) -> DataFrame:
        """stage, n: published titles and the distinct keys they have."""
        return self.titles.agg(F.count("*").alias("n")).select(F.lit("titles").alias("stage"), "n").unionByName(self.index().agg(F.count("*").alias("n")).select(F.lit("title keys").alias("stage"), "n"))
