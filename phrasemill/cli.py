"""``python -m phrasemill.cli --xlsx BOOK --cms TITLES``: workbook and published titles in, one CSV file a tool out."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import consolidate as O
from .operators.enrich import ChatService, api_key, enrich
from .plans.consolidation import Consolidation, Settings
from .plans.storage import Scope, stored
from .sources.keywords import all_keywords, read_titles, selected_tools
from .sources.sinks import write_results
from .sources.xlsx import read_cells


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="phrasemill")
    p.add_argument("--xlsx", required=True)
    p.add_argument("--cms", required=True)
    p.add_argument("--tools", help="comma-separated; all without it")
    p.add_argument("--output", "-o", default="output")
    p.add_argument("--min-freq", type=int, default=O.MIN_FREQ)
    p.add_argument("--threshold", type=Fraction, default=Fraction(*O.STD_THRESHOLD), help="for standard keywords")
    p.add_argument("--low-threshold", type=Fraction, default=Fraction(*O.LOW_THRESHOLD))
    p.add_argument("--ai-cleanup", action="store_true", help="let a chat service propose titles and flag entries; key from $PHRASEMILL_API_KEY or the file .api_key")
    p.add_argument("--ai-url", help="the service's address for chat requests")
    p.add_argument("--ai-model", default="default")
    p.add_argument("--ai-pause", type=float, default=0.5, help="seconds between requests of one worker")
    p.add_argument("--ai-ledger", help="a folder of replies that later runs go on with; without it they are asked for anew")
    return p.parse_args(argv)


def service(args: argparse.Namespace) -> ChatService | None:
    """What ``--ai-cleanup`` asks; None (with a warning) without an address or a key."""
    if not args.ai_cleanup:
        return None
    key = api_key()
    if not key or not args.ai_url:
        print("WARNING: --ai-cleanup needs --ai-url and a key ($PHRASEMILL_API_KEY or .api_key); it is left out")
        return None
    return ChatService(args.ai_url, args.ai_model, key)


def run(spark: SparkSession, args: argparse.Namespace, ask: Callable | None = None, report: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """The final rows, which are also written; they are the only intermediate table that stays. ``ask`` turns enrichment on (see ``operators.enrich``); ``report`` gets the stage counts."""
    with Scope(spark) as scope:
        cells = stored(read_cells(spark, args.xlsx), "cells")
        keywords = selected_tools(all_keywords(cells), args.tools)
        s = Settings((args.threshold.numerator, args.threshold.denominator), (args.low_threshold.numerator, args.low_threshold.denominator), min_freq=args.min_freq)
        with Consolidation(keywords, read_titles(spark, args.cms), s) as job:
            final = stored(job.final(), "final")
            if report is not None:
                report(job.stage_counts())
                report(job.title_counts())
            if ask is not None:
                final = stored(enrich(final, ask, pause=args.ai_pause, ledger=args.ai_ledger), "enriched")
        write_results(final, args.output)
        return scope.keep(final)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("phrasemill").getOrCreate()
    show = lambda df: df.orderBy(*df.columns).show(10_000, truncate=False)  # noqa: E731  a few rows a tool
    final = run(spark, args, service(args), show)
    O.summary(final).orderBy(F.col("tool").asc_nulls_last()).show(1000, truncate=False)
    print(f"written to {args.output}")


if __name__ == "__main__":
    main()
