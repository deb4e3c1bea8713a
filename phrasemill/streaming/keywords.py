"""The stateless and counting steps on streams of keywords.

Normalizing, filtering and labelling are column expressions, so they run on ``readStream`` as they
are; group sizes are an ordinary stateful aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import DEFAULT, Lexicon


def keyed_stream(keywords: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """tool, batch, keyword with key_str and category; irrelevant and keyless rows go."""
    relevant = keywords.where(~X.is_irrelevant(F.col("keyword"), F.col("tool"), lex))
    keyed = relevant.withColumn("key_str", X.key_string(X.keyword_key(F.col("keyword"), F.col("tool"), lex)))
    return keyed.where("key_str <> ''").withColumn("category", X.category(F.col("keyword")))


def group_sizes(keywords: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """Running size of every intent group (update or complete output mode)."""
    return keyed_stream(keywords, lex).groupBy("tool", "batch", "key_str").agg(F.count("*").alias("n"))
