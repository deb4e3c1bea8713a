"""Keys over many runs: how many a run has, and how many no earlier run had.

``new_keys`` is exact: a key is new in its first run. ``run_sketches`` keeps one Theta sketch a (run, tool, batch), a few kilobytes whatever
the number of keys, and ``new_keys_estimated`` answers the same from the kept sketches, so no earlier run's keys are read again. Sketches of
2^``lg`` entries are exact up to that many keys; beyond, the standard error of a count is about 1 / sqrt(2^lg).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Logarithm of a sketch's entries: 4,096, an error of 1.6 %.
LG = 12
SCOPE = ["tool", "batch"]


def new_keys(rows: DataFrame) -> DataFrame:
    """run, tool, batch, n_keys, n_new of ``rows`` (run, tool, batch, key_str; any number of rows a key)."""
    first = rows.groupBy(*SCOPE, "key_str", "run").agg(F.lit(1).alias("n"))
    began = rows.groupBy(*SCOPE, "key_str").agg(F.min("run").alias("began"))
    both = first.join(began, [*SCOPE, "key_str"])
    return both.groupBy("run", *SCOPE).agg(F.count("*").alias("n_keys"), F.count_if(F.col("run") == F.col("began")).alias("n_new"))


def run_sketches(rows: DataFrame, lg: int = LG) -> DataFrame:
    """run, tool, batch, sketch."""
    return rows.groupBy("run", *SCOPE).agg(F.theta_sketch_agg("key_str", lg).alias("sketch"))


def new_keys_estimated(sketches: DataFrame, lg: int = LG) -> DataFrame:
    """run, tool, batch, n_keys, n_new from the sketches of all runs. A (tool, batch) has one row a run, each a few kilobytes."""
    before = F.theta_union_agg("sketch", lg).over(W.partitionBy(*SCOPE).orderBy("run").rowsBetween(W.unboundedPreceding, -1))
    rows = sketches.withColumn("_before", before)
    # The first run has nothing before it.
    fresh = F.when(F.col("_first"), F.col("sketch")).otherwise(F.theta_difference("sketch", "_before"))
    first = F.row_number().over(W.partitionBy(*SCOPE).orderBy("run")) == 1
    estimate = lambda c: F.theta_sketch_estimate(c).cast("long")
    return rows.withColumn("_first", first).select("run", *SCOPE, estimate("sketch").alias("n_keys"), estimate(fresh).alias("n_new"))
