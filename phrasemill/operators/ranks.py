"""Row numbers within scopes of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.storage import stored

#: Rows of a scope that one task may sort.
MAX_SORTED = 2_000_000


def numbered(df: DataFrame, scope: list[str], order: list[Column], name: str, max_sorted: int = MAX_SORTED) -> DataFrame:
    """``df`` with ``name``: the row's number (from 1) in its scope by ``order`` (named columns, ascending; a total order).

    A window sorts each scope in one task. Where a scope has more than ``max_sorted`` rows, rows are dealt to ranges of
    (scope, order) instead, numbered within a range, and moved by the counts of the ranges before.
    """
    if df.groupBy(*scope).count().where(F.col("count") > max_sorted).isEmpty():
        return df.withColumn(name, F.row_number().over(W.partitionBy(*scope).orderBy(*order)).cast("long"))
    keys = [f"_{name}_{i}" for i in range(len(order))]
    part, place = f"_{name}_part", f"_{name}_place"
    rows = df.select("*", *(o.alias(k) for o, k in zip(order, keys)))
    rows = stored(rows.repartitionByRange(*scope, *keys).withColumn(part, F.spark_partition_id()), "ranges")
    sizes = rows.groupBy(*scope, part).agg(F.count("*").alias("_size"))  # scopes x ranges at most
    before = F.coalesce(F.sum("_size").over(W.partitionBy(*scope).orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    moved = sizes.select(*(F.col(c).alias(f"_at_{c}") for c in (*scope, part)), before.alias("_before"))
    placed = rows.withColumn(place, F.row_number().over(W.partitionBy(*scope, part).orderBy(*keys)))
    same = [placed[c].eqNullSafe(moved[f"_at_{c}"]) for c in (*scope, part)]
    joined = placed.join(moved, same).withColumn(name, (F.col("_before") + F.col(place)).cast("long"))
    return joined.select(*df.columns, name)
