"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ship import ship
from ..plans.storage import Scope, discard  # noqa: F401  for the operators and the pipeline
from ..plans.storage import shared_path as shared_dir
from ..plans.storage import stored as _stored

#: Rows handed to Python at once; long texts make rows large, so batches are kept short.
ARROW_ROWS = 1000
ARROW_BYTES = 16 << 20


def tokenizer_path(name: str, directory: str | None = None) -> str:
    """Place of a public vocabulary file; ``directory`` overrides the installed package."""
    if directory:
        return os.path.join(directory, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for two Python workers beside one executor heap; ship the package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written compactly to the shared folder and read again: a lineage cut that survives lost executors."""
    return _stored(df, label, "zstd")


def shielded(docs: DataFrame, taken: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)``, with columns of ``docs`` whose names ``work`` uses for itself out of the way meanwhile."""
    own = {t.lower() for t in taken}
    away = {c: f"{c}_{uuid.uuid4().hex}" for c in docs.columns if c.lower() in own}
    if not away:
        return work(docs)
    return work(docs.withColumnsRenamed(away)).withColumnsRenamed({v: k for k, v in away.items()})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the fast path of ``lower``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))


def split_text_key(c: Column) -> Column:
    """64-bit key that tells rows of one doc_id with different texts apart (null is its own text)."""
    return F.xxhash64(F.coalesce(c, F.lit("")), c.isNull())
