"""Intermediate tables in the folder that the session names in ``spark.checkpoint.dir``, and who deletes them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Where each stored table lies.
_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: The run that owns what the current thread makes, if one is open.
_OWNER: ContextVar[Scope | None] = ContextVar("phrasemill_scope", default=None)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new place below ``spark.checkpoint.dir``; a local folder only where a local session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="phrasemill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scope:
    """The intermediate tables of one run. Tables belong to the scope that was open in the thread that made them.

    ``with Scope(spark) as scope`` (or ``with scope.open()``, any number of times) owns what is stored meanwhile; ``close`` deletes it,
    but for tables that ``keep`` has handed on to the scope around it. Runs beside each other never touch each other's tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    @contextmanager
    def open(self) -> Iterator[Scope]:
        token = _OWNER.set(self)
        try:
            yield self
        finally:
            _OWNER.reset(token)

    def __enter__(self) -> Scope:
        self._outer = _OWNER.get()
        self._token = _OWNER.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _OWNER.reset(self._token)
        self.close()

    def keep(self, table: DataFrame) -> DataFrame:
        """``table`` outlives this scope; the scope around it (if any) owns it from now on."""
        path = _PLACES[table]
        self.paths.remove(path)
        if self._outer is not None:
            self._outer.paths.append(path)
        return table

    def close(self) -> None:
        for path in self.paths:
            delete(self.spark, path)
        self.paths.clear()


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written once and read again: later stages don't recompute it, and lost executors don't lose it."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    owner = _OWNER.get()
    if owner is not None:
        owner.paths.append(path)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PLACES[table] = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a stored table (what ``stored`` returned) that nothing reads any more."""
    path = _PLACES.pop(table)
    owner = _OWNER.get()
    if owner is not None and path in owner.paths:
        owner.paths.remove(path)
    delete(table.sparkSession, path)
