"""CSV sink: the eight report columns, one file a tool.

``report`` is a data source of Spark that tasks write to. The job is a transaction in two steps, and no row passes the driver:

1. Rows are dealt by ranges of (tool, rank), so a large tool is several ranges. A task writes each of its tools' rows to a staged
   file of its own and hands its place to the driver in its commit message. Commit writes the list of staged files, abort deletes
   them; an attempt that dies is in no list.
2. One task a tool copies its ranges in order behind a header to a draft, which is then moved to its name.

Staged files are deleted in the end. Files of tools that an earlier run wrote and this one doesn't are deleted last.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator
from itertools import groupby

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions import text as X
from ..plans.ship import ship
from .files import listed, located, opened_by_tasks, put_file

COLUMNS = ("canonical_keyword", "suggested_title", "category", "variant_count", "signal_strength", "source", "frequency_count", "all_variants")
PIECE = 1 << 20


class StagedRanges(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int, str]]):
        self.files = files  # (tool_file, range, place)


class ReportSource(DataSource):
    """Write only: rows of tool_file and the report's columns, in order within each task."""

    @classmethod
    def name(cls) -> str:
        return "report"

    def writer(self, schema: StructType, overwrite: bool) -> ReportWriter:
        return ReportWriter(self.options["path"], schema)


class ReportWriter(DataSourceWriter):
    def __init__(self, path: str, schema: StructType):
        self.staging = path
        self.columns = [n for n in schema.names if n != "tool_file"]

    def write(self, iterator: Iterator[Row]) -> StagedRanges:
        store, root = located(self.staging)
        part = TaskContext.get().partitionId()
        files = []
        for name, rows in groupby(iterator, key=lambda r: r["tool_file"]):
            place = f"{root}/{part:06d}-{uuid.uuid4().hex}"
            put_file(store, place, csv_pieces([r[c] for c in self.columns] for r in rows))
            files.append((name, part, place))
        return StagedRanges(files)

    def commit(self, messages: list[StagedRanges | None]) -> None:
        store, root = located(self.staging)
        staged = sorted(f for m in messages if m is not None for f in m.files)
        put_file(store, f"{root}/staged.json", [json.dumps(staged).encode()])

    def abort(self, messages: list[StagedRanges | None]) -> None:
        store, _ = located(self.staging)
        for m in messages:
            for _, _, place in m.files if m is not None else ():
                if store.get_file_info(place).is_file:
                    store.delete_file(place)


def csv_pieces(rows) -> Iterator[bytes]:
    """Lines of CSV, about ``PIECE`` characters at a time; null is empty."""
    buffer = io.StringIO(newline="")
    out = csv.writer(buffer)
    for row in rows:
        out.writerow(row)
        if buffer.tell() >= PIECE:
            yield buffer.getvalue().encode()
            buffer.seek(0)
            buffer.truncate()
    yield buffer.getvalue().encode()


def write_results(final: DataFrame, path: str, merged: bool = True) -> None:
    """Overwrite ``path`` with ``<name>_cleaned.csv`` a tool, rows in final order. Tools with one safe name share a file.

    With ``merged`` tasks must be able to open the store themselves (see the module). Without it, any store that Spark
    writes gets a ``tool_file=<name>_cleaned`` directory a tool, each part with a header.
    """
    named = final.withColumn("tool_file", F.concat(X.safe_name(F.col("tool")), F.lit("_cleaned")))
    ordered = named.repartitionByRange("tool_file", "tool", "final_rank").sortWithinPartitions("tool_file", "tool", "final_rank").select("tool_file", *COLUMNS)
    if not merged:
        out = ordered.write.mode("overwrite").partitionBy("tool_file")
        out.option("header", True).option("escape", '"').option("emptyValue", "").option("lineSep", "\r\n").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        return
    if not opened_by_tasks(path):
        raise ValueError(f"tasks can't open {path} themselves; write directories (merged=False)")
    spark = final.sparkSession
    ship(spark)
    spark.dataSource.register(ReportSource)
    path = path.rstrip("/")
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    store, root = located(path)
    try:
        ordered.write.format("report").mode("append").save(staging)
        written = _joined(spark, staging, path)
        for place in listed(f"{path}/*_cleaned.csv"):
            if place.rpartition("/")[2] not in written:
                store.delete_file(place)
    finally:
        _, place = located(staging)
        if store.get_file_info(place).type == fs.FileType.Directory:
            store.delete_dir(place)


def _joined(spark: SparkSession, staging: str, path: str) -> set[str]:
    """Join each tool's staged ranges in a task of its own; the names of the files."""
    store, root = located(staging)
    with store.open_input_stream(f"{root}/staged.json") as f:
        staged = json.loads(f.read())
    if not staged:
        return set()

    def join(key, pdf):
        import pandas as pd

        store, root = located(path)

        def pieces() -> Iterator[bytes]:
            yield from csv_pieces([COLUMNS])
            for place in pdf.sort_values("range").place:
                with store.open_input_stream(place) as f:
                    while piece := f.read(PIECE):
                        yield piece

        put_file(store, f"{root}/{key[0]}.csv", pieces())
        return pd.DataFrame({"file": [f"{key[0]}.csv"]})

    # A row a tool and range: the list of files, not what they hold.
    files = spark.createDataFrame([tuple(f) for f in staged], "tool_file string, range long, place string")
    return {r.file for r in files.groupBy("tool_file").applyInPandas(join, "file string").collect()}


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """tool_file and the report's columns of the files that ``write_results`` merged; an empty field is an empty string."""
    kinds = ", ".join(f"{c} {'long' if c == 'variant_count' else 'string'}" for c in COLUMNS)
    rows = spark.read.schema(kinds).csv(f"{path.rstrip('/')}/*_cleaned.csv", header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, enforceSchema=True)
    filled = [c if c == "variant_count" else F.coalesce(c, F.lit("")).alias(c) for c in COLUMNS]
    return rows.select(*filled, F.col("_metadata.file_name").alias("_file")).withColumn("tool_file", F.regexp_extract("_file", r"^(.*)\.csv$", 1)).drop("_file")
